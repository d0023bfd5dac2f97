"""License notices in texts: exact phrases, and short notices with a few edits.

Texts are compared as their words, joined by single spaces. A base label stands where the words of its phrase
stand one after the other. A notice with ``k`` allowed edits is cut into ``k + 1`` seeds: with at most ``k``
edits one of them is there unchanged. An automaton finds all seeds of all notices in one pass. An edit changes at most ``GRAM`` of a
notice's letter triples, so a place around a seed that lacks more of them is no match; at the others the
regex library matches the notice with at most ``k`` errors and reports span and errors.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_words

# Phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Short notices as they are commonly written, and their labels.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit-text",
    "this work is licensed under the gnu general public license": "gpl-notice",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms with or without modification": "bsd-text",
    "this source code form is subject to the terms of the mozilla public license": "mpl-2.0",
    "licensed under creative commons attribution": "cc-notice",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "permission to use copy modify and or distribute this software for any purpose": "isc-text",
    "all rights reserved": "all-rights-reserved",
}

#: One edit is allowed for so many letters.
LETTERS_PER_EDIT = 9
GRAM = 3


def _grams(text: str) -> list[str]:
    return [text[i : i + GRAM] for i in range(len(text) - GRAM + 1)]


class Scanner:
    """Seeds and patterns of a set of notices."""

    def __init__(self, base: dict[str, str], notices: dict[str, str], letters_per_edit: int):
        import ahocorasick

        self.base = [(f" {p} ".encode(), len(p.split()), label) for p, label in base.items()]
        self.seeds, self.patterns = ahocorasick.Automaton(), []
        where: dict[str, list[tuple[int, int]]] = {}
        for n, (notice, label) in enumerate(notices.items()):
            k = len(notice) // letters_per_edit
            found = regex.compile(f"(?b)(?:{regex.escape(notice, special_only=False)}){{e<={k}}}")
            self.patterns.append((notice, label, k, found, _grams(notice)))
            for i in range(k + 1):
                a, b = len(notice) * i // (k + 1), len(notice) * (i + 1) // (k + 1)
                where.setdefault(notice[a:b], []).append((n, a))
        for seed, at in where.items():
            self.seeds.add_word(seed, (len(seed), at))
        self.seeds.make_automaton()

    def exact(self, words: bytes) -> list[tuple[int, str, int]]:
        """``(first word, label, number of words)`` of all places of the base phrases, in linear time."""
        places: list[int] = []
        kinds: list[tuple[str, int]] = []
        for phrase, n, label in self.base:
            at = words.find(phrase)
            while at >= 0:
                places.append(at)
                kinds.append((label, n))
                at = words.find(phrase, at + 1)
        if not places:
            return []
        first = np.searchsorted(np.flatnonzero(np.frombuffer(words, dtype=np.uint8) == 0x20), places)
        return [(w, label, n) for w, (label, n) in zip(first.tolist(), kinds, strict=True)]

    def fuzzy(self, text: str) -> list[tuple[int, int, str, int, int]]:
        """``(start, end, label, errors, letters)`` of every notice that a seed leads to, the best of overlapping ones."""
        ends: dict[int, int] = {}
        found = []
        for end, (size, at) in self.seeds.iter(text):
            for n, offset in at:
                notice, label, k, pattern, grams = self.patterns[n]
                done = ends.get(n, 0)
                if end < done:  # inside a match of this notice
                    continue
                start = max(0, end + 1 - size - offset - k)
                start, stop = max(start, done), min(len(text), start + len(notice) + 2 * k)
                there = set(_grams(text[start:stop]))
                if sum(g not in there for g in grams) > GRAM * k:
                    continue
                m = pattern.search(text, start, stop)
                if m and sum(m.fuzzy_counts) <= k:
                    found.append((sum(m.fuzzy_counts) / len(notice), -len(notice), m.start(), m.end(), label, sum(m.fuzzy_counts)))
                    ends[n] = m.end()
        out = []
        for together in _overlapping(found):
            taken: list[tuple[int, int]] = []  # spans without overlap, in their order
            for _, letters, start, end, label, errors in sorted(together):
                i = bisect(taken, (start, end))
                if (i == 0 or taken[i - 1][1] <= start) and (i == len(taken) or end <= taken[i][0]):
                    taken.insert(i, (start, end))
                    out.append((start, end, label, errors, -letters))
        return sorted(out)


def _overlapping(found: list[tuple]) -> Iterator[list[tuple]]:
    """Matches in groups that overlap from one to the next; fields 2 and 3 are start and end."""
    group: list[tuple] = []
    reach = -1
    for match in sorted(found, key=lambda m: m[2:4]):
        if group and match[2] >= reach:
            yield group
            group = []
        group.append(match)
        reach = max(reach, match[3]) if len(group) > 1 else match[3]
    if group:
        yield group


def _word_numbers(text: str, spans: list[tuple]) -> list[tuple[int, int]]:
    """First and last word of each span of a text whose words have one space before and after each."""
    if not spans:
        return []
    spaces = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), dtype="<u4") == 0x20)
    first = np.searchsorted(spaces, [s[0] for s in spans], side="right") - 1
    last = np.searchsorted(spaces, [s[1] for s in spans]) - 1
    return list(zip(np.maximum(first, 0).tolist(), np.maximum(last, 0).tolist(), strict=True))


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    base: dict[str, str] | None = None,
    notices: dict[str, str] | None = None,
    letters_per_edit: int = LETTERS_PER_EDIT,
) -> DataFrame:
    """Per row ``(id, n_words, spans)``; a span is ``(label, exact, first, last, errors, score, found)``.

    ``first`` and ``last`` are the first and last word, counted from 0; ``errors`` the edits against the notice
    and ``score`` one less their share of its letters. Null and empty texts have no words and no spans;
    null and repeated ids and rows stay as they are, an empty table gives no rows. A text of any length is scanned
    whole, in time that grows with it and its matches. Of overlapping matches of notices the one with the smaller share
    of errors counts, then the longer notice, then the one that starts or ends first, then the smaller label.
    """
    base, notices = BASE if base is None else base, NOTICES if notices is None else notices
    span = pa.struct(
        [("label", pa.string()), ("exact", pa.bool_()), ("first", pa.int64()), ("last", pa.int64()), ("errors", pa.int32()), ("score", pa.float64()), ("found", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, notices, letters_per_edit)
        for batch in batches:
            sizes, spans = [], []
            for text in batch.column(1):
                words = ascii_words(text.as_py())
                joined = b" ".join([b"", *words, b""])
                rows = [
                    dict(label=label, exact=True, first=w, last=w + n - 1, errors=0, score=1.0, found=b" ".join(words[w : w + n]).decode())
                    for w, label, n in scanner.exact(joined)
                ]
                low = joined.decode("utf-8", "replace")
                near = scanner.fuzzy(low)
                for (a, b, label, errors, letters), (first, last) in zip(near, _word_numbers(low, near), strict=True):
                    score = 1 - errors / letters
                    rows.append(dict(label=label, exact=False, first=first, last=last, errors=errors, score=score, found=low[a:b]))
                sizes.append(len(words))
                spans.append(rows)
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(span))], names=["id", "n_words", "spans"]
            )

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kinds = "label string, exact boolean, first bigint, last bigint, errors int, score double, found string"
    fields = ", ".join(k.replace(" ", ": ", 1) for k in kinds.split(", "))
    return slim.mapInArrow(run, f"id {dict(slim.dtypes)['id']}, n_words bigint, spans array<struct<{fields}>>")


def summary(scanned: DataFrame, name: str = "doc_id") -> DataFrame:
    """One row per text: places of base phrases, labels and the best score."""
    exact = F.filter("spans", lambda s: s["exact"])
    first = F.transform(exact, lambda s: s["first"])

    def labels(spans) -> object:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    return scanned.select(
        F.col("id").alias(name),
        "n_words",
        F.size(exact).cast("bigint").alias("n_base"),
        F.array_min(first).alias("first_word"),
        F.array_max(first).alias("last_word"),
        labels(exact).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("score"),
    )
