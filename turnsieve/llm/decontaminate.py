"""Benchmark passages in training texts: a positional inverted index, searched from the rarest term.

The index is cut by documents: a row is a segment of about ``SEGMENT_WORDS`` words with its ids, lengths,
terms and, for each term, its places. Segments are built where the texts are read and written once under
the shared folder, so postings are never shuffled, and a frequent word is spread over all segments.

The items' windows are the query set. They are searched in blocks of at most ``BLOCK_WINDOWS`` windows,
which bounds what is sent to every task. In a segment a window whose terms are not all there is dropped
at once; for the others the lists are intersected from the shortest on: first places of the rarest term that
have every other term near, then, shifted by the terms' places in the window, those that start an exact phrase.
Proximity matches have all terms of a window within ``NEAR`` words of its rarest one, in any order.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import written, written_large
from .common import ascii_words

WINDOW, NEAR = 10, 10
SEGMENT_WORDS, BLOCK_WINDOWS = 1 << 19, 50_000
#: Free places between two documents of a segment, so that no phrase or neighbourhood spans both.
GAP = 4 * NEAR


def _numbering() -> defaultdict:
    """Numbers for words, in the order in which they are first asked for."""
    numbers: defaultdict = defaultdict()
    numbers.default_factory = numbers.__len__
    return numbers


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """One row per segment: ``(ids, lengths, terms, sizes, places)``.

    ``sizes`` holds the number of places of each term and ``places`` the lists one after the other,
    four little-endian bytes for a place: the first of a term as it is, then differences. The words of
    document ``i`` start at the sum of the lengths before it plus ``i * GAP``. Null texts have no words;
    null and repeated ids are kept, each row for itself. A long text makes a long segment.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        lengths: list[int] = []
        codes: list[np.ndarray] = []
        vocabulary = _numbering()
        kind, held = None, 0

        def segment() -> pa.RecordBatch:
            n = np.array(lengths, dtype=np.int64)
            code = np.concatenate(codes)
            if len(vocabulary) < 1 << 16:
                code = code.astype(np.uint16)  # sorted digit by digit
            place = np.arange(len(code)) + np.repeat(np.arange(len(n)) * GAP, n)
            order = np.argsort(code, kind="stable")
            sizes = np.bincount(code, minlength=len(vocabulary))
            place = place[order]
            gaps = np.diff(place, prepend=0)
            first = np.cumsum(sizes) - sizes
            gaps[first] = place[first]
            row = [
                pa.array([ids], pa.list_(kind)),
                pa.array([lengths], pa.list_(pa.int32())),
                pa.array([[w.decode("utf-8", "replace") for w in vocabulary]], pa.list_(pa.string())),
                pa.array([sizes], pa.list_(pa.int32())),
                pa.array([gaps.astype("<i4").tobytes()], pa.binary()),
            ]
            return pa.record_batch(row, names=["ids", "lengths", "terms", "sizes", "places"])

        for batch in batches:
            kind = batch.schema.field(0).type
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = ascii_words(text.as_py())
                ids.append(id_)
                lengths.append(len(words))
                codes.append(np.fromiter(map(vocabulary.__getitem__, words), dtype=np.int32, count=len(words)))
                held += len(words) + GAP
                if held >= segment_words:
                    yield segment()
                    ids, lengths, codes, vocabulary, held = [], [], [], _numbering(), 0
        if ids:
            yield segment()

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(slim.dtypes)["id"]
    index = slim.mapInArrow(run, f"ids array<{kind}>, lengths array<int>, terms array<string>, sizes array<int>, places binary")
    return written_large(index.select(F.monotonically_increasing_id().alias("segment"), "*"), "index")


def documents_of(index: DataFrame) -> DataFrame:
    """``(segment, row, id, n_words)`` of every indexed document."""
    rows = index.select("segment", F.posexplode(F.arrays_zip("ids", "lengths")).alias("row", "d"))
    return rows.select("segment", "row", F.col("d.ids").alias("id"), F.col("d.lengths").cast("bigint").alias("n_words"))


def windows_of(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``(item, words)``: each distinct window of each item. Items without words or without an id have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item, out = [], []
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = [w.decode("utf-8", "replace") for w in ascii_words(text.as_py())]
                found = [words[i : i + window] for i in range(max(1, len(words) - window + 1))] if words else []
                item += [id_] * len(found)
                out += found
            yield pa.record_batch([pa.array(item, batch.schema.field(0).type), pa.array(out, pa.list_(pa.string()))], names=["item", "words"])

    slim = items.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("item"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, f"item {dict(slim.dtypes)['item']}, words array<string>").distinct()


class _Lists:
    """Places of the terms of one segment, unpacked when they are first asked for."""

    def __init__(self, sizes: np.ndarray, places: bytes):
        self.sizes, self.gaps = sizes, np.frombuffer(places, dtype="<i4")
        self.ends = np.cumsum(sizes, dtype=np.int64)
        self.known: dict[int, np.ndarray] = {}
        self.pairs: dict[tuple[int, int, int], np.ndarray] = {}

    def __call__(self, term: int) -> np.ndarray:
        if term not in self.known:
            end = self.ends[term]
            self.known[term] = np.cumsum(self.gaps[end - self.sizes[term] : end], dtype=np.int64)
        return self.known[term]


    def near(self, at: np.ndarray, term: int, width: int) -> np.ndarray:
        """Those of some places that have the term within ``width`` words."""
        places = self(term)
        found = np.minimum(np.searchsorted(places, at - width), len(places) - 1)
        return at[np.abs(places[found] - at) <= width]

    def pair(self, rare: int, term: int, width: int) -> np.ndarray:
        """Places of one term that have another near; windows that overlap ask for the same pairs."""
        key = (rare, term, width)
        if key not in self.pairs:
            self.pairs[key] = self.near(self(rare), term, width)
        return self.pairs[key]


def _close(lists: _Lists, terms: np.ndarray, order: list[int], width: int) -> np.ndarray:
    """Places of the rarest term that have every other term within ``width`` words; the rarest two are met first."""
    if len(order) == 1:
        return lists(terms[order[0]])
    at = lists.pair(int(terms[order[0]]), int(terms[order[1]]), width)
    for o in order[2:]:
        if not len(at):
            break
        at = lists.near(at, terms[o], width)
    return at


def _phrases(lists: _Lists, terms: np.ndarray, order: list[int], at: np.ndarray) -> np.ndarray:
    """Starts at which all terms stand one after the other; ``at`` are places of the rarest that may be in one."""
    at = at - order[0]
    for o in order[1:]:
        if not len(at):
            break
        places = lists(terms[o])
        want = at + o
        found = np.minimum(np.searchsorted(places, want), len(places) - 1)
        at = at[places[found] == want]
    return at


def _spans(first: np.ndarray, last: np.ndarray, row: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Overlapping or touching spans of one document as one."""
    order = np.argsort(first, kind="stable")
    first, last, row = first[order], np.maximum.accumulate(last[order]), row[order]
    cut = np.flatnonzero(np.r_[True, (first[1:] > last[:-1]) | (row[1:] != row[:-1])])
    for a, b in zip(cut, np.r_[cut[1:], len(first)], strict=True):
        yield int(row[a]), int(first[a]), int(last[b - 1])


def search(index: DataFrame, windows: DataFrame, near: int = NEAR, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Matches ``(segment, row, item, kind, start, length)``: spans of whole windows of one item.

    ``kind`` is ``phrase`` or ``near``; windows that match as phrases beside each other are one span. Near
    matches that are phrases are left out. ``start`` counts words of the document from 0. Windows are searched in
    blocks of about ``block_windows``: a block's matches are written before the next block is collected and sent
    out, so the driver and the executors hold one block at a time.
    """
    item = windows.select("item")
    windows = written(windows, "windows")
    blocks = max(1, -(-windows.count() // block_windows))
    parts = []
    for b in range(blocks):
        some = windows.where(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == b)
        parts.append(_search_block(index, some.collect(), item, near))
    return reduce(DataFrame.unionByName, parts)


def _search_block(index: DataFrame, block: list, item: DataFrame, near: int) -> DataFrame:
    """The written matches of a block of windows."""
    terms = sorted({w for r in block for w in r.words})
    number = {w: i for i, w in enumerate(terms)}
    length = max((len(r.words) for r in block), default=1)
    matrix = np.full((len(block), length), len(terms), dtype=np.int32)
    for i, r in enumerate(block):
        matrix[i, : len(r.words)] = [number[w] for w in r.words]
    sent = index.sparkSession.sparkContext.broadcast((terms, matrix, [r.item for r in block]))

    item_kind = to_arrow_schema(item.schema).field(0).type
    schema = pa.schema(
        [("segment", pa.int64()), ("row", pa.int32()), ("item", item_kind), ("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, matrix, items = sent.value
        asked = pa.array(terms, pa.string())
        for batch in batches:
            for i in range(batch.num_rows):
                segment, lengths, vocabulary, sizes, places = (batch.column(c)[i] for c in range(5))
                local = pc.index_in(asked, value_set=vocabulary.values).fill_null(-1).to_numpy(zero_copy_only=False)
                ids = np.r_[local, -2].astype(np.int64)[matrix]  # -1: not in the segment, -2: behind a short window
                n = lengths.values.to_numpy(zero_copy_only=False).astype(np.int64)
                starts = np.cumsum(n) - n + np.arange(len(n)) * GAP
                lists = _Lists(sizes.values.to_numpy(zero_copy_only=False), places.as_py())
                found: dict[tuple, list] = {}
                there = np.flatnonzero((ids != -1).all(axis=1))
                sizes_of = lists.sizes.astype(np.int64)[ids[there]]
                rarest = np.argsort(np.where(ids[there] >= 0, sizes_of, np.iinfo(np.int64).max), axis=1, kind="stable")
                for w, ranked, size in zip(there.tolist(), rarest, (ids[there] >= 0).sum(axis=1).tolist(), strict=True):
                    window, order = ids[w, :size], ranked[:size].tolist()
                    # a phrase has all its terms near the rarest, so places without them are dropped for both
                    within = max(near, len(window) - 1)
                    close = _close(lists, window, order, within)
                    if not len(close):
                        continue
                    at = _phrases(lists, window, order, close)
                    if len(at):
                        found.setdefault((items[w], "phrase"), []).append((at, at + len(window)))
                    if within > near:
                        close = _close(lists, window, order, near)
                    close = close[~np.isin(close - order[0], at)]
                    if len(close):
                        found.setdefault((items[w], "near"), []).append((close, close + 1))
                rows = []
                for (name, kind), spans in found.items():
                    first, last = (np.concatenate(x) for x in zip(*spans, strict=True))
                    row = np.searchsorted(starts, first, side="right") - 1
                    rows += [(segment.as_py(), r, name, kind, a - int(starts[r]), b - a) for r, a, b in _spans(first, last, row)]
                if rows:
                    columns = [pa.array(c) for c in zip(*rows, strict=True)]
                    yield pa.record_batch([c.cast(t) for c, t in zip(columns, schema.types, strict=True)], names=schema.names)

    kinds = f"segment bigint, row int, item {item.dtypes[0][1]}, kind string, start int, length int"
    slim = index.select("segment", "lengths", "terms", "sizes", "places")
    found = written(slim.mapInArrow(run, kinds), "matches")
    sent.destroy()
    return found


def _covered(spans: Column) -> Column:
    """Words that lie in at least one of the spans ``(start, length)``."""
    step = lambda acc, s: F.struct(
        F.greatest(acc["end"], s["start"] + s["length"]).alias("end"),
        (acc["n"] + F.greatest(F.lit(0), s["start"] + s["length"] - F.greatest(acc["end"], s["start"]))).alias("n"),
    )
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(F.array_sort(spans), zero, step, lambda acc: acc["n"])


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    segment_words: int = SEGMENT_WORDS,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Per row of ``docs``: ``(id, n_words, n_hit, items, n_near)``.

    ``n_hit`` counts the words inside any occurrence of a window, ``items`` lists the items with one in
    the order of their ids as strings, ``n_near`` counts the near spans. No items: nothing is hit. Null and empty
    texts have no words, items with a null id are left out, repeated rows and ids stay, texts of any length are searched
    whole, other columns may have any name, and an empty table gives no rows.
    """
    index = build_index(docs, id_col, text_col, segment_words)
    matches = search(index, windows_of(items, window=window), block_windows=block_windows)
    phrase = F.col("kind") == "phrase"
    hits = matches.groupBy("segment", "row").agg(
        F.collect_list(F.when(phrase, F.struct("start", "length"))).alias("spans"),
        F.collect_set(F.when(phrase, F.col("item").cast("string"))).alias("items"),
        F.count_if(~phrase).alias("n_near"),
    )
    hits = hits.select(
        "segment", "row", _covered(F.col("spans")).cast("bigint").alias("n_hit"), F.array_sort("items").alias("items"), "n_near"
    )
    none = F.array().cast("array<string>")
    return documents_of(index).join(hits, ["segment", "row"], "left").select(
        "id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("items", none).alias("items"),
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
    )
