import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from turnsieve.llm import spelling

from .fixtures import documents, lower, nothing, prose

RUN = re.compile("[A-Za-z\u00c0-\u00ff]+")


def plain_words(rows, min_length=6, min_count=5):
    counts = Counter()
    for key, text in rows:
        for run in map(lower, RUN.findall(text or "")):
            if key is not None and (h := zlib.crc32(f"{key}:{run}".encode())) % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(words):
    found = {}
    for w, n in words.items():
        near = [v for v in words if abs(len(v) - len(w)) < 2 and one_apart(v, w)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form = best if best and words[best] >= 5 * n else None
        found[w] = (form, n, len(near), words[form] if form else None)
    out = {}
    for w, (form, *rest) in found.items():
        root = w
        while found[root][0]:
            root = found[root][0]
        out[w] = (form, root, *rest)
    return out


def noisy(seed, n):
    """Words with many neighbours and chains of ever more frequent ones."""
    rng, out = random.Random(seed), Counter()
    for base in prose(n, seed).split():
        word, count = base + "esta", 5
        for _ in range(rng.randint(1, 5)):
            out[word] += count
            i, kind = rng.randrange(len(word)), rng.random()
            c = rng.choice("aeäéÉÿz")
            word = word[:i] + ("" if kind < 0.3 else c) + word[i + (kind < 0.7) :]
            count *= rng.choice((1, 5, 7))
    return {w: c for w, c in out.items() if len(w) >= 6}


def check(spark, words, **options):
    df = spark.createDataFrame(list(words.items()), "word string, n bigint")
    rows = spelling.variants(df, **options).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows} == plain(words)
    assert len(rows) == len(words)


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_against_brute_force(spark, seed):
    words = noisy(seed, 200)
    assert any(f and plain(words)[f][0] for f, *_ in plain(words).values())  # a chain of two steps
    check(spark, words)


def test_rounds_of_few_pages(spark, monkeypatch):
    """A vocabulary of several pages, whose filters are broadcast one page at a time, and small chunks of edits."""
    monkeypatch.setattr(spelling, "PAGE_BLOCKS", 2)
    monkeypatch.setattr(spelling, "_CHUNK", 1000)
    check(spark, noisy(3, 300), round_pages=1)


def test_ties_repeated_letters_and_long_words(spark):
    long = "ab" * 2000
    words = {"aaaaaa": 5, "aaaaaaa": 30, "aaaaaab": 30, "aaaaaaaa": 200, "baaaaa": 25, long: 6, long[:-1]: 40, long + "b": 200, long + "c": 5}
    check(spark, words)


def test_filter_lets_through_every_edit():
    rng = np.random.default_rng(1)
    words = [bytes(rng.choice(spelling._LETTERS, 8)) for _ in range(500)]
    blocks, cells = 4, np.zeros(32, dtype=np.uint64)
    block, bits = spelling._blocks(spelling._sums(spelling._letters(words, 8)), 8, blocks)
    for probe in range(spelling.PROBES):
        np.bitwise_or.at(cells, *spelling._places(block, bits, probe))
    filters = spelling.Filters({8: (blocks, 0, cells)})
    edited = sorted({bytes(w[:3] + w[4:]) for w in words} | {w[:5] + b"a" + w[5:] for w in words}, key=len)
    for length in (7, 9):
        probed = [w for w in edited if len(w) == length]
        made = {(i, m) for at, ms in spelling._edits(probed, filters) for i, m in zip(at.tolist(), ms, strict=True)}
        if length == 9:
            assert {w for w in words} <= {m for _, m in made}
    same = {(i, m) for at, ms in spelling._edits([b"\x60" * 3 + w[3:] for w in words[:0]] or [words[0]], filters) for i, m in zip(at, ms, strict=True)}
    assert all(len(m) == 8 and m != words[0] for _, m in same)


@pytest.mark.parametrize("clashing", [False, True])
def test_awkward_rows(spark, clashing):
    """A null id, a repeated row, one id with two texts, empty and long texts; columns of any name."""
    docs = documents(spark, clashing)
    texts = docs.selectExpr("doc_id", "text").collect()
    words = plain_words([tuple(r) for r in texts], 5, 3)
    found = spelling.spelling_variants(docs, min_length=5, min_count=3)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in found.collect()} == plain(words) and words


def test_slices_and_signs(monkeypatch):
    monkeypatch.setattr(spelling, "_SLICE", 7)
    text = "Straße ÉCOLE naïveté×÷ \ud800hidden\U0001f600colours L’année Ā" + " tail" * 50
    for key in ("1", "73", None):
        got = {w.decode("latin-1"): n for w, n in spelling.word_counts(key, text, 4).items()}
        want = Counter()
        for run in map(lower, RUN.findall(text)):
            if key and len(run) >= 4 and (h := zlib.crc32(f"{key}:{run}".encode())) % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += 1
        assert got == {w: n for w, n in want.items() if len(w) >= 4}


def test_empty(spark):
    assert spelling.spelling_variants(nothing(spark)).collect() == []
    one = spark.createDataFrame([("single", 5)], "word string, n bigint")
    assert [tuple(r) for r in spelling.variants(one).collect()] == [("single", None, "single", 5, 0, None)]
