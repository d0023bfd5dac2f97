import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from turnsieve.llm import packing

from .fixtures import documents, nothing, prose, texts


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


EDGES = ["a  b", " \n a", "a ", "a\n", "\n", "a \n b  ", "'s 'll't", "a  b", "x　 y", " lead", "1 2  3", "it's we're"]


@pytest.mark.parametrize("text", [t or "" for t in texts()] + EDGES)
def test_ids_are_those_of_the_tokenizer(tokenizer, text):
    encoder = packing.Encoder()
    for _ in range(2):  # before and after words are remembered
        ids = np.frombuffer(encoder.ids(text), dtype="<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def test_round_trip(spark, tokenizer):
    rows = packing.pack(documents(spark, clashing=True)).collect()
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[(r.id, r.doc_tokens)].append(r)
        sequences[r.sequence_id].append(r)
    got = sorted(
        (i is None, i or 0, b"".join(bytes(p.ids) for p in sorted(ps, key=lambda p: (p.start, p.sequence_id))))
        for (i, _), ps in docs.items()
        if (i, _) not in {(6, _), (7, _)}
    )
    want = []
    for d in documents(spark).collect():
        ids = np.array([*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 0], dtype="<u4").tobytes()
        if d.doc_id not in (6, 7):
            want.append((d.doc_id is None, d.doc_id or 0, ids))
    assert got == sorted(want)
    assert sum(r.length for r in rows if r.id == 6) == 2 * next(r.doc_tokens for r in rows if r.id == 7)  # a repeated row
    for pieces in sequences.values():
        pieces.sort(key=lambda p: p.offset)
        assert [p.offset for p in pieces] == np.cumsum([0, *(p.length for p in pieces)])[:-1].tolist()
        assert sum(p.length for p in pieces) <= packing.CAPACITY


def test_digest(spark):
    for r, d in zip(
        packing.pack(documents(spark)).orderBy("sequence_id", "offset").collect(),
        packing.digest(packing.pack(documents(spark))).orderBy("sequence_id", "offset").collect(),
        strict=True,
    ):
        assert zlib.crc32(bytes(r.ids)) == d.ids_crc32 and r.length * 4 == len(r.ids)


def test_little_padding(spark):
    df = spark.createDataFrame([(i, prose(40 + 7 * (i % 60), i)) for i in range(900)], "doc_id bigint, text string").coalesce(1)
    found = packing.pack(df).groupBy("sequence_id").sum("length").collect()
    assert 1024 * len(found) <= 1.01 * sum(r[1] for r in found)


def test_window_count_rises():
    assert len(packing.windows_of([600, 600, 600], 1024)) == 3
    assert packing.windows_of([], 1024) == []
    windows = packing.windows_of([512, 512, 256, 256, 256, 256], 1024)
    assert sorted(i for w in windows for i in w) == list(range(6)) and len(windows) == 2


def test_empty(spark):
    assert packing.pack(nothing(spark)).collect() == []


def least_largest(sizes, k):
    """The smallest possible largest sum of ``k`` windows: every assignment but for the windows' names."""
    best = sum(sizes)

    def place(i, sums):
        nonlocal best
        if i == len(sizes):
            best = min(best, max(sums))
            return
        for j in sorted({s: j for j, s in enumerate(sums)}.values()):
            if sums[j] + sizes[i] < best:
                place(i + 1, [*sums[:j], sums[j] + sizes[i], *sums[j + 1 :]])

    place(0, [0] * k)
    return best


@pytest.mark.parametrize("k", [2, 3, 4])
def test_differencing_against_every_partition(k):
    """Each piece is in one window, and the largest window stays within the method's bound of four thirds of the best."""
    rng = np.random.default_rng(k)
    exact = 0
    for _ in range(60):
        sizes = rng.integers(1, 500, rng.integers(1, 10)).tolist()
        windows = packing.differencing(sizes, k)
        assert sorted(i for w in windows for i in w) == list(range(len(sizes))) and len(windows) <= k
        largest, best = max(sum(sizes[i] for i in w) for w in windows), least_largest(sizes, k)
        assert best <= largest <= 4 / 3 * best
        exact += largest == best
    assert exact > 30
