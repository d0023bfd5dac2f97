import random
import zlib
from collections import Counter, defaultdict

import pytest

from turnsieve.llm import sharding

from .fixtures import documents, nothing, prose


def plain(sizes, capacity):
    bins = []
    for s in sorted((s for s, n in sizes for _ in range(n)), reverse=True):
        fits = [i for i, r in enumerate(bins) if r >= s]
        if fits:
            i = min(fits, key=lambda i: (bins[i], i))
        else:
            bins.append(capacity)
            i = len(bins) - 1
        bins[i] -= s
    return sorted(bins)


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_decreasing(seed):
    rng = random.Random(seed)
    sizes = list(Counter(rng.randint(1, 40) for _ in range(300)).items())
    runs = sharding.best_fit_decreasing(sizes, 50)
    left = defaultdict(lambda: 50)
    for s, a, b, i in runs:
        left[i] -= s * (b - a + 1)
    assert sorted(left.values()) == plain(sizes, 50)
    for s, n in sizes:
        assert sorted(k for x, a, b, _ in runs if x == s for k in range(a, b + 1)) == list(range(n))
    assert sharding.best_fit_decreasing(sizes, 50, most=3) is None and sharding.best_fit_decreasing([(60, 1)], 50) is None


def test_near_equal_with_a_large_group():
    runs = sharding.near_equal([(5000, 1), (10, 700), (3, 900)], 4)
    total = Counter()
    for s, a, b, i in runs:
        total[i] += s * (b - a + 1)
    rest = [n for n in total.values() if n != 5000]
    assert len(total) == 4 and sum(total.values()) == 5000 + 7000 + 2700 and max(rest) - min(rest) <= 20


def check(df, n):
    rows = sharding.shards(df, n=n).collect()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in df.collect())
    assert Counter((r.id, r.size, r.text_crc32) for r in rows) == want
    of, slots = defaultdict(set), defaultdict(list)
    for r in rows:
        of[(r.size, r.text_crc32)].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in of.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(n))
    return Counter({s: sum(r.size for r in rows if r.shard == s) for s in slots})


def test_shards(spark):
    check(documents(spark, clashing=True), 4)
    df = spark.createDataFrame([(i, prose(5 + i % 90, i % 400)) for i in range(900)], "doc_id bigint, text string")
    sizes = check(df, 8)
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) < 0.02 * max(sizes.values())


def test_rounded_sizes(spark):
    """Large sizes are rounded up when they are planned."""
    df = spark.createDataFrame([(i, prose(200, i)) for i in range(120)], "doc_id bigint, text string")
    rows = sharding.shards(df, n=4, significant=5).groupBy("shard").sum("size").collect()
    assert len(rows) == 4 and max(r[1] for r in rows) < 1.1 * min(r[1] for r in rows)


def test_empty(spark):
    assert sharding.shards(nothing(spark)).collect() == []
