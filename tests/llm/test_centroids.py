import hashlib
import math

import numpy as np
import pytest

from turnsieve.llm import centroids

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, k, rounds, dims):
    """Lloyd's rounds over whole numbers, every vector against every centroid."""
    kept = [
        (i, [math.floor(256 * float(y)) for y in e])
        for i, e in rows
        if e is not None and len(e) == dims and all(y is not None and math.isfinite(y) for y in e)
    ]
    kept = [(i, x) for i, x in kept if sum(float(y) * y for y in x) < centroids.LONGEST]
    start = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)
    middle = [x for _, x in start[:k]]
    if not middle:
        return []

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(middle))

    for _ in range(rounds):
        to = [nearest(x)[1] for _, x in kept]
        for j in range(len(middle)):
            own = [x for (_, x), t in zip(kept, to, strict=True) if t == j]
            if own:
                middle[j] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    last = [nearest(x) for _, x in kept]
    total = sum(d for d, _ in last)
    per = [sum(d for d, t in last if t == j) for j in range(len(middle))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return [(i, j, d, per[j], total, digests[j]) for (i, _), (d, j) in zip(kept, last, strict=True)]


def order(rows):
    return sorted(rows, key=str)


def groups(seed, n, dims, spread):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(7, dims))
    return [(i, (middles[rng.integers(7)] + spread * rng.normal(size=dims)).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("spread", [0.05, 0.5])
@pytest.mark.parametrize("block", [50, 10_000])
def test_against_brute_force(spark, spread, block):
    rows = groups(1, 300, 8, spread)
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(3)
    found = centroids.cluster(df, k=9, rounds=4, dims=8, block=block)
    assert order(map(tuple, found.collect())) == order(plain(rows, 9, 4, 8))


def test_ties_copies_and_empty_clusters(spark):
    """Few distinct points with many copies, whose distances tie: equal first centroids leave clusters empty."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.integers(0, 2, 3)]) for i in range(60)]
    rows += rows[:5]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(2)
    found = order(map(tuple, centroids.cluster(df, k=12, rounds=5, dims=3, block=16).collect()))
    assert found == order(plain(rows, 12, 5, 3)) and len({r[1] for r in found}) < 12


def test_awkward_vectors(spark):
    """Left out: null, other lengths, null or non-finite components, too long ones. A null id is no first centroid."""
    rows = groups(5, 40, 4, 0.3) + [
        (100, None), (101, []), (102, [1.0, 2.0]), (103, [1.0, None, 2.0, 3.0]), (104, [float("nan")] * 4),
        (105, [float("inf"), 0.0, 0.0, 0.0]), (106, [3e38] * 4), (None, [0.5, 0.5, 0.5, 0.5]), (7, [9.0, 9.0, 9.0, 9.0]),
        (107, [1e6, -1e6, 1e6, 1e6]), (108, [0.0] * 4),
    ]
    df = spark.createDataFrame([(*r, None) for r in rows], SCHEMA)
    for c in ("id", "x", "cluster", "distance", "ids", "key", "digest"):
        df = df.selectExpr("*", f"'other' AS `{c}`")
    found = centroids.cluster(df, k=6, rounds=5, dims=4)
    assert found.columns == ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert order(map(tuple, found.collect())) == order(plain(rows, 6, 5, 4))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, [1.0, 2.0])]])
def test_no_centroid_no_rows(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    assert centroids.cluster(df, k=3, dims=2).collect() == []


def test_one_centroid(spark):
    rows = groups(8, 5, 2, 1.0)
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    assert order(map(tuple, centroids.cluster(df, k=1, rounds=2, dims=2).collect())) == order(plain(rows, 1, 2, 2))


def test_heaps_spare_most_vectors():
    """Apart from the first round only vectors near a border are rescanned, and assignments stay exact."""
    x = np.floor(256 * np.array([e for _, e in groups(9, 2000, 8, 0.05)])).astype(np.int64)
    middle = x[:: 2000 // 7][:7].copy()
    block, drifted = centroids.Block.new(x, 7), np.zeros(7)
    rescanned, total = [], np.zeros((7, 9), dtype=np.int64)
    for _ in range(6):
        sums, counts, n = block.step(middle, drifted)
        rescanned.append(n)
        assert (block.cluster == centroids.squared_distances(x, middle).argmin(axis=1)).all()
        total += np.c_[sums, counts]
        assert (total[:, 8] == np.bincount(block.cluster, minlength=7)).all()
        new = middle.copy()
        new[total[:, 8] > 0] = total[total[:, 8] > 0, :8] // total[total[:, 8] > 0, 8:]
        drifted, middle = drifted + centroids._drift(middle, new), new
        assert sum(map(len, block.heaps)) == 2000
    assert rescanned[0] == 2000 and rescanned[-1] < 500


def test_distances_beyond_the_exact_floats():
    rng = np.random.default_rng(2)
    x, c = rng.integers(-(1 << 26), 1 << 26, (20, 64)), rng.integers(-(1 << 26), 1 << 26, (3, 64))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, m, strict=True)) for m in c] for v in x]
    assert centroids.squared_distances(x, c).tolist() == want
