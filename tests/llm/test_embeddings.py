import re

import numpy as np
import pytest

from turnsieve.llm import embeddings

KINDS = "vec_id bigint, embedding array<float>, label int, node bigint, weight string"


def plain(rows):
    ok = {}
    for i, v, label in rows:
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i] = (np.asarray(v, dtype=np.float32).astype(float), label)
    links = {i: 0 for i, _, _ in rows}
    root = {i: i for i in links}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (a, la) in ok.items():
        for j, (b, lb) in ok.items():
            if i < j and la == lb and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.93:
                links[i] += 1
                links[j] += 1
                root[max(top(i), top(j))] = min(top(i), top(j))
    return {i: (links[i], top(i)) for i in links}


def vectors(n, seed):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(12, 16))
    out = []
    for i in range(n):
        v = middles[i % 12] + rng.normal(scale=0.08, size=16) if i % 3 else rng.normal(size=16)
        out.append((i, [float(x) for x in v], i % 2))
    for i in range(30):
        out.append((n + i, out[4][1], 0))  # copies of one vector
    return out


@pytest.mark.parametrize(("shard", "block"), [(8192, 2048), (60, 25)])
def test_against_brute_force(spark, shard, block):
    rows = vectors(400, 3)
    df = spark.createDataFrame([(*r, 0, "other") for r in rows], KINDS).repartition(3)
    found = {r.id: (r.n_links, r.component) for r in embeddings.near_duplicates(df, shard=shard, block=block).collect()}
    want = plain(rows)
    total = sum(n for n, _ in want.values())
    assert sum(n for n, _ in found.values()) >= 0.99 * total
    assert all(found[i][0] <= want[i][0] for i in want)
    assert np.mean([found[i][1] == want[i][1] for i in want]) > 0.98


def test_awkward_rows(spark):
    nan = float("nan")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1),
        (7, [1.0, None], 1), (8, [1.0, 0.0, 0.0], 1), (9, [], 1), (10, [1.0, 0.0], 2), (11, [1e-20, 0.0], 1), (12, [1e30, 1e29], 1),
        (13, [float("inf"), 1.0], 1), (14, [-1.0, 0.0], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    found = {r.id: (r.n_links, r.component) for r in embeddings.near_duplicates(df).collect()}
    assert found == plain(rows)
    twice = embeddings.near_duplicates(df.union(df.where("vec_id = 1"))).where("id = 1").collect()
    assert [(r.n_links, r.component) for r in twice] == [(found[1][0] + 1, 1)] * 2
    assert embeddings.near_duplicates(df.where("false")).collect() == []


def test_graph_is_kept(spark):
    x = embeddings._unit([v for _, v, _ in vectors(200, 5)])
    graph = embeddings.Graph.built(x)
    beam, recall = graph.audited_beam(0.93)
    assert recall >= embeddings.RECALL
    again = embeddings.Graph.unpacked(*graph.packed(), graph.entry, 16)
    for i in range(0, 200, 9):
        assert set(graph.linked(x[i], i, beam, 0.93)) == set(again.linked(x[i], i, beam, 0.93))


def test_a_graph_that_cannot_be_walked_is_compared_whole(spark):
    """Without links between its nodes no beam passes the audit: the shard has no beam, and all links are found."""
    x = embeddings._unit([v for _, v, _ in vectors(120, 8)])
    torn = embeddings.Graph(x, [{n: np.zeros(0, dtype=np.int64) for n in range(len(x))}], 0)
    assert torn.audited_beam(0.93) == (0, 1.0)
    for i in range(0, len(x), 7):
        assert set(torn.linked(x[i], i, 0, 0.93)) == set(np.flatnonzero(x @ x[i] >= 0.93))


def test_queries_meet_graphs_by_shard_and_part(spark):
    df = spark.createDataFrame([(*r, 0, "other") for r in vectors(60, 3)], KINDS)
    groups = []
    write = embeddings.written

    def watched(frame, name, path=None):
        if name == "found":
            groups.append(frame._jdf.queryExecution().executedPlan().toString())
        return write(frame, name, path)

    embeddings.written = watched
    try:
        embeddings.near_duplicates(df, shard=20, block=5).collect()
    finally:
        embeddings.written = write
    assert "FlatMapCoGroups" in groups[0]
    assert len(re.findall(r"hashpartitioning\(label#\d+, dim#\d+, shard#\d+, part#\d+", groups[0])) == 2
