import random

import pytest
from pyspark.sql import functions as F

from turnsieve.operators import ordinals, shards


def greedy(sizes, max_rows, max_bytes):
    """Brute force: fill one shard after the other."""
    out, number, rows, total = [], -1, 0, 0
    for size in sizes:
        if number < 0 or rows == max_rows or total + size > max_bytes:
            number, rows, total = number + 1, 0, 0
        rows, total = rows + 1, total + size
        out.append(number)
    return out


def packed(spark, sizes_by_scope, **caps):
    rows = [(s, i, n) for s, sizes in sizes_by_scope.items() for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "source string, ordinal long, n_bytes long").repartition(5)
    out = shards.pack_shards(df, ["source"], **caps).collect()
    found = {}
    for r in sorted(out, key=lambda r: r.ordinal):
        found.setdefault(r.source, []).append(r.shard_no)
    return found


@pytest.mark.parametrize("seed", range(4))
def test_blocks_give_the_greedy_result(spark, seed):
    rng = random.Random(seed)
    sizes = {
        "a": [rng.choice([1, 5, 20, 99, 150]) for _ in range(rng.randrange(60, 240))],
        "b": [rng.randrange(1, 40) for _ in range(37)],
        "c": [1000],
        "d": [1] * 64,
    }
    caps = dict(max_rows=rng.choice([1, 3, 8]), max_bytes=100)
    got = packed(spark, sizes, block_rows=8, run_blocks=3, **caps)
    assert got == {s: greedy(v, caps["max_rows"], caps["max_bytes"]) for s, v in sizes.items()}


def test_caps_at_their_edges(spark):
    sizes = {"exact": [50, 50, 1], "over": [50, 51], "big": [1, 500, 1], "rows": [0] * 10}
    got = packed(spark, sizes, max_rows=4, max_bytes=100, block_rows=4, run_blocks=2)
    assert got == {
        "exact": [0, 0, 1], "over": [0, 1], "big": [0, 1, 2], "rows": [0, 0, 0, 0, 1, 1, 1, 1, 2, 2],
    }


def test_row_cap_of_ten_thousand(spark):
    got = packed(spark, {"a": [1] * 20_001}, max_bytes=1 << 40, block_rows=10_000)
    assert [got["a"].count(i) for i in range(3)] == [10_000, 10_000, 1]


def test_no_rows(spark):
    df = spark.createDataFrame([], "source string, ordinal long, n_bytes long")
    assert shards.pack_shards(df, ["source"]).count() == 0


def test_ordinals_are_dense_over_gaps_and_files(spark):
    rng = random.Random(1)
    rows = [(s, f, r) for s in "xy" for f in range(3) for r in sorted(rng.sample(range(5000), 70))]
    df = spark.createDataFrame(rows, "source string, file_idx long, row_idx long").repartition(7)
    whole = ordinals.with_ordinal(df, ["source"], block_rows=16).collect()
    for s in "xy":
        order = sorted((r.file_idx, r.row_idx, r.ordinal) for r in whole if r.source == s)
        assert [o for *_, o in order] == list(range(210))
    per_file = ordinals.with_ordinal(df, ["source", "file_idx"], block_rows=16).collect()
    assert sorted(r.ordinal for r in per_file if (r.source, r.file_idx) == ("x", 1)) == list(range(70))


def test_request_ids(spark):
    rows = [
        ("s", 0, 0, "a"), ("s", 0, 1, "a"), ("s", 0, 2, "bad id"), ("s", 0, 3, None), ("s", 0, 4, "x" * 65),
        ("s", 1, 0, "a"), ("s", 1, 1, ""), ("s", 1, 2, "b\n"), ("s", 1, 3, "x" * 64),
    ]
    df = spark.createDataFrame(rows, "source string, file_idx long, row_idx long, id string")
    scope = ["source", "file_idx"]
    out = ordinals.with_request_id(ordinals.with_ordinal(df, scope), scope).orderBy("file_idx", "row_idx")
    assert [r.custom_id for r in out.collect()] == [
        "a", "row_000001", "row_000002", "row_000003", "row_000004", "a", "row_000001", "row_000002", "x" * 64,
    ]
    whole = ordinals.with_request_id(
        ordinals.with_ordinal(df, ["source"]), ["source"], fallback=ordinals.SOURCE_ID_FORMAT
    ).orderBy("file_idx", "row_idx")
    assert [r.custom_id for r in whole.collect()][5:8] == ["r0000005", "r0000006", "r0000007"]


def test_repeated_id_is_not_gathered(spark):
    df = spark.range(1000).select(
        F.lit("s").alias("source"), F.lit(0).alias("file_idx"), F.col("id").alias("row_idx"),
        F.lit("same").alias("id"),
    )
    out = ordinals.with_request_id(ordinals.with_ordinal(df, ["source"]), ["source"])
    assert "partial_min(" in out._jdf.queryExecution().executedPlan().toString()
    assert out.where("custom_id = 'same'").count() == 1
    assert out.select("custom_id").distinct().count() == 1000
