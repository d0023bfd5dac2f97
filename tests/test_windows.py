"""Windows of rows found by counting ranges of the order, and conversations in chunks."""

import random

import pytest
from pyspark.sql import functions as F

from turnsieve.operators import select
from turnsieve.operators.conversations import assemble_conversations, conversation_chunks


def hits(spark, n, seed=1):
    rng = random.Random(seed)
    rows = [(f"s{i % 7}", f"r{i}", *(rng.choice((0, 1, 2, 3, None)) for _ in range(3))) for i in range(n)]
    rng.shuffle(rows)
    kinds = "shard_id string, custom_id string, conceptual int, novelty int, well_formed int"
    return spark.createDataFrame(rows, kinds).repartition(4)


@pytest.mark.parametrize("axis", ["conceptual", "novelty", "none"])
def test_window_against_the_whole_order(spark, axis):
    df = hits(spark, 3000)
    whole = [r.custom_id for r in df.orderBy(*select.browse_order(axis)).collect()]
    for start, rows in ((1, 10), (2700, 50), (2995, 20), (3001, 5)):
        found = select.browse_window(df, start, rows, axis, top_rows=40)
        assert [r.custom_id for r in found.collect()] == whole[start - 1 : start - 1 + rows]


def test_a_deep_window_sorts_a_small_range(spark):
    df = hits(spark, 5000, 2)
    part, before = select.ranked_range(df, 4500, 20, top_rows=100)
    assert part.count() <= 100 and 0 <= before < 100


def test_rows_that_cannot_be_told_apart(spark):
    """A third of all rows are equal in every column of the order: they stay together."""
    df = hits(spark, 300).unionByName(spark.range(150).select(
        F.lit("s0").alias("shard_id"), F.lit("same").alias("custom_id"), *[F.lit(2).alias(a) for a in ("conceptual", "novelty", "well_formed")]
    ))
    whole = [r.custom_id for r in df.orderBy(*select.browse_order()).collect()]
    for start in (1, 100, 200, 440):
        assert [r.custom_id for r in select.browse_window(df, start, 8, top_rows=10).collect()] == whole[start - 1 : start + 7]


def test_no_rows_and_unknown_axes(spark):
    assert select.browse_window(hits(spark, 10).limit(0), 500, 5, top_rows=10).collect() == []
    with pytest.raises(ValueError):
        select.ranked_range(hits(spark, 10), 1, 1, "status")


TURNS = "id string, turn long, role string, content string"


def long_turns(spark, n=1000):
    rng = random.Random(3)
    rows = [("hot", t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(n)]
    rows += [(f"c{i}", 10 * t, "user", rng.choice(("", "x", None))) for i in range(20) for t in range(i % 5 + 1)]
    rows += [(None, 0, "user", "nobody")]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, TURNS).repartition(4)


def test_chunks_hold_the_whole_conversation(spark):
    turns = long_turns(spark)
    whole = {r.id: r for r in assemble_conversations(turns).collect()}
    rows = conversation_chunks(turns, chunk_turns=64).orderBy("id", "chunk").collect()
    found = {}
    for r in rows:
        found.setdefault(r.id, []).append(r)
    assert found.keys() == whole.keys()
    for key, chunks in found.items():
        assert [c.chunk for c in chunks] == list(range(len(chunks)))
        assert [t for c in chunks for t in c.conversation] == whole[key].conversation
        at = 0
        for c in chunks:
            assert (c.first_turn, c.n_turns) == (at, len(c.conversation)) and c.n_turns <= 64
            at += c.n_turns
            assert (c.turns_in_all, c.user_turns_in_all, c.first_user) == (whole[key].n_turns, whole[key].n_user_turns, whole[key].first_user)
    assert len(found["hot"]) == 16


def test_no_group_holds_more_than_a_chunk(spark):
    """Turns are gathered by conversation and range; what is summed per conversation is one slim row a chunk."""
    plan = conversation_chunks(long_turns(spark), chunk_turns=64)._jdf.queryExecution().executedPlan().toString()
    gathered = [line for line in plan.split("\n") if "collect_list" in line]
    assert gathered and all("_range" in line for line in gathered)
