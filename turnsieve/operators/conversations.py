"""One row per conversation, from array columns or from a long table of turns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import text_or_empty
from ..functions.turns import first_user_content, turn, user_turn_count

POSITION = ("file_idx", "row_idx")

_LITERALS = {f.name: f.dataType for f in schemas.RECORD.fields}


def records(df: DataFrame, **columns: Column) -> DataFrame:
    """Project ``df`` to the record shape; columns not named are null.

    ``file_idx`` and ``row_idx`` give the order in which duplicates are resolved and rows numbered, so
    ``df`` must have a ``row_idx`` (see :func:`turnsieve.sources.readers.with_positions`); a missing
    ``file_idx`` means a single file. The counts and the first user text come from ``conversation``
    unless they are given.
    """
    if "row_idx" not in df.columns:
        raise ValueError("rows have no position: add row_idx, for instance by with_positions()")
    conversation = columns["conversation"]
    columns.setdefault("n_turns", F.size(conversation))
    columns.setdefault("n_user_turns", user_turn_count(conversation))
    columns.setdefault("first_user", first_user_content(conversation))
    columns.setdefault("row_idx", F.col("row_idx"))
    columns.setdefault("file_idx", F.col("file_idx") if "file_idx" in df.columns else F.lit(0))
    return df.select(
        *[
            columns.get(name, F.lit(None)).cast(dtype).alias(name)
            for name, dtype in _LITERALS.items()
        ]
    )


def assemble_conversations(
    turns: DataFrame,
    key: str = "id",
    carry: Sequence[str] = (),
    order: str = "turn",
    head_turns: int | None = None,
) -> DataFrame:
    """Conversations of a long table ``(key, order, role, content)``; turns without a key are left out.

    A conversation becomes one row with all of its turns in order, and values over all of them
    (``n_turns``, ``n_user_turns``, ``first_user``, ``first_content``). ``carry`` names metadata columns
    that are equal on all turns of a conversation; of positions the smallest is taken. The table is
    read and shuffled once.

    A caller that only renders may ask for the first ``head_turns`` turns: the counts and first texts stay
    exact, and a conversation of any length is a bounded row (see :func:`_bounded`). Conversations that
    are too long for one row are rebuilt turn by turn (``rebuild.rebuild_turns``).
    """
    turns = turns.where(F.col(key).isNotNull())
    placed = [c for c in POSITION if c in turns.columns]
    if head_turns is not None:
        return _bounded(turns, key, carry, order, placed, head_turns)
    rows = turns.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct(order, "role", "content"))).alias("_turns"),
        *([F.min(F.struct(*placed)).alias("_position")] if placed else []),
        *[F.max(c).alias(c) for c in carry],
    )
    asked = F.filter("_turns", lambda t: (t["role"] == "user") & (text_or_empty(t["content"]) != ""))
    return rows.select(
        key,
        *carry,
        *[F.col(f"_position.{c}") for c in placed],
        F.transform("_turns", lambda t: turn(t["role"], t["content"])).alias("conversation"),
        F.size("_turns").cast("bigint").alias("n_turns"),
        F.size(F.filter("_turns", lambda t: t["role"] == "user")).cast("bigint").alias("n_user_turns"),
        text_or_empty(F.get(asked, F.lit(0))["content"]).alias("first_user"),
        F.get("_turns", F.lit(0))["content"].alias("first_content"),
    )


CHUNK_TURNS = 4096


def conversation_chunks(
    turns: DataFrame, key: str = "id", order: str = "turn", chunk_turns: int = CHUNK_TURNS
) -> DataFrame:
    """Conversations of any length as ordered rows ``(key, chunk, first_turn, n_turns, conversation, turns_in_all,
    user_turns_in_all, first_user)``; turns without a key are left out.

    A chunk holds the turns whose numbers lie in one range of ``chunk_turns``, so a conversation with a third of all
    turns is shared out by ranges, and no task or row holds more of it than a chunk. What chunks have each is added
    up per conversation over slim rows, one a chunk: the number of turns before it, and what holds for all.
    """
    turns = turns.where(F.col(key).isNotNull())
    asked = (F.col("role") == "user") & (text_or_empty(F.col("content")) != "")
    cut = turns.withColumn("_range", F.floor(F.col(order) / chunk_turns)).groupBy(key, "_range")
    chunks = cut.agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct(order, "role", "content"))), lambda t: turn(t["role"], t["content"])
        ).alias("conversation"),
        F.count(F.lit(1)).alias("n_turns"),
    )
    sizes = cut.agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("role") == "user").alias("_users"),
        F.min_by("content", F.when(asked, F.col(order))).alias("_asked"),
    )
    whole = Window.partitionBy(key).orderBy("_range")
    everything = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = sizes.select(
        key,
        "_range",
        (F.row_number().over(whole) - 1).cast("bigint").alias("chunk"),
        F.coalesce(F.sum("_n").over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first_turn"),
        F.sum("_n").over(everything).alias("turns_in_all"),
        F.sum("_users").over(everything).alias("user_turns_in_all"),
        text_or_empty(F.first("_asked", ignorenulls=True).over(everything)).alias("first_user"),
    )
    return chunks.join(placed, [key, "_range"]).select(
        key, "chunk", "first_turn", "n_turns", "conversation", "turns_in_all", "user_turns_in_all", "first_user"
    )


def _bounded(
    turns: DataFrame, key: str, carry: Sequence[str], order: str, placed: Sequence[str], head_turns: int
) -> DataFrame:
    """The first turns and exact values over all.

    Both branches shrink on the map side (the rank limit and partial aggregates), so one very long
    conversation sends a few rows per task. Both are hash-partitioned by the key already, so the merge
    join adds no shuffle and nothing is broadcast.
    """
    asked = (F.col("role") == "user") & (text_or_empty(F.col("content")) != "")
    whole = turns.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.count_if(F.col("role") == "user").alias("n_user_turns"),
        F.min_by("content", F.when(asked, F.col(order))).alias("first_user"),
        F.min_by("content", order).alias("first_content"),
        *([F.min(F.struct(*placed)).alias("_position")] if placed else []),
        *[F.max(c).alias(c) for c in carry],
    )
    rank = F.row_number().over(Window.partitionBy(key).orderBy(order))
    head = (
        turns.select(key, order, "role", "content")
        .withColumn("_rank", rank)
        .where(F.col("_rank") <= head_turns)
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(F.struct("_rank", "role", "content"))).alias("_head"))
    )
    return whole.join(head.hint("merge"), key).select(
        key,
        *carry,
        *[F.col(f"_position.{c}") for c in placed],
        F.transform("_head", lambda t: turn(t["role"], t["content"])).alias("conversation"),
        "n_turns",
        "n_user_turns",
        text_or_empty(F.col("first_user")).alias("first_user"),
        "first_content",
    )
