"""Selecting score rows and rebuilding the prompts they stand for by a join on the key."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import text_or_empty
from ..schemas import AXES
from .results import OK

# Default thresholds.
STRONG = 2

#: Places of one file number in a folded position; row numbers are below it.
_FILE_ROWS = 1 << 63


def passes(
    conceptual: int = STRONG,
    novelty: int = STRONG,
    well_formed: int = STRONG,
    missing_status_is_ok: bool = False,
) -> Column:
    """Threshold condition; a null score never passes."""
    status = F.col("status")
    if missing_status_is_ok:
        status = F.coalesce(status, F.lit(OK))
    return (
        (status == OK)
        & (F.col("conceptual") >= conceptual)
        & (F.col("novelty") >= novelty)
        & (F.col("well_formed") >= well_formed)
    )


def selected_keys(scores: DataFrame, order: Sequence[str], **thresholds: int) -> DataFrame:
    """One row per key among the rows that pass; the last in ``order`` wins. Partial aggregates."""
    return (
        scores.where(passes(**thresholds))
        .groupBy("key")
        .agg(F.max_by(F.struct(*AXES), F.struct(*order)).alias("_scores"))
        .select("key", "_scores.*")
    )


def first_positions(source: DataFrame, position: Sequence[str] = ("file_idx", "row_idx")) -> DataFrame:
    """Where each key occurs first.

    Reads only the key and the position. The pair is folded into one decimal that holds any two BIGINT
    numbers, so that the minimum is a hash aggregate with a partial step: of each key one value per task
    is shuffled. Numbers must not be negative.
    """
    *files, row = position
    width = F.lit(Decimal(_FILE_ROWS))
    at = F.col(row).cast("decimal(19,0)")
    if files:
        at = F.col(files[0]).cast("decimal(19,0)") * width + at
    first = source.groupBy("key").agg(F.min(at.cast("decimal(38,0)")).alias("_at"))
    parts = {row: F.col("_at") % width if files else F.col("_at")}
    if files:
        parts[files[0]] = F.floor((F.col("_at") - F.col("_at") % width) / width)
    return first.select("key", *[parts[c].cast("bigint").alias(c) for c in position])


def rebuild_prompts(
    selected: DataFrame,
    source: DataFrame,
    position: Sequence[str] = ("file_idx", "row_idx"),
) -> DataFrame:
    """Selected keys with their first source row.

    The source's slim rows are cut to the selected keys before anything is grouped; that join is a filter
    in the scan where the keys are few. The slim frames are then joined, both with unique keys, so a key
    repeated in a third of the source does no harm. The wide source is then joined by position, which is unique: it is not
    shuffled when the winners are small enough to broadcast, which the size check of Spark
    (``spark.sql.autoBroadcastJoinThreshold``) decides, and is spread evenly when they are not.
    """
    position = [*position]
    wanted = source.select("key", *position).join(selected.select("key"), "key", "left_semi")
    winners = selected.join(first_positions(wanted, position), "key").select("key", *AXES, *position)
    return source.drop("key", *AXES).join(winners, position).select(
        "key",
        "source",
        *AXES,
        *[F.col(c) for c in ("url", "title") if c in source.columns],
        "conversation",
    )


def rebuild_turns(selected: DataFrame, turns: DataFrame) -> DataFrame:
    """Rebuild from a long table: one row per turn, so that a conversation may have any length."""
    return turns.join(selected, "key")


def missing_keys(selected: DataFrame, source: DataFrame) -> DataFrame:
    return selected.join(source.select("key").distinct(), "key", "left_anti")


def rebuild_coverage(selected: DataFrame, source: DataFrame) -> DataFrame:
    """One row: keys selected, found in the source, and missing from it."""
    wanted = source.select("key").join(selected.select("key"), "key", "left_semi")
    known = wanted.distinct().withColumn("_found", F.lit(True))
    return selected.join(known, "key", "left").agg(
        F.count(F.lit(1)).alias("selected"),
        F.count_if(F.col("_found")).alias("found"),
        F.count_if(F.col("_found").isNull()).alias("missing"),
    )


def prompts_of_hits(hits: DataFrame, requests: DataFrame) -> DataFrame:
    """Prompt of each hit by shard and request id; null where the shard does not have it."""
    prompts = requests.select("shard_id", "custom_id", "prompt")
    return hits.join(prompts, ["shard_id", "custom_id"], "left")


def in_language(language: str) -> Column:
    """Case-sensitive; a missing language is the empty one."""
    return text_or_empty(F.col("language")) == language
