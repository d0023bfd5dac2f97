"""Dense row numbers in file and row order, without one task seeing a whole source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import valid_id

BLOCK_ROWS = 1 << 16
SUPER_BLOCK = 1 << 12

# Shapes of made-up request ids, by file and by source.
FILE_ID_FORMAT = "row_%06d"
SOURCE_ID_FORMAT = "r%07d"


def with_ordinal(
    df: DataFrame,
    scope: Sequence[str],
    order: Sequence[str] = ("file_idx", "row_idx"),
    name: str = "ordinal",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Number rows 0, 1, 2 … within ``scope`` in the order of ``(file, row)``.

    Rows are cut into blocks of the row index. Counting gives one small row per block, running sums
    over those give the start of each block, and rows are ranked inside their block only. A block has
    at most ``block_rows`` rows however large the source is; the running sum is itself cut in two
    levels, so its largest group has one row per ``block_rows * SUPER_BLOCK`` rows of data. Scope and
    row must not be null.
    """
    file, row = order
    scope = [*scope]
    cut = [*scope, "_file", "_block"]
    rows = df.withColumn("_file", F.coalesce(F.col(file), F.lit(0))).withColumn(
        "_block", F.floor(F.col(row) / block_rows).cast("bigint")
    )
    sizes = (
        rows.groupBy(*cut)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_super", F.floor(F.col("_block") / SUPER_BLOCK).cast("bigint"))
    )
    coarse = [*scope, "_file", "_super"]
    outer = (
        Window.partitionBy(*scope)
        .orderBy("_file", "_super")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inner = Window.partitionBy(*coarse).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    supers = (
        sizes.groupBy(*coarse)
        .agg(F.sum("_n").alias("_rows"))
        .select(*coarse, F.coalesce(F.sum("_rows").over(outer), F.lit(0)).alias("_base"))
    )
    starts = (
        sizes.join(supers, coarse)
        .withColumn("_start", F.col("_base") + F.coalesce(F.sum("_n").over(inner), F.lit(0)))
        .select(*cut, "_start")
    )
    rank = F.row_number().over(Window.partitionBy(*cut).orderBy(row))
    return (
        rows.withColumn("_rank", rank)
        .join(starts, cut)
        .withColumn(name, F.col("_start") + F.col("_rank") - 1)
        .select(*df.columns, name)
    )


def with_request_id(
    df: DataFrame,
    scope: Sequence[str],
    ordinal: str = "ordinal",
    own: str = "id",
    fallback: str = FILE_ID_FORMAT,
) -> DataFrame:
    """Request id: the row's own id when it has a usable shape and is the first such in ``scope``,
    else one made of the row's ordinal. An own id that looks like a made-up one is not usable, so ids
    are unique in their scope.

    The first row of an id is found by a partial minimum and joined back by ordinal, which is unique:
    an id that a third of the rows share is never gathered in one task.
    """
    first = (
        df.where(valid_id(F.col(own)) & ~F.col(own).rlike(f"^{fallback.split('%')[0]}[0-9]+$"))
        .groupBy(*scope, own)
        .agg(F.min(ordinal).alias(ordinal))
        .select(*scope, ordinal, F.lit(True).alias("_first"))
    )
    made = F.format_string(fallback, F.col(ordinal))
    return (
        df.join(first, [*scope, ordinal], "left")
        .withColumn("custom_id", F.when(F.col("_first"), F.col(own)).otherwise(made))
        .select(*df.columns, "custom_id")
    )
