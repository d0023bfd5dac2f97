"""Language filters, orders, windows of rows, and seeded samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import text_or_empty
from ..schemas import AXES

# Sizes of a scan.
PAGE_ROWS = 100
ROWS_PER_PAGE = 20
SCAN_LIMIT = 50_000
ROUND_ROWS = 400
ALL_LANGUAGES = "all"


def language_is(language: str, column: str = "language") -> Column:
    """Case-blind. For files sorted or partitioned by language, ``stored_as`` can be pushed down."""
    return F.lower(text_or_empty(F.col(column))) == language.lower()


def stored_as(*spellings: str, column: str = "language") -> Column:
    """Exact spellings; reaches the Parquet reader as an IN filter."""
    return F.col(column).isin(*spellings)


def language_in(names: str, column: str = "language") -> Column:
    """A comma-separated list, case-blind; ``all`` switches the filter off, as does an empty list."""
    wanted = sorted({n.strip().lower() for n in names.split(",") if n.strip()})
    if ALL_LANGUAGES in wanted or not wanted:
        return F.lit(True)
    return F.lower(text_or_empty(F.col(column))).isin(*wanted)


def browse_order(axis: str = "conceptual", ties: Sequence[str] = ("shard_id", "custom_id")) -> list[Column]:
    """Chosen axis, then the others, all descending; ties keep the input order. ``none`` keeps it all."""
    if axis != "none" and axis not in AXES:
        raise ValueError(f"no such axis: {axis}")
    axes = [] if axis == "none" else [axis, *(a for a in AXES if a != axis)]
    return [*(F.desc(a) for a in axes), *(F.asc(t) for t in ties)]


#: Up to here a window is a top-k of its rows and all before it; a task holds so many.
TOP_ROWS = 50_000
#: Boundaries that a pass of :func:`ranked_range` tries at most.
BOUNDARIES = 63


def browse_window(
    hits: DataFrame,
    start: int = 1,
    rows: int = 1,
    axis: str = "conceptual",
    ties: Sequence[str] = ("shard_id", "custom_id"),
    top_rows: int = TOP_ROWS,
) -> DataFrame:
    """Rows from the 1-based ``start``; ``ties`` should make the order total.

    A window near the front is planned as a top-k. One that begins further back is found by counting: see
    :func:`ranked_range`, which runs some narrow passes while the plan is made.
    """
    before = max(start - 1, 0)
    if before + rows > top_rows:
        hits, before = ranked_range(hits, before, rows, axis, ties, top_rows)
    return hits.orderBy(*browse_order(axis, ties)).offset(before).limit(rows)


def _browse_key(axis: str, ties: Sequence[str]) -> Column:
    """The browsing order as one struct that grows with it: higher scores first, missing ones last."""
    axes = [] if axis == "none" else [axis, *(a for a in AXES if a != axis)]
    parts = [part for a in axes for part in (F.col(a).isNull().alias(f"no_{a}"), (-F.col(a)).alias(a))]
    return F.struct(*parts, *[F.col(t) for t in ties])


def ranked_range(
    hits: DataFrame,
    before: int,
    rows: int,
    axis: str = "conceptual",
    ties: Sequence[str] = ("shard_id", "custom_id"),
    top_rows: int = TOP_ROWS,
) -> tuple[DataFrame, int]:
    """A stretch of the order that holds the rows ``before + 1`` to ``before + rows``, and how many of it come before them.

    Each pass draws some boundaries by the hash of the order's columns, counts the rows between them with partial
    sums, and goes on with the ranges that hold the window, until these have at most ``top_rows`` rows.
    Passes read the columns of the order alone. Nothing is sorted but the last range. Rows that are equal in all
    those columns cannot be told apart and stay together.
    """
    browse_order(axis, ties)  # refuses unknown axes
    keyed = hits.withColumn("_key", _browse_key(axis, ties))
    kind = keyed.schema["_key"].dataType
    low = high = None

    def stretch() -> DataFrame:
        part = keyed if low is None else keyed.where(F.col("_key") >= low)
        return part if high is None else part.where(F.col("_key") < high)

    while True:
        keys = stretch().select("_key")
        drawn = keys.orderBy(F.xxhash64("_key"), "_key").limit(BOUNDARIES).distinct().orderBy("_key").collect()
        bounds = [_literal(r._key, kind) for r in drawn]
        if not bounds:
            return stretch().drop("_key"), before
        bucket = F.size(F.filter(F.array(*bounds), lambda b: b <= F.col("_key")))
        counts = dict(keys.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1))).collect())
        first, skipped = 0, 0
        while first < len(bounds) and skipped + counts.get(first, 0) <= before:
            skipped += counts.get(first, 0)
            first += 1
        last, held = first, counts.get(first, 0)
        while last < len(bounds) and skipped + held < before + rows:
            last += 1
            held += counts.get(last, 0)
        low, high = bounds[first - 1] if first else low, bounds[last] if last < len(bounds) else high
        before -= skipped
        if held <= top_rows or held == sum(counts.values()):
            return stretch().drop("_key"), before


def _literal(key: Sequence, kind: T.StructType) -> Column:
    return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(key, kind, strict=True)])


def sequential_scan(
    df: DataFrame, offset: int, rows: int = SCAN_LIMIT, ordinal: str = "ordinal"
) -> DataFrame:
    """Rows by number; a range filter, so files and row groups outside of it are skipped.

    As many rows as are asked for; ``SCAN_LIMIT`` is a default only. An offset below zero or past the last row is
    refused: the last number is a maximum with partial steps over that one column, which runs when this is called.
    """
    last = df.agg(F.max(ordinal)).first()[0]
    if offset < 0 or last is None or offset > last:
        raise ValueError(f"offset {offset} is out of range")
    return df.where(F.col(ordinal).between(offset, offset + rows - 1))


def _drawn(number: str, seed: int) -> Column:
    """A seeded hash that any engine has, so that a sample can be drawn again elsewhere."""
    return F.md5(F.concat_ws("_", F.col(number).cast("string"), F.lit(str(seed))))


def block_sample(
    df: DataFrame,
    pages: int,
    seed: int,
    per_page: int = ROWS_PER_PAGE,
    ordinal: str = "ordinal",
    page_rows: int = PAGE_ROWS,
) -> DataFrame:
    """Rows of ``pages`` pages drawn by a seeded hash, at most ``per_page`` of each, drawn likewise.

    Depends on the seed and the row numbers only, not on partitions. Pages are drawn from a list of
    page numbers by a top-k, and only rows of drawn pages are ranked, at most ``page_rows`` together.
    """
    numbered = df.withColumn("page", F.floor(F.col(ordinal) / page_rows).cast("bigint"))
    drawn = (
        numbered.select("page")
        .distinct()
        .orderBy(_drawn("page", seed), "page")
        .limit(pages)
    )
    rank = F.row_number().over(
        Window.partitionBy("page").orderBy(_drawn(ordinal, seed), ordinal)
    )
    return (
        numbered.join(drawn, "page", "left_semi")
        .withColumn("_rank", rank)
        .where(F.col("_rank") <= per_page)
        .drop("_rank")
    )


def first_files(df: DataFrame, files: int) -> DataFrame:
    return df.where(F.col("file_idx") < files)


def first_rows(df: DataFrame, rows: int, order: Sequence[str] = ("file_idx", "row_idx")) -> DataFrame:
    return df.orderBy(*order).limit(rows)


def first_hits(
    verdicts: DataFrame, hit: Column, rows: int = 1, order: Sequence[str] = ("ordinal",)
) -> DataFrame:
    """First rows in scan order that meet the condition; failures have null scores and never do."""
    return first_rows(verdicts.where(F.coalesce(hit, F.lit(False))), rows, order)
