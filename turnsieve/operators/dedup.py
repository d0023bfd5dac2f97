"""Keep-first de-duplication.

``row_number() = 1`` is planned with a rank limit before the shuffle, so of each key at most one row
per task travels: a key that holds a third of all rows costs no more than any other. Keys are compared
by a 16-byte digest, and ``order`` must be a total order, which makes the result independent of
partitioning and safe to recompute.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import DEDUP_PREFIX, dedup_key, key_digest, text_or_empty

POSITION = ("file_idx", "row_idx")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = POSITION) -> DataFrame:
    """First row of each key in ``order``; a null key is a key like any other."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def has_key(text: Column, prefix: int = DEDUP_PREFIX) -> Column:
    return dedup_key(text_or_empty(text), prefix) != ""


def with_text_digest(
    df: DataFrame,
    text: Column | None = None,
    prefix: int = DEDUP_PREFIX,
    keep_empty_key: bool = True,
    name: str = "digest",
) -> DataFrame:
    """Add the digest of the de-duplication key; optionally drop rows whose key is empty."""
    key = dedup_key(text_or_empty(F.col("first_user") if text is None else text), prefix)
    if not keep_empty_key:
        df = df.where(key != "")
    return df.withColumn(name, key_digest(key))


def keep_first_text(
    df: DataFrame,
    order: Sequence[str] = POSITION,
    text: Column | None = None,
    prefix: int = DEDUP_PREFIX,
    keep_empty_key: bool = True,
) -> DataFrame:
    """First row per normalised start of the first user text (chat-log rule: one empty key stays)."""
    keyed = with_text_digest(df, text, prefix, keep_empty_key)
    return keep_first(keyed, ["digest"], order)


def keep_first_by_id_then_text(
    df: DataFrame,
    order: Sequence[str] = POSITION,
    prefix: int = DEDUP_PREFIX,
    scope: Sequence[str] = ("source",),
) -> DataFrame:
    """Adapter rule: first per id, then, of what is left, first per non-empty text key.

    A row that loses by id does not claim its text key, so the two steps cannot be merged. Both work on slim rows
    (scope, id, digest, position); the whole rows are joined by position afterwards, which with the scope must be
    unique and not null, so they are shuffled once at most. ``df`` is read twice.
    """
    keyed = with_text_digest(df, prefix=prefix)
    slim = keyed.select(*scope, *order, "id", "digest", has_key(F.col("first_user"), prefix).alias("_keyed"))
    first = keep_first(keep_first(slim, [*scope, "id"], order).where("_keyed"), [*scope, "digest"], order)
    return keyed.join(first.select(*scope, *order), [*scope, *order], "left_semi")


def keep_first_unseen(
    df: DataFrame,
    seen: DataFrame,
    order: Sequence[str] = POSITION,
    text: Column | None = None,
    prefix: int = DEDUP_PREFIX,
) -> DataFrame:
    """Keep-first among new rows, leaving out keys that earlier runs have kept.

    Keep-first runs before the anti join, so a hot key is one row when it is joined.
    """
    first = keep_first_text(df, order, text, prefix)
    return first.join(seen.select("digest"), "digest", "left_anti")


def scan_counters(
    df: DataFrame,
    spoken: Column,
    text: Column | None = None,
    prefix: int = DEDUP_PREFIX,
) -> DataFrame:
    """One row: rows seen, rows in other languages, duplicates, candidates.

    Rows are counted per digest with partial aggregates; no row is numbered and no text is shuffled.
    """
    keyed = with_text_digest(df.withColumn("_spoken", spoken), text, prefix)
    sizes = (
        keyed.withColumn("_key", F.when(F.col("_spoken"), F.col("digest")))
        .groupBy("_key")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    known = F.col("_key").isNotNull()
    return sizes.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_seen"),
        F.coalesce(F.sum(F.when(~known, F.col("_n"))), F.lit(0)).alias("other_language"),
        F.coalesce(F.sum(F.when(known, F.col("_n") - 1)), F.lit(0)).alias("duplicates"),
        F.count_if(known).alias("candidates"),
    )
