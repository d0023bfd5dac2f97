"""Reports. Each is one pass of partial aggregates; totals are rolled up from the small grouped rows,
not from second scans and not by expanding the rows themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import AXES
from .rebuild import STRONG, passes
from .results import MAX_SCORE, OK, REFUSAL

# Prices in dollars per million tokens, and the figures of an estimate.
PRICE_IN, PRICE_OUT = 1.0, 5.0
BATCH_DISCOUNT = 0.5
CHARS_PER_TOKEN = 4.0
OUTPUT_TOKENS_PER_ROW = 116


def _dollars(tokens_in: Column, tokens_out: Column, price_in: float, price_out: float) -> Column:
    return (tokens_in * price_in + tokens_out * price_out) / 1e6


def cost_estimate(
    requests: DataFrame,
    price_in: float = PRICE_IN,
    price_out: float = PRICE_OUT,
    discount: float = BATCH_DISCOUNT,
    chars_per_token: float = CHARS_PER_TOKEN,
    output_tokens: int = OUTPUT_TOKENS_PER_ROW,
) -> DataFrame:
    """From prepared requests (``prompt_chars``, ``shard_id``): rows, shards, tokens and costs."""
    totals = requests.agg(
        F.count(F.lit(1)).alias("survivors"),
        F.count_distinct("shard_id").alias("n_shards"),
        (F.coalesce(F.sum("prompt_chars"), F.lit(0)) / chars_per_token).alias("input_tokens"),
    ).withColumn("output_tokens", F.col("survivors") * output_tokens)
    cost = _dollars(F.col("input_tokens"), F.col("output_tokens"), price_in, price_out)
    return totals.select(
        "*",
        F.when(F.col("survivors") > 0, F.col("input_tokens") / F.col("survivors")).alias(
            "mean_prompt_tokens"
        ),
        (cost * discount).alias("batch_cost"),
        cost.alias("sync_cost"),
    )


def cost_actual(
    results: DataFrame, price_in: float = PRICE_IN, price_out: float = PRICE_OUT
) -> DataFrame:
    totals = results.agg(
        F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"),
        F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("output_tokens"),
    )
    cost = _dollars(F.col("input_tokens"), F.col("output_tokens"), price_in, price_out)
    return totals.withColumn("cost", cost)


def status_bucket(status: Column) -> Column:
    return F.when(status.isin(OK, REFUSAL), status).otherwise(F.lit("error"))


def status_counts(results: DataFrame) -> DataFrame:
    """Rows per shard and bucket, and per bucket in total (``is_total``, and ``shard_id`` null)."""
    counts = results.groupBy("shard_id", status_bucket(F.col("status")).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        counts.rollup("bucket", "shard_id")
        .agg(
            F.sum("n").alias("n_rows"),
            F.grouping("bucket").alias("_all"),
            (F.grouping("shard_id") == 1).alias("is_total"),
        )
        .where(F.col("_all") == 0)
        .select("shard_id", "bucket", "n_rows", "is_total")
    )


def score_histogram(results: DataFrame) -> DataFrame:
    """Rows per axis and score, failures left out. Rows are counted by their three scores together,
    of which there are few, before the axes are told apart."""
    counts = results.groupBy(*AXES).agg(F.count(F.lit(1)).alias("n"))
    return (
        counts.unpivot(["n"], [F.col(a) for a in AXES], "axis", "score")
        .where(F.col("score").isNotNull())
        .groupBy("axis", "score")
        .agg(F.sum("n").alias("n_rows"))
    )


def session_counters(verdicts: DataFrame, hit: Column) -> DataFrame:
    """One row: classified, failures, hits and tokens of scored rows."""
    return verdicts.agg(
        F.count(F.lit(1)).alias("classified"),
        F.count_if(F.col("conceptual").isNull()).alias("failures"),
        F.count_if(hit).alias("hits"),
        F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"),
        F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("output_tokens"),
    )


def run_progress(requests: DataFrame, results: DataFrame) -> DataFrame:
    """Per shard: prepared, collected, ok and failing rows, and the same for the run (``is_total``).

    Both sides are counted per shard before they are joined, so no request meets its result.
    """
    prepared = requests.groupBy("shard_id").agg(F.count(F.lit(1)).alias("prepared"))
    collected = results.groupBy("shard_id").agg(
        F.count(F.lit(1)).alias("collected"),
        F.count_if(F.col("status") == OK).alias("ok"),
    )
    counts = prepared.join(collected, "shard_id", "left").na.fill(0, ["collected", "ok"])
    return counts.rollup("shard_id").agg(
        F.sum("prepared").alias("prepared"),
        F.sum("collected").alias("collected"),
        F.sum("ok").alias("ok"),
        (F.sum("collected") - F.sum("ok")).alias("failing"),
        F.count_if(F.col("collected") > 0).alias("shards_collected"),
        F.count(F.lit(1)).alias("shards"),
        (F.grouping("shard_id") == 1).alias("is_total"),
    )


def yield_report(scores: DataFrame) -> DataFrame:
    """Per source and in total (``is_total``): rows, conceptual, strong, most novel, strong rate."""
    ok = F.col("status") == OK
    counted = {
        "n_rows": F.count(F.lit(1)),
        "conceptual_ge2": F.count_if(ok & (F.col("conceptual") >= STRONG)),
        "strong": F.count_if(passes()),
        "novelty_3": F.count_if(ok & (F.col("novelty") == MAX_SCORE)),
    }
    by_source = scores.groupBy("source").agg(*[c.alias(n) for n, c in counted.items()])
    report = by_source.rollup("source").agg(
        *[F.sum(n).alias(n) for n in counted], (F.grouping("source") == 1).alias("is_total")
    )
    return report.withColumn("strong_rate", F.col("strong") / F.col("n_rows"))


def file_report(records: DataFrame, requests: DataFrame) -> DataFrame:
    """Per source file: rows in the language, survivors and shards."""
    seen = records.groupBy("source", "file_idx").agg(F.count(F.lit(1)).alias("rows_in_language"))
    made = requests.groupBy("source", "file_idx").agg(
        F.count(F.lit(1)).alias("survivors"), F.count_distinct("shard_id").alias("n_shards")
    )
    return seen.join(made, ["source", "file_idx"], "left").na.fill(0, ["survivors", "n_shards"])
