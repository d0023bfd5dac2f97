"""Sinks. Each overwrites only what it is given, so a retried job leaves the same files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_shards(
    requests: DataFrame,
    folder: str,
    to_lines: Callable[[DataFrame], DataFrame],
    order: str = "ordinal",
) -> None:
    """Gzip JSON lines, one sub-folder per shard. Shards are size-capped, so one task holds one.

    ``to_lines`` makes the lines (see :func:`turnsieve.plans.prepare.request_lines`); it is applied
    behind the shuffle, which so moves the bodies of the prompts and not their static text.
    """
    arranged = requests.repartition("shard_id").sortWithinPartitions("shard_id", order)
    (
        to_lines(arranged)
        .select("shard_id", "custom_id", "params", "manifest", "fingerprint")
        .write.mode("overwrite")
        .partitionBy("shard_id")
        .option("compression", "gzip")
        .json(folder)
    )


def write_results(results: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """JSON lines by shard. In ``dynamic`` mode only the shards in the frame are replaced."""
    writer = results.withColumn("_shard", F.col("shard_id")).repartition("_shard").write
    if mode == "dynamic":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    writer.partitionBy("_shard").json(folder)


def write_manifest(manifest: DataFrame, folder: str) -> None:
    """Metadata of requests by shard, so that a reader who names shards opens theirs only."""
    manifest.repartition("shard_id").write.mode("overwrite").partitionBy("shard_id").parquet(folder)


def write_scores(scores: DataFrame, folder: str) -> None:
    """Score tables by source. Rebalanced rather than repartitioned: a source that holds most rows is
    split over many tasks, and small ones share a task."""
    scores.hint("rebalance", "source").write.mode("overwrite").partitionBy("source").parquet(folder)


def write_keyed(df: DataFrame, name: str, folder: str, buckets: int, key: str = "key") -> DataFrame:
    """A table dealt into buckets by its key, under ``folder``; joins and groups by the key need no shuffle.

    Where neither scores nor the keys of a source are small enough to broadcast, both are stored so, with one number
    of buckets, and every rebuild joins them in place.
    """
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", folder)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def rebuilt_name(source: str, conceptual: int, novelty: int, well_formed: int) -> str:
    return f"{source}_c{conceptual}n{novelty}w{well_formed}"


def write_rebuilt(
    prompts: DataFrame, folder: str, source: str, conceptual: int, novelty: int, well_formed: int
) -> str:
    path = f"{folder.rstrip('/')}/{rebuilt_name(source, conceptual, novelty, well_formed)}.jsonl"
    prompts.write.mode("overwrite").json(path)
    return path
