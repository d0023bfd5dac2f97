"""Incremental collection of raw answers."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators.reports import status_bucket
from ..operators.results import attach_manifest, check_range, parse_responses
from ..session import new_folder, remove, written

BATCH = "bid"
BUCKETS = ("ok", "refusal", "error")

ANSWER = T.StructType(
    [
        T.StructField("shard_id", T.StringType()),
        T.StructField("custom_id", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        *schemas.RESPONSE.fields,
    ]
)

PROGRESS = T.StructType([T.StructField(n, T.LongType()) for n in (BATCH, "n_rows", *BUCKETS)])


def manifest_of(manifest: DataFrame, shards: list[str | None]) -> DataFrame:
    """Metadata of the given shards. A manifest stored by ``shard_id`` opens their folders only."""
    return manifest.where(F.col("shard_id").isin([s for s in shards if s is not None]))


def progress_folder(out: str) -> str:
    return f"{out.rstrip('/')}-progress"


def stream_collect(
    spark: SparkSession,
    answers: str,
    manifest: DataFrame,
    out: str,
    checkpoint: str,
    every: str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Parse answers as their files arrive, join their metadata, and store them by batch and shard below ``out``.

    Each file is taken once; the checkpoint is the list of what has been collected. A batch looks up the metadata of
    its own shards only (:func:`turnsieve.sources.sinks.write_manifest` stores them so), whose number is bounded by what
    a batch reads. It overwrites its own folder and its own row of progress, so a batch that is run again changes nothing.
    Without ``every`` the query ends when nothing is left to read, else it goes on at that interval.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        path = new_folder(session, "parsed")
        parsed = written(check_range(parse_responses(batch)), "parsed", path)
        shards = [r.shard_id for r in parsed.select("shard_id").distinct().collect()]
        results, seen = attach_manifest(parsed, manifest_of(manifest, shards)), Observation()
        bucket = status_bucket(F.col("status"))
        counted = results.observe(
            seen, F.count(F.lit(1)).alias("n_rows"), *[F.count_if(bucket == b).alias(b) for b in BUCKETS]
        )
        # one file for each shard of a batch; shards have a size cap
        counted.repartition("shard_id").write.mode("overwrite").partitionBy("shard_id").parquet(f"{out}/{BATCH}={batch_id}")
        row = session.range(1).select(*[F.lit(seen.get[n]).cast("bigint").alias(n) for n in PROGRESS.names[1:]])
        row.coalesce(1).write.mode("overwrite").parquet(f"{progress_folder(out)}/{BATCH}={batch_id}")
        remove(session, path)

    reader = spark.readStream.schema(ANSWER)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        reader.json(answers)
        .writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def progress(spark: SparkSession, out: str) -> DataFrame:
    """One row for each batch collected so far: its rows and how they ended. Survives restarts, a replay counts once."""
    return spark.read.schema(PROGRESS).parquet(progress_folder(out)).select(*PROGRESS.names)


def totals(spark: SparkSession, out: str) -> DataFrame:
    """One row: batches, rows, and rows by how they ended."""
    batches = F.count(F.lit(1)).alias("batches")
    return progress(spark, out).agg(batches, *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in PROGRESS.names[1:]])


def watch(
    start: Callable[[], StreamingQuery],
    complete: Callable[[], bool],
    pause_seconds: float = 120.0,
    max_cycles: int | None = None,
) -> int:
    """Run passes until everything is collected; the number of passes made."""
    cycles = 0
    while True:
        start().awaitTermination()
        cycles += 1
        if complete() or cycles == max_cycles:
            return cycles
        time.sleep(pause_seconds)
