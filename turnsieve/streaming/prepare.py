"""Incremental, restartable preparation of files as they arrive.

What is carried from batch to batch is keyed state: of each text key the batch that first had it and the
place of its first row there, as a streaming aggregate whose store is on the executors' disks (RocksDB) and is
saved with the checkpoint. A batch looks up its own keys only, so its work does not grow with what came before it.
The aggregate is summed up per task before its shuffle, so a hot key is one slim row per task.

The rows themselves never go through the state. A batch's new keys name the files they come from;
those files are read once more, and the first rows are taken from them by their place.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import DEDUP_PREFIX
from ..operators.dedup import with_text_digest
from ..plans.config import RunConfig
from ..plans.prepare import in_language_of, prepare
from ..session import new_folder, remove, settings, written

BATCH = "bid"
FILE = "_file"
POSITION = ("file_idx", "row_idx")

#: Keeps the keys that were seen on disk, not on the heap of the executors.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

Records = Callable[[DataFrame], DataFrame]


def file_id() -> Column:
    """A number for the file a row was read from; it passes through projections and filters of the scan."""
    return F.xxhash64("_metadata.file_path")


def first_seen(keyed: DataFrame, order: Sequence[str]) -> DataFrame:
    """``(digest, first, since, last)`` per key: its first row, and when the first and the last batch had it.

    The time is that of the batch, which is written down before it runs and is the same when it is run
    again. A key is new in a batch when both times are equal.
    """
    slim = keyed.select("digest", *order, file_id().alias(FILE), F.current_timestamp().alias("at"))
    return slim.groupBy("digest").agg(
        F.min(F.struct(*order, FILE)).alias("first"), F.min("at").alias("since"), F.max("at").alias("last")
    )


def rows_of(spark: SparkSession, folder: str, schema: T.StructType, to_records: Records, files: Sequence[int]) -> DataFrame:
    """Records of the files with the given numbers, with the number; other files are not opened."""
    scan = spark.read.schema(schema).parquet(folder)
    return to_records(scan).where(file_id().isin([*files])).select("*", file_id().alias(FILE))


def stream_first(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    to_records: Records,
    keyed: Callable[[DataFrame], DataFrame],
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    order: Sequence[str] = POSITION,
    files_per_batch: int | None = None,
    state_store: str = ROCKSDB,
) -> StreamingQuery:
    """Hand the first row of every new key to ``sink(rows, batch_id)``, batch by batch.

    ``to_records`` is a projection or a filter of a scan, and so is ``keyed``, which adds ``digest``. A key is handed
    on in the first batch that has it, and of that batch its first row in ``order``, which must be total
    within a file: when files arrive in order, those are the rows of the batch operator. A batch that is
    replayed gives the same rows, so a sink that overwrites its own folder is exact.
    """

    def step(touched: DataFrame, batch_id: int) -> None:
        session = touched.sparkSession
        path = new_folder(session, "new-keys")
        fresh = written(touched.where(F.col("since") == F.col("last")).select("digest", "first.*"), "new-keys", path)
        files = [r[0] for r in fresh.select(FILE).distinct().collect()]  # some of the batch's files
        rows = keyed(rows_of(session, folder, schema, to_records, files))
        sink(rows.join(fresh.select(*order, FILE), [*order, FILE], "left_semi").drop(FILE), batch_id)
        remove(session, path)

    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    seen = first_seen(keyed(to_records(reader.parquet(folder))), order)
    with settings(
        spark,
        spark__sql__streaming__stateStore__providerClass=state_store,
        # a batch saves what it changed, not a copy of the store
        spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled="true",
    ):
        return (
            seen.writeStream.outputMode("update")
            .foreachBatch(step)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def stream_prepare_exact(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    to_records: Records,
    out: str,
    checkpoint: str,
    order: Sequence[str] = POSITION,
    files_per_batch: int | None = 1,
    prefix: int = DEDUP_PREFIX,
    state_store: str = ROCKSDB,
) -> StreamingQuery:
    """Keep the first row per text key; the same rows as the batch operator when batches come in order:
    files one by one, or, with ``files_per_batch=None``, all that have arrived since the last run.

    Every batch writes its own folder below ``out``; see :func:`stream_first`.
    """

    def sink(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/{BATCH}={batch_id}")

    def keyed(df: DataFrame) -> DataFrame:
        return with_text_digest(df, prefix=prefix)

    return stream_first(spark, folder, schema, to_records, keyed, sink, checkpoint, order, files_per_batch, state_store)


#: One row per text key, whichever order its files come in.
stream_prepare = stream_prepare_exact


def stream_prepare_shards(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    to_records: Records,
    config: RunConfig,
    out: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    state_store: str = ROCKSDB,
) -> StreamingQuery:
    """Preparation to its end, continued with every file that arrives: keep-first against all earlier files,
    rendering, numbering, packing, and the packed requests under ``out/requests``.

    Ids, ordinals and shards belong to one file, so a batch of whole files is numbered and packed by itself.
    The rows are those of :func:`turnsieve.plans.prepare.prepare` over all files when these arrive in their
    order. A replayed batch reads and writes the same.
    """

    def keyed(df: DataFrame) -> DataFrame:
        return with_text_digest(in_language_of(df, config), prefix=config.dedup_prefix)

    def sink(rows: DataFrame, batch_id: int) -> None:
        session = rows.sparkSession
        path = new_folder(session, "rows")
        first = written(rows.drop("digest"), "rows", path)
        prepare(first, config).write.mode("overwrite").parquet(f"{out}/requests/{BATCH}={batch_id}")
        remove(session, path)

    return stream_first(
        spark, folder, schema, to_records, keyed, sink, checkpoint, files_per_batch=files_per_batch, state_store=state_store
    )
