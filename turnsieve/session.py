"""Session settings the operators rely on, and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings a caller is advised to put on its session.
RECOMMENDED = {
    # timestamps are written as text; keep them independent of the machine
    "spark.sql.session.timeZone": "UTC",
    # a doubled key in an answer keeps its last value instead of failing the parse
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


#: Bytes of rows that are sent to a Python worker at once.
BATCH_BYTES = 2 << 20


def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Bound the bytes of an Arrow batch on a session whose caller has not done so. Spark's own bound is 64 MB.

    A batch is held several times over (in the JVM's buffers, in the pipe, by the worker and again as its answer), and
    neither the JVM nor a worker that is used again gives all of that back. The setting is read when a plan runs, so it
    stays on the session. Rows and their order stay as they are; a row above the bound is a batch of its own.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(size))


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings for what is started inside; names have two underscores for a dot. The old values come back."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only a session whose one process is the driver gets one of its own where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="turnsieve-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own for this call, so that no two runs ever share files."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, path: str | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once, with the writer's ``options``, and read it back.

    Cuts the lineage with files that outlive any executor. Used where a costly frame is read by
    several branches of a plan (survivors of the de-duplication, scorer answers).
    """
    spark = df.sparkSession
    path = path or new_folder(spark, name)
    df.write.mode("overwrite").options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_large(df: DataFrame, name: str) -> DataFrame:
    """:func:`written` for rows of megabytes: two in a row group, each with pages of its own.

    Parquet's writer would gather a hundred rows before it looks at their size, and its reader opens a group at once.
    """
    check = {"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}
    return written(df, name, options={"parquet.block.row.count.limit": "2", **check})


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate folder that no later step reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
