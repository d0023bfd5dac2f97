"""Scans. Every reader takes paths and a schema; columns that a query drops are never decoded."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from .json_array import read_json_array  # noqa: F401


_SLASHES = "^[A-Za-z][A-Za-z0-9+.-]*:/+"


def read_parquet(
    spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None
) -> DataFrame:
    paths = [paths] if isinstance(paths, str) else paths
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


def with_positions(df: DataFrame, file_number: str = r"^[^0-9]*(\d+)") -> DataFrame:
    """Add ``file_idx`` and ``row_idx`` to a fresh Parquet scan.

    The file index is a number in the file's name (the first one, unless ``file_number`` says
    otherwise), so it depends neither on file times nor on the order of listing. Row indexes are
    physical and survive splits, retries and re-runs. Where two files have the same number (a folder that
    was appended to, or is partitioned), files are numbered by their place in the sorted list of paths
    instead; that list is joined as a small table. A stream sees its files one after the other and uses
    the numbers in their names.
    """
    if not df.isStreaming and _share_a_number(files := df.inputFiles(), file_number):
        # the driver and the scan spell a local path with three slashes and with one
        paths = sorted(re.sub(_SLASHES, "/", f) for f in files)
        path = F.regexp_replace("_metadata.file_path", _SLASHES, "/")
        numbers = df.sparkSession.createDataFrame(list(enumerate(paths)), "file_idx bigint, _path string")
        placed = df.select("*", path.alias("_path"), F.col("_metadata.row_index").alias("row_idx"))
        return placed.join(numbers, "_path").select(*df.columns, "file_idx", "row_idx")
    number = F.regexp_extract(F.col("_metadata.file_name"), file_number, 1)
    return df.select(
        "*",
        F.when(number == "", F.lit("0")).otherwise(number).cast("bigint").alias("file_idx"),
        F.col("_metadata.row_index").alias("row_idx"),
    )


def _share_a_number(files: list[str], file_number: str) -> bool:
    """Reads only the list of files that the driver has made for the scan."""
    found = [re.search(file_number, unquote(path.rsplit("/", 1)[-1])) for path in files]
    numbers = [int(f.group(1)) if f else 0 for f in found]
    return len({*numbers}) < len(files) or max(numbers, default=0) >= 1 << 63  # too long for a BIGINT


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Whole shard lines with ``shard_id`` from the folder name."""
    schema = T.StructType(
        schemas.SHARD_LINE.fields + [T.StructField("shard_id", T.StringType())]
    )
    return spark.read.schema(schema).json(folder)


def read_shard_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Requests and the fingerprint of their run; the manifest is not parsed."""
    return read_shards(spark, folder).select("shard_id", "custom_id", "params", "fingerprint")


def read_results(spark: SparkSession, folder: str) -> DataFrame:
    """All results under the folder: the union of the per-shard files, told apart by ``shard_id``."""
    return spark.read.schema(schemas.RESULT).json(folder).select(*schemas.RESULT.fieldNames())


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata stored by :func:`turnsieve.sources.sinks.write_manifest`."""
    keys = [T.StructField("shard_id", T.StringType()), T.StructField("custom_id", T.StringType())]
    return spark.read.schema(T.StructType([*keys, *schemas.MANIFEST.fields])).parquet(folder)


def read_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Score tables, cast to the types of :data:`turnsieve.schemas.SCORE` where files differ."""
    df = spark.read.parquet(folder)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.SCORE.fields])
