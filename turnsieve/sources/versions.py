"""Results on disk whose shards are replaced version by version.

A version is a folder of shards, and a line for each of its shards in one file of ``commits``. That file appears at
once when it is complete, so a reader sees a version whole or not at all. A shard is read from the last version
that has it; the files of all other shards stay as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..plans.config import create_once, folder_exists
from .sinks import write_results

_STORED = T.StructType([*schemas.RESULT.fields, T.StructField("_shard", T.StringType())])


class Conflict(RuntimeError):
    """Another writer has made the version that this one was about to make."""


def _commits(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("version bigint, shard_id string").json(f"{folder}/commits")


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Versions that are whole, in order."""
    if not folder_exists(spark, f"{folder}/commits"):
        return []
    return sorted(r.version for r in _commits(spark, folder).select("version").distinct().collect())


def commit(results: DataFrame, folder: str, onto: int | None = None) -> int:
    """Store ``results`` as the version after ``onto`` (default: the last one); its number.

    Of several writers onto one version the first wins, the others get a :class:`Conflict` and leave nothing that is read.
    """
    spark = results.sparkSession
    known = versions(spark, folder)
    last = (known[-1] if known else -1) if onto is None else onto
    number = last + 1
    if number in known or not create_once(spark, f"{folder}/claims/{number}", ""):
        raise Conflict(f"version {number} of {folder} exists or is being made")
    data = f"{folder}/data/version={number}"
    write_results(results, data)
    stored = spark.read.schema(_STORED).json(data).select(F.lit(number).alias("version"), F.col("_shard").alias("shard_id"))
    stored.distinct().coalesce(1).write.mode("append").json(f"{folder}/commits")
    return number


def read_version(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The results as they were after ``version`` (default: the last one)."""
    known = [v for v in versions(spark, folder) if version is None or v <= version]
    if not known:
        raise ValueError(f"{folder} has no version")
    later, parts = set(), []
    for v in reversed(known):
        df = spark.read.schema(_STORED).json(f"{folder}/data/version={v}")
        parts.append(df.where(~F.col("_shard").isin(sorted(later))) if later else df)
        if v != known[0]:  # the shards of a patch; those of the first version are not listed
            later |= {r.shard_id for r in _commits(spark, folder).where(F.col("version") == v).collect()}
    return reduce(DataFrame.unionByName, parts).drop("_shard")
