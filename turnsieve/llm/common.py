"""What several of these operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: For ``bytes.translate`` of UTF-8: lower-cases A-Z and makes a space of every other ASCII sign but a-z and 0-9.
_WORD_BYTES = bytes(
    b if b >= 0x80 or chr(b).islower() or chr(b).isdigit() else b + 32 if chr(b).isupper() else 0x20 for b in range(256)
)


def ascii_words(text: str | None) -> list[bytes]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text whose A-Z are lower-cased, in UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores after it the first that no column has in any spelling."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate folder that no later step reads."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def numbered(df: DataFrame, scope: Sequence[str], order: Sequence[str], name: str, blocks: int = 4096) -> DataFrame:
    """Number the rows of each ``scope`` 0, 1, 2 … without gaps.

    A scope is dealt by the hash of ``order`` into ``blocks`` parts. The parts are counted, running sums
    of the counts give each part's first number, and rows are ranked within their part only, so a scope
    that holds a third of all rows is shared out. The sequence is fixed by ``order`` (hash, then value);
    rows equal in it are interchangeable.
    """
    scope, order = [*scope], [*order]
    rows = df.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
    before = Window.partitionBy(*scope).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(*scope, "_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*scope, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    rank = F.row_number().over(Window.partitionBy(*scope, "_part").orderBy(*order))
    return (
        rows.withColumn("_rank", rank)
        .join(starts, [*scope, "_part"])
        .withColumn(name, F.col("_start") + F.col("_rank") - 1)
        .select(*df.columns, name)
    )
