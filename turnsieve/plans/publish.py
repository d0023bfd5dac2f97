"""Published tables: scores without text, and the two hit lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rebuild import STRONG, passes
from ..operators.results import OK
from ..schemas import SCORE


def score_table(results: DataFrame, source: str | None = None) -> DataFrame:
    """Score rows of results: key, scores, status and coarse metadata; neither text nor reasoning.

    ``source`` names the source of results whose metadata has none.
    """
    label = F.col("source") if source is None else F.coalesce(F.col("source"), F.lit(source))
    named = results.withColumn("source", label).withColumnRenamed("conversation_hash", "key")
    return named.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCORE.fields]
    )


def strong_hits(results: DataFrame) -> DataFrame:
    return results.where(passes())


def conceptual_hits(results: DataFrame, least: int = STRONG) -> DataFrame:
    return results.where((F.col("status") == OK) & (F.col("conceptual") >= least))
