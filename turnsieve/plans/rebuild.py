"""From published scores back to prompts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rebuild import STRONG, rebuild_coverage, rebuild_prompts, selected_keys
from ..schemas import SCORE
from ..sources import readers, registry
from ..sources.sinks import write_rebuilt


def rebuild(
    scores: DataFrame,
    records: DataFrame,
    conceptual: int = STRONG,
    novelty: int = STRONG,
    well_formed: int = STRONG,
    order: Sequence[str] = ("ord",),
) -> tuple[DataFrame, DataFrame]:
    """``(prompts, coverage)``: thresholds first, then the last score row of a key among those that
    passed, then the first source row of each key."""
    selected = selected_keys(
        scores, order, conceptual=conceptual, novelty=novelty, well_formed=well_formed
    )
    source = records.withColumn("key", F.col("id"))
    return rebuild_prompts(selected, source), rebuild_coverage(selected, source)


def rebuild_source(
    spark: SparkSession,
    name: str,
    scores: str | list[str],
    paths: str | list[str],
    conceptual: int = STRONG,
    novelty: int = STRONG,
    well_formed: int = STRONG,
) -> tuple[DataFrame, DataFrame]:
    """From a source's name and the places of its scores and files: its schema and adapter are the
    registry's; of score rows with one key the last in the files' order counts."""
    source = registry.SOURCES[name]
    rows = readers.with_positions(readers.read_parquet(spark, scores))
    known = rows.select(
        *[F.col(f.name).cast(f.dataType) for f in SCORE.fields if f.name in rows.columns], "file_idx", "row_idx"
    )
    records = source.adapter(readers.with_positions(readers.read_parquet(spark, paths, source.schema)))
    return rebuild(known, records, conceptual, novelty, well_formed, ("file_idx", "row_idx"))


def rebuild_to(
    folder: str,
    source: str,
    scores: DataFrame,
    records: DataFrame,
    conceptual: int = STRONG,
    novelty: int = STRONG,
    well_formed: int = STRONG,
    order: Sequence[str] = ("ord",),
) -> tuple[str, DataFrame]:
    """Write the prompts as JSON lines; the folder's name carries the thresholds."""
    prompts, coverage = rebuild(scores, records, conceptual, novelty, well_formed, order)
    path = write_rebuilt(prompts, folder, source, conceptual, novelty, well_formed)
    return path, coverage
