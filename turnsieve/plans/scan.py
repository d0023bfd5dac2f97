"""Scan some rows of a source, score what is new in them, and count."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import DEDUP_PREFIX
from ..operators.dedup import keep_first, with_text_digest
from ..operators.render import rendered_body, static_text
from ..operators.reports import session_counters
from ..operators.results import check_range, parse_responses
from ..operators.scoring import Scorer, score_prompts
from ..session import written

POSITION = ("file_idx", "row_idx")


@dataclass(frozen=True)
class Scan:
    """``verdicts``: one row for each candidate with its position, status, scores and ``is_hit``; ``counters``: ``(name, value)``."""

    verdicts: DataFrame
    counters: DataFrame


def _as_rows(counts: DataFrame) -> DataFrame:
    """A row of numbers as rows of name and number."""
    values = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("bigint").alias("value")) for c in counts.columns])
    return counts.select(F.inline(values))


def scan_counters(slim: DataFrame) -> DataFrame:
    """One row of counts over ``(position, digest, spoken)``: rows seen, rows drawn before, rows in other languages,
    texts seen before, candidates. Partial counts by position, then by key; no text takes part."""
    rows = slim.groupBy(*POSITION).agg(
        F.count(F.lit(1)).alias("_seen"), F.any_value("digest").alias("digest"), F.any_value("spoken").alias("spoken")
    )
    keys = rows.groupBy(F.when(F.col("spoken"), F.col("digest")).alias("_key")).agg(
        F.sum("_seen").alias("_seen"), F.count(F.lit(1)).alias("_rows")
    )
    known = F.col("_key").isNotNull()
    none = F.lit(0)
    return keys.agg(
        F.coalesce(F.sum("_seen"), none).alias("rows_seen"),
        F.coalesce(F.sum(F.col("_seen") - F.col("_rows")), none).alias("repeated_rows"),
        F.coalesce(F.sum(F.when(~known, F.col("_rows"))), none).alias("other_language"),
        F.coalesce(F.sum(F.when(known, F.col("_rows") - 1)), none).alias("duplicates"),
        F.count_if(known).alias("candidates"),
    )


def scan_and_classify(
    records: DataFrame,
    spoken: Column,
    make_scorer: Callable[[], Scorer],
    hit: Column,
    prefix: str = "",
    suffix: str = "",
    dedup_prefix: int = DEDUP_PREFIX,
    partitions: int | None = None,
) -> Scan:
    """Score the first row of every text in the asked languages among ``records``: a sample, or a stretch of a source.

    A row that was drawn twice counts once, and a text is scored where it occurs first. Which rows are candidates is
    decided on positions and keys; the conversations of those alone are rendered, and the verdicts are written before
    they are counted, so that nothing is asked twice. Failures have no scores and never hit.
    """
    keyed = with_text_digest(records.withColumn("spoken", F.coalesce(spoken, F.lit(False))), prefix=dedup_prefix)
    slim = written(keyed.select(*POSITION, "digest", "spoken"), "scanned")
    first = keep_first(slim.where("spoken"), ["digest"], POSITION).select(*POSITION)
    chosen = records.join(first, [*POSITION], "left_semi").dropDuplicates([*POSITION])
    bodies = chosen.select(*POSITION, rendered_body(F.col("conversation"), F.col("n_turns")).alias("body"))
    raw = score_prompts(bodies, make_scorer, keys=POSITION, prompt="body", static=static_text(prefix, suffix), partitions=partitions)
    raw = written(raw, "answers")
    is_hit = F.coalesce(hit, F.lit(False))
    verdicts = check_range(parse_responses(raw)).withColumn("is_hit", is_hit)
    return Scan(verdicts, _as_rows(scan_counters(slim)).unionByName(_as_rows(session_counters(verdicts, F.col("is_hit")))))
