"""Failed requests once more, as one plan."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.results import (
    RETRY_MAX_TOKENS,
    check_range,
    parse_responses,
    patch_results,
    retry_set,
    shards_to_patch,
)
from ..operators.scoring import Scorer, score_prompts
from ..session import written
from ..sources import versions


def retry_failed(
    results: DataFrame,
    requests: DataFrame,
    make_scorer: Callable[[], Scorer],
    prompt: str = "prompt",
    static: tuple[str, str] = ("", ""),
    max_tokens: int = RETRY_MAX_TOKENS,
    partitions: int | None = None,
) -> DataFrame:
    """``results`` with the rows that were not ok scored again, where that went well.

    Answers are written before they are used, so a lost executor does not ask twice. Ok rows are never asked
    again: a second call retries what is still failing and changes nothing else.
    """
    todo = retry_set(results, requests, max_tokens)
    raw = written(score_prompts(todo, make_scorer, prompt=prompt, static=static, partitions=partitions), "retries")
    return patch_results(results, check_range(parse_responses(raw)))


def patch_on_disk(spark: SparkSession, folder: str, retried: DataFrame, order: Sequence[str] = ()) -> int | None:
    """Replace the shards that a patch changes by a new version of them; its number, or none if nothing changes.

    Other shards are not rewritten. A patch made on a version that is no longer the last is refused
    (:class:`turnsieve.sources.versions.Conflict`) and can be made again.
    """
    last = versions.versions(spark, folder)[-1]
    now = versions.read_version(spark, folder, last)
    changed = [r.shard_id for r in shards_to_patch(now, retried).collect()]
    if not changed:
        return None
    named = F.col("shard_id").isin(changed)
    return versions.commit(patch_results(now.where(named), retried.where(named), order), folder, onto=last)


def retry_on_disk(
    spark: SparkSession,
    folder: str,
    requests: DataFrame,
    make_scorer: Callable[[], Scorer],
    prompt: str = "prompt",
    static: tuple[str, str] = ("", ""),
    max_tokens: int = RETRY_MAX_TOKENS,
    partitions: int | None = None,
) -> int | None:
    """Score the failed rows of the stored results once more and replace the shards where that went well."""
    todo = retry_set(versions.read_version(spark, folder), requests, max_tokens)
    raw = written(score_prompts(todo, make_scorer, prompt=prompt, static=static, partitions=partitions), "retries")
    return patch_on_disk(spark, folder, check_range(parse_responses(raw)))
