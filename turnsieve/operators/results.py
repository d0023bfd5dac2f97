"""Reading raw answers into scores, joining them to their metadata, retrying and patching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.once import computed_once
from ..schemas import AXES, RESPONSE

# Statuses and limits.
OK, REFUSAL, UNKNOWN, OUT_OF_RANGE = "ok", "refusal", "unknown", "out_of_range"
PARSE_ERROR = "parse_error: "
SUCCEEDED = "succeeded"
ERROR_TEXT_CHARS = 200
MAX_SCORE = 3
MAX_TOKENS = 300
RETRY_MAX_TOKENS = 600

KEYS = ("shard_id", "custom_id")
_PATCHED = ("status", *AXES, "reasoning", "input_tokens", "output_tokens")


def _parse_problem(parsed: Column, scores: dict[str, Column], needed: Sequence[str]) -> Column:
    """Why an answer cannot be used; null when it can. The first problem in field order is named."""
    problem = F.when(parsed.isNull(), F.lit("not valid JSON"))
    problem = problem.when(
        ~F.schema_of_variant(parsed).startswith("OBJECT"), F.lit("not a JSON object")
    )
    for axis in AXES:
        missing = F.try_variant_get(parsed, f"$.{axis}", "variant").isNull()
        problem = problem.when(missing, F.lit(f"no {axis}"))
        problem = problem.when(scores[axis].isNull(), F.lit(f"{axis} is not an integer"))
    for name in needed:
        missing = F.try_variant_get(parsed, f"$.{name}", "variant").isNull()
        problem = problem.when(missing, F.lit(f"no {name}"))
    return problem


def parse_responses(responses: DataFrame, strict: bool = False) -> DataFrame:
    """Replace the raw answer by ``status``, the three scores, ``reasoning`` and token counts.

    An answer that did not succeed keeps its type as status; a refusal is one; anything that is not a
    JSON object with three integers is a ``parse_error`` and keeps the start of its text. Integers are
    taken as loosely as Python's ``int`` takes them: numbers are cut, booleans and digit strings count.
    With ``strict`` a missing reasoning is a failure too, and failures are told in ``reasoning``.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    df = responses.withColumn("_json", F.try_parse_json(text))
    scores = {
        a: F.expr(f"try_cast(try_variant_get(_json, '$.{a}', 'bigint') as int)") for a in AXES
    }
    kind = F.coalesce(F.nullif(F.col("result_type"), F.lit("")), F.lit(UNKNOWN))
    df = df.withColumn(
        "_problem", _parse_problem(F.col("_json"), scores, ("reasoning",) if strict else ())
    )
    answered = kind == SUCCEEDED
    refused = F.coalesce(F.col("stop_reason") == REFUSAL, F.lit(False))
    status = (
        F.when(~answered, kind)
        .when(refused, F.lit(REFUSAL))
        .when(F.col("_problem").isNotNull(), F.concat(F.lit(PARSE_ERROR), F.col("_problem")))
        .otherwise(F.lit(OK))
    )
    df = df.withColumn("_status", status)
    ok = F.col("_status") == OK
    unread = F.col("_status").startswith(PARSE_ERROR)
    start = F.substring(text, 1, ERROR_TEXT_CHARS)
    reason = F.when(
        ok,
        F.when(
            F.try_variant_get("_json", "$.reasoning", "variant").isNull(), F.lit("")
        ).otherwise(F.try_variant_get("_json", "$.reasoning", "string")),
    )
    if strict:
        reason = (
            reason.when(unread, F.concat(F.lit("parse error: "), F.col("_problem"), F.lit(": "), start))
            .when(answered & refused, F.lit(REFUSAL))
            .otherwise(text)
        )
    else:
        reason = reason.when(unread, start).otherwise(F.lit(""))

    def tokens(name: str) -> Column:
        return F.when(answered, F.coalesce(F.col(name), F.lit(0))).otherwise(F.lit(0)).cast("bigint")

    made = {
        "status": F.col("_status"),
        **{a: F.when(ok, scores[a]) for a in AXES},
        "reasoning": reason,
        "input_tokens": tokens("input_tokens"),
        "output_tokens": tokens("output_tokens"),
    }
    kept = [c for c in responses.columns if c not in RESPONSE.fieldNames()]
    df = computed_once(df, **{f"_made_{name}": value for name, value in made.items()})
    return df.select(*kept, *[F.col(f"_made_{name}").alias(name) for name in made])


def check_range(results: DataFrame, highest: int = MAX_SCORE) -> DataFrame:
    """An ok row with a score outside 0..3 gets a status of its own; its scores stay for inspection."""
    outside = ~F.greatest(*AXES).between(0, highest) | ~F.least(*AXES).between(0, highest)
    return results.withColumn(
        "status",
        F.when((F.col("status") == OK) & outside, F.lit(OUT_OF_RANGE)).otherwise(F.col("status")),
    )


def attach_manifest(results: DataFrame, manifest: DataFrame) -> DataFrame:
    """Metadata of each result by shard and request id; a result without any is kept."""
    return results.join(manifest, [*KEYS], "left")


def collected(raw: DataFrame, manifest: DataFrame) -> DataFrame:
    """Raw answers as results: parsed, checked for their range, with their metadata. Batches and streams
    both go through this."""
    return attach_manifest(check_range(parse_responses(raw)), manifest)


def retry_set(results: DataFrame, requests: DataFrame, max_tokens: int = RETRY_MAX_TOKENS) -> DataFrame:
    """Requests of the rows that are not ok, with a raised token cap. Rows without a request are not
    retried; they stay in the results as they are."""
    failed = results.where(F.col("status") != OK).select(*KEYS)
    cap = F.greatest(F.coalesce(F.col("max_tokens"), F.lit(MAX_TOKENS)), F.lit(max_tokens))
    return requests.join(failed, [*KEYS], "left_semi").withColumn("max_tokens", cap.cast("bigint"))


def last_ok(retried: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """One ok retry for each request: the last in ``order``, or without one the largest by its values.
    A partial maximum, so that any number of attempts is one row per task."""
    values = F.struct(*_PATCHED)
    order = F.struct(*order) if order else values
    last = retried.where(F.col("status") == OK).groupBy(*KEYS).agg(F.max_by(values, order).alias("_new"))
    return last.select(*KEYS, *[F.col(f"_new.{c}").alias(f"_{c}") for c in _PATCHED])


def patch_results(results: DataFrame, retried: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Rows that were not ok take the values of their last ok retry; all others stay as they are. A
    request that was retried more than once still has one row."""
    new = last_ok(retried, order)
    joined = results.join(new, [*KEYS], "left")
    use = (F.col("status") != OK) & F.col("_status").isNotNull()
    # the condition reads the old status, so all columns are set in one projection
    return joined.select(
        *[
            F.when(use, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in _PATCHED else F.col(c)
            for c in results.columns
        ]
    )


def patch_counts(results: DataFrame, retried: DataFrame) -> DataFrame:
    """One row: how many rows a patch mends and how many are still failing."""
    new = retried.where(F.col("status") == OK).select(*KEYS).distinct().withColumn("_mended", F.lit(True))
    failed = results.where(F.col("status") != OK).join(new, [*KEYS], "left")
    return failed.agg(
        F.count_if(F.col("_mended")).alias("fixed"),
        F.count_if(F.col("_mended").isNull()).alias("still_failing"),
    )


def shards_to_patch(results: DataFrame, retried: DataFrame) -> DataFrame:
    """``(shard_id)`` of the shards that a patch changes; reads keys and statuses only."""
    new = retried.where(F.col("status") == OK).select(*KEYS)
    failed = results.where(F.col("status") != OK).select(*KEYS)
    return failed.join(new, [*KEYS], "left_semi").select("shard_id").distinct()


def patched_shards(results: DataFrame, retried: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Rows of only those shards that a patch changes, for a partition-wise overwrite."""
    return patch_results(results, retried, order).join(shards_to_patch(results, retried), "shard_id", "left_semi")


def pending_requests(requests: DataFrame, results: DataFrame) -> DataFrame:
    """Requests that have no result yet."""
    return requests.join(results.select(*KEYS), [*KEYS], "left_anti")


def pending_shards(shards: DataFrame, results: DataFrame) -> DataFrame:
    """Shards that no result has come from."""
    return shards.join(results.select("shard_id").distinct(), "shard_id", "left_anti")
