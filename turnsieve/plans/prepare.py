"""From conversation records to packed requests."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import ascii_json_length, preview
from ..operators.dedup import has_key, keep_first, with_text_digest
from ..operators.ordinals import FILE_ID_FORMAT, SOURCE_ID_FORMAT, with_ordinal, with_request_id
from ..operators.render import full_prompt, rendered_body, static_text
from ..operators.select import language_is, stored_as
from ..operators.shards import BLOCK_ROWS, file_shard_id, pack_shards, source_shard_id
from ..session import written
from .config import RunConfig

POSITION = ["source", "file_idx", "row_idx"]


@dataclass(frozen=True)
class Rules:
    """How duplicates, ids and shards are treated."""

    per_file: bool  # ids, ordinals and shards are of one file, else of the whole source
    by_id: bool  # de-duplicate by id first, and drop rows without a text key


CHAT_LOG = Rules(per_file=True, by_id=False)
ADAPTER = Rules(per_file=False, by_id=True)


def in_language_of(records: DataFrame, config: RunConfig) -> DataFrame:
    """Rows in the language of a run."""
    if config.stored_languages:
        records = records.where(stored_as(*config.stored_languages))
    return records if config.language is None else records.where(language_is(config.language))


def rendered(records: DataFrame, config: RunConfig) -> DataFrame:
    """One bounded body per conversation in the run's language, with its text key and its sizes.

    The body is cut to the caps, so it is smaller than the conversation it stands for; the unbounded first user text
    goes with it. The static prompt text is left out until the requests are written.
    """
    df = in_language_of(records, config)
    caps = (config.max_turns, config.max_user_chars, config.max_other_chars)
    df = df.withColumn("body", rendered_body(F.col("conversation"), F.col("n_turns"), *caps))
    df = with_text_digest(df, prefix=config.dedup_prefix).withColumn("_keyed", has_key(F.col("first_user"), config.dedup_prefix))
    df = df.withColumn("first_user_preview", preview(F.col("first_user")))
    before, after = static_text(config.prefix, config.suffix)
    return df.drop("conversation", "n_user_turns", "first_user").withColumns(
        {
            "prompt_chars": (F.length("body") + len(before) + len(after)).cast("bigint"),
            "prompt_json_chars": prompt_json_chars(F.col("body"), config).cast("bigint"),
        }
    )


def first_rows(df: DataFrame, rules: Rules = CHAT_LOG) -> DataFrame:
    """Keep-first on slim rows: ids, keys, positions and sizes of rendered rows. No text is shuffled for it."""
    slim = df.select(*POSITION, "id", "digest", "_keyed", "prompt_json_chars")
    if rules.by_id:
        slim = keep_first(keep_first(slim, ["source", "id"]).where("_keyed"), ["source", "digest"])
    else:
        slim = keep_first(slim, ["digest"])
    return slim.select(*POSITION, "id", "prompt_json_chars")


def survivors(records: DataFrame, config: RunConfig, rules: Rules = CHAT_LOG) -> DataFrame:
    """Language filter, keep-first, and one bounded body per conversation: the rendered rows that are first, by position."""
    df = rendered(records, config)
    return df.join(first_rows(df, rules).select(*POSITION), POSITION, "left_semi").drop("_keyed")


def prompt_json_chars(body: Column, config: RunConfig) -> Column:
    before, after = static_text(config.prefix, config.suffix)
    return ascii_json_length(body) + _json_chars(before) + _json_chars(after)


def _json_chars(text: str) -> int:
    return len(json.dumps(text)) - 2


def numbered(first: DataFrame, config: RunConfig, rules: Rules = CHAT_LOG) -> DataFrame:
    """Slim rows of the survivors with ordinal, request id and wire size."""
    scope = ["source", "file_idx"] if rules.per_file else ["source"]
    slim = first.select(*POSITION, "id", "prompt_json_chars")
    slim = with_ordinal(slim, scope)
    slim = with_request_id(
        slim, scope, fallback=FILE_ID_FORMAT if rules.per_file else SOURCE_ID_FORMAT
    )
    return slim.withColumn(
        "n_bytes",
        F.lit(config.request_overhead()) + F.length("custom_id") + F.col("prompt_json_chars"),
    ).drop("id", "prompt_json_chars")


def packed(
    slim: DataFrame, config: RunConfig, rules: Rules = CHAT_LOG, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Slim rows with their shard."""
    scope = ["source", "file_idx"] if rules.per_file else ["source"]
    carry = [c for c in ("file_idx", "row_idx", "custom_id", "n_bytes") if c not in scope]
    shards = pack_shards(
        slim,
        scope,
        max_rows=config.shard_max_requests,
        max_bytes=config.shard_max_bytes,
        block_rows=max(block_rows, config.shard_max_requests),
        carry=carry,
    )
    shard_id = (
        file_shard_id(F.col("file_idx"), F.col("shard_no"))
        if rules.per_file
        else source_shard_id(F.col("shard_no"))
    )
    return shards.withColumn("shard_id", shard_id).drop("shard_no")


def prepare(
    records: DataFrame,
    config: RunConfig,
    rules: Rules = CHAT_LOG,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Requests of one source: position, ordinal, ids, sizes, metadata and the body of the prompt.

    Keep-first, numbering and packing work on slim rows, which are written between the steps because each is read more
    than once. The rendered rows are made a second time and joined to the result by position, so a body is
    shuffled once, or not at all where the slim side is small enough for Spark to broadcast it. ``records`` is read
    twice and must give the same rows at the same positions again. The static prompt text, by far the
    longer part, is added where a prompt is used, behind the last shuffle: by :func:`request_lines`, by the
    scorer's task, or by :func:`with_prompt`.
    """
    df = rendered(records, config)
    first = written(first_rows(df, rules), "first-rows")
    plan = packed(written(numbered(first, config, rules), "numbered"), config, rules, block_rows)
    return (
        df.join(plan, POSITION)
        .withColumn("fingerprint", F.lit(config.fingerprint))
        .drop("prompt_json_chars", "digest", "_keyed")
    )


def with_prompt(requests: DataFrame, config: RunConfig) -> DataFrame:
    """The full prompt in place of its body."""
    prompt = full_prompt(F.col("body"), config.prefix, config.suffix)
    return requests.withColumn("prompt", prompt).drop("body")


def manifest(requests: DataFrame) -> DataFrame:
    """Metadata by shard and request id, without the prompt."""
    named = requests.withColumnRenamed("id", "conversation_hash")
    return named.select("shard_id", "custom_id", *schemas.MANIFEST.fieldNames())


def request_lines(requests: DataFrame, config: RunConfig) -> DataFrame:
    """Shard lines: id, nested parameters, nested metadata, and the fingerprint of the run."""
    named = requests.withColumnRenamed("id", "conversation_hash")
    prompt = full_prompt(F.col("body"), config.prefix, config.suffix)
    message = F.struct(F.lit("user").alias("role"), prompt.alias("content"))
    return named.select(
        "shard_id",
        "ordinal",
        "custom_id",
        F.struct(
            F.lit(config.model).alias("model"),
            F.lit(config.max_tokens).cast("bigint").alias("max_tokens"),
            F.parse_json(F.lit(json.dumps(config.output_config()))).alias("output_config"),
            F.array(message).alias("messages"),
        ).alias("params"),
        F.struct(*schemas.MANIFEST.fieldNames()).alias("manifest"),
        "fingerprint",
    )
