"""Registered queries: each runs one operator, or a chain of them, over the given tables.

Results are flat: integers are BIGINT, fractions are rounded, timestamps are text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..functions import turns as tn
from ..functions.keys import natural_key, valid_id
from ..operators import conversations as cv
from ..operators import dedup, ordinals, rebuild, render, reports, results, scoring, select, shards
from ..operators.conversations import assemble_conversations
from ..plans import config, publish, retry, scan
from ..plans import prepare as prep
from ..plans import rebuild as plan_rebuild
from ..schemas import AXES, RESULT, SHARED_CHAT
from ..session import configure, new_folder, settings, written
from ..sources import adapters, readers, registry, sinks, versions
from ..streaming import collect as st_collect
from ..streaming import prepare as st_prepare
from . import frames as fr

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flat(fn(configure(spark), sf_dir))

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__.removesuffix("_query")] = run
    return fn


def flat(df: DataFrame) -> DataFrame:
    whole = (T.ByteType, T.ShortType, T.IntegerType)
    return df.select(
        *[
            F.col(f.name).cast("bigint").alias(f.name)
            if isinstance(f.dataType, whole)
            else F.round(f.name, 6).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def joined(conversation: str = "conversation") -> Column:
    """All shown turns as one text, to compare conversations by value."""
    return F.array_join(
        F.transform(
            conversation, lambda t: F.concat(t["role"], F.lit(": "), tx.text_or_empty(t["content"]))
        ),
        "\n",
    )


# -- scans and conversations ---------------------------------------------------------------------


@query
def scan_with_ordinals(spark, sf_dir):
    """Physical row positions, and dense numbers per language without a global sort."""
    df = readers.read_parquet(spark, f"{sf_dir}/documents.parquet").select("doc_id", "lang", "_metadata")
    placed = readers.with_positions(df).drop("_metadata")
    return ordinals.with_ordinal(placed, ["lang"]).select("doc_id", "lang", "row_idx", "ordinal")


@query
def assemble_conversations_query(spark, sf_dir):
    """Long table to conversations, with first user text and turn counts."""
    df = assemble_conversations(fr.chat_turns(spark, sf_dir, blanks=True))
    return df.select(
        "id", "row_idx", "n_turns", "n_user_turns", "first_user", "first_content",
        joined().alias("head"),
    )


@query
def assemble_long_conversations(spark, sf_dir):
    """Conversations of dozens of turns; none is cut."""
    df = assemble_conversations(fr.long_chat_turns(spark, sf_dir))
    return df.select("id", "row_idx", "n_turns", "n_user_turns", "first_user", joined().alias("conversation"))


@query
def assemble_heads(spark, sf_dir):
    """Their first twenty turns, with counts and first texts over all."""
    df = assemble_conversations(fr.long_chat_turns(spark, sf_dir), head_turns=20)
    return df.select("id", "row_idx", "n_turns", "n_user_turns", "first_user", "first_content", joined().alias("head"))


@query
def scan_appended_folder(spark, sf_dir):
    """Positions in a folder that was written in two goes and is partitioned: files share their numbers, rows no position."""
    folder, df = new_folder(spark, "appended"), fr.documents(spark, sf_dir)
    for rest in (0, 1):
        df.where(F.col("doc_id") % 2 == rest).write.mode("append").partitionBy("lang").parquet(folder)
    placed = readers.with_positions(readers.read_parquet(spark, folder))
    return placed.groupBy("file_idx", "row_idx").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("doc_id").alias("doc_id"), F.min("lang").alias("lang")
    ).select("doc_id", "lang", "n_rows")


@query
def conversation_chunks(spark, sf_dir):
    """Conversations of many turns as ordered rows of a few turns each, with what holds for the whole."""
    chunks = cv.conversation_chunks(fr.long_chat_turns(spark, sf_dir), chunk_turns=1000)
    return chunks.withColumn("conversation", joined())


@query
def map_roles(spark, sf_dir):
    df = fr.sender_turns(spark, sf_dir)
    return df.select(
        "id", "turn", tn.mapped_role(F.col("from")).alias("role"),
        tx.text_or_empty(F.col("value")).alias("content"),
    )


@query
def drop_blank_turns(spark, sf_dir):
    rules = adapters.ChatRules("chat")
    df = adapters.normalised_turns(fr.chat_turns(spark, sf_dir, blanks=True), rules)
    return df.select("id", "turn", "role", "content")


@query
def user_turns_only(spark, sf_dir):
    rules = adapters.ChatRules("chat", user_only=True, drop_blank=False)
    df = adapters.normalised_turns(fr.chat_turns(spark, sf_dir, blanks=True), rules)
    return df.select("id", "turn", "role", "content")


@query
def fallback_conversation(spark, sf_dir):
    """Question and answer rows, rebuilt from two text columns where they have no turns."""
    df = adapters.qa_with_fallback(fr.question_pairs(spark, sf_dir))
    df = _with_first_row(df.select("id", "source", "row_idx", "n_turns", "title", joined().alias("conversation")))
    return df.select("source", "row_idx", "n_turns", "title", "conversation", "key_chars", "first_row")


def _with_first_row(df: DataFrame) -> DataFrame:
    """The length of each row's digest, and the first row that has the same; the digest is made once."""
    df = written(df, "keys")
    first = df.groupBy("id").agg(F.min("row_idx").alias("first_row"))
    return df.join(first, "id").withColumn("key_chars", F.length("id"))


def _block_values() -> tuple[Column, T.DataType]:
    dtype = T.ArrayType(
        T.StructType([T.StructField("type", T.StringType()), T.StructField("text", T.StringType())])
    )

    def block(kind: str, text) -> Column:
        return F.struct(F.lit(kind).alias("type"), F.lit(text).cast("string").alias("text"))

    return (
        F.array(
            F.struct(F.lit("text").alias("type"), F.col("content").alias("text")),
            block("image", None),
            block("text", None),
        ).cast(dtype),
        dtype,
    )


@query
def flatten_blocks(spark, sf_dir):
    """Block content as typed arrays, and as VARIANT that is a string or a list by turn."""
    blocks, dtype = _block_values()
    df = fr.chat_turns(spark, sf_dir).withColumn("typed", blocks)
    mixed = F.when(F.col("turn") % 2 == 0, F.to_json("typed")).otherwise(
        F.to_json(F.to_variant_object(F.struct("content")))
    )
    df = df.withColumn("loose", F.parse_json(mixed))
    loose = F.when(F.col("turn") % 2 == 0, F.col("loose")).otherwise(
        F.variant_get("loose", "$.content", "variant")
    )
    return df.withColumn("loose", loose).select(
        "id", "turn",
        tn.blocks_text(F.col("typed"), dtype).alias("typed"),
        tn.blocks_text(F.col("loose"), T.VariantType()).alias("loose"),
    )


@query
def repair_stringified_turns(spark, sf_dir):
    """Turns read back from the printed form of an array, both quotes."""
    df = fr.documents(spark, sf_dir).withColumn("printed", fr.printed_conversation())
    return df.select("doc_id", F.posexplode(tn.printed_turns(F.col("printed")))).select(
        "doc_id", F.col("pos").alias("turn"), F.col("col.role"), F.col("col.content")
    )


@query
def html_to_text(spark, sf_dir):
    df = fr.table(spark, sf_dir, "pages")
    return tx.with_html_text(df.select("page_id", "html"), "html", "text").select("page_id", "text")


# -- adapters --------------------------------------------------------------------------------------

RECORD_COLUMNS = ("source", "row_idx", "n_turns", "first_user", "title", "language", "src_model")


@query
def forum_flagged(spark, sf_dir):
    df = adapters.forum_flagged(fr.nested_posts(spark, sf_dir))
    return df.select("id", *RECORD_COLUMNS, "url", "base_score", "timestamp")


@query
def forum_interrogative(spark, sf_dir):
    df = adapters.forum_interrogative(fr.forum_posts(spark, sf_dir))
    return df.select("id", *RECORD_COLUMNS, "url", "base_score", "timestamp")


def _preference_chat(spark, sf_dir):
    turns = fr.chat_turns(spark, sf_dir, blanks=True)
    turns = turns.withColumn("conversation_type", fr.pick(F.col("row_idx"), "guided", "open", None))
    return adapters.chat_records_from_turns(turns, adapters.PREFERENCE_CHAT)


def _shared_chat(spark, sf_dir):
    turns = fr.sender_turns(spark, sf_dir, blanks=True)
    return adapters.chat_records_from_turns(turns, adapters.SHARED_CHAT)


def _gated_chat(spark, sf_dir):
    turns = fr.chat_turns(spark, sf_dir, blanks=True).withColumns(
        {"language": fr.chat_language(), "model": F.concat(F.lit("model-"), F.col("row_idx") % 3)}
    )
    return adapters.chat_records_from_turns(turns, adapters.GATED_CHAT)


def _tree_roots(spark, sf_dir):
    return adapters.tree_roots(fr.messages(spark, sf_dir))


def _qa_site(spark, sf_dir):
    turns = fr.sender_turns(spark, sf_dir, blanks=True)
    return adapters.chat_records_from_turns(turns, adapters.qa_site_rules("law"), text_key=True)


@query
def preference_chat(spark, sf_dir):
    return _preference_chat(spark, sf_dir).select(
        "id", *RECORD_COLUMNS, "conversation_type", joined().alias("conversation")
    )


@query
def shared_chat(spark, sf_dir):
    return _shared_chat(spark, sf_dir).select("id", *RECORD_COLUMNS, joined().alias("conversation"))


@query
def gated_chat(spark, sf_dir):
    return _gated_chat(spark, sf_dir).select("id", *RECORD_COLUMNS, joined().alias("conversation"))


@query
def tree_roots(spark, sf_dir):
    return _tree_roots(spark, sf_dir).select("id", *RECORD_COLUMNS)


@query
def qa_site(spark, sf_dir):
    """Any site of the question-and-answer dumps; its key has no SQL form and is left out."""
    return _qa_site(spark, sf_dir).select(*RECORD_COLUMNS, joined().alias("conversation"))


def _arena_blocks(spark, sf_dir):
    blocks, _ = _block_values()
    df = fr.documents(spark, sf_dir).withColumn("content", F.col("text"))
    return df.select(
        F.col("doc_id").alias("row_idx"),
        F.concat(F.lit("doc_"), F.col("doc_id")).alias("id"),
        F.array(
            F.struct(F.lit("user").alias("role"), blocks.alias("content")),
            F.struct(F.lit("assistant").alias("role"), blocks.alias("content")),
        ).alias("conversation_a"),
        fr.document_language().alias("language"),
    )


@query
def arena_chat(spark, sf_dir):
    df = adapters.arena(_arena_blocks(spark, sf_dir), adapters.ARENA["arena_140k"])
    return df.select("id", *RECORD_COLUMNS)


def _arena_printed(spark, sf_dir) -> DataFrame:
    return fr.documents(spark, sf_dir).select(
        F.col("doc_id").alias("row_idx"),
        F.concat(F.lit("doc_"), F.col("doc_id")).alias("id"),
        fr.printed_conversation().alias("conversation_a"),
        fr.document_language().alias("language"),
    )


@query
def arena_chat_printed(spark, sf_dir):
    return registry.source_records("arena_expert", _arena_printed(spark, sf_dir)).select("id", *RECORD_COLUMNS)


def _stored(spark, sf_dir, name: str) -> DataFrame:
    """A source with arrays of turns, through the adapter that the registry has for its name."""
    if name in ("prism", "lmsys"):
        df = fr.stored_chats(spark, sf_dir).withColumnRenamed("id", "conversation_id")
    else:
        df = fr.stored_chats(spark, sf_dir, "from", "value").withColumnRenamed("turns", "conversations")
    if name == "prism":
        df = df.withColumnRenamed("turns", "conversation_history").withColumns(
            {
                "conversation_type": fr.pick(F.col("row_idx"), "guided", "open", None),
                "generated_datetime": F.lit(None).cast("timestamp"),
            }
        )
    if name == "lmsys":
        df = df.withColumnRenamed("turns", "conversation").withColumns(
            {"language": fr.chat_language(), "model": F.concat(F.lit("model-"), F.col("row_idx") % 3)}
        )
    return registry.source_records(name, df)


@query
def prism_source(spark, sf_dir):
    df = _stored(spark, sf_dir, "prism")
    return df.select("id", *RECORD_COLUMNS, "conversation_type", joined().alias("conversation"))


@query
def sharegpt_source(spark, sf_dir):
    return _stored(spark, sf_dir, "sharegpt").select("id", *RECORD_COLUMNS, joined().alias("conversation"))


@query
def read_json_array_source(spark, sf_dir):
    """Conversations stored as one JSON array in one file, read back in parallel byte ranges."""
    stored = fr.stored_chats(spark, sf_dir, "from", "value").withColumnRenamed("turns", "conversations")
    numbered = stored.select("row_idx", F.to_json(F.struct("id", "conversations")).alias("json"))
    ends = stored.agg(F.min("row_idx"), F.max("row_idx")).first()
    opened = F.when(F.col("row_idx") == ends[0], "[").otherwise(",")
    closed = F.when(F.col("row_idx") == ends[1], "]").otherwise("")
    folder = new_folder(spark, "array")
    lines = numbered.select("row_idx", F.concat(opened, F.col("json"), closed).alias("value"))
    lines.coalesce(1).sortWithinPartitions("row_idx").select("value").write.text(folder)
    with settings(spark, spark__sql__files__maxPartitionBytes="64k"):
        rows = readers.read_json_array(spark, folder, SHARED_CHAT)
    records = registry.source_records("sharegpt", rows)
    return records.select("id", *RECORD_COLUMNS, joined().alias("conversation"))


@query
def lmsys_source(spark, sf_dir):
    return _stored(spark, sf_dir, "lmsys").select("id", *RECORD_COLUMNS, joined().alias("conversation"))


@query
def qa_site_source(spark, sf_dir):
    """The key is a digest: told by its length and by the first row that has it."""
    df = _stored(spark, sf_dir, "se_law")
    return _with_first_row(df.select("id", *RECORD_COLUMNS, joined().alias("conversation"))).select(
        *RECORD_COLUMNS, "key_chars", "first_row", "conversation"
    )


def _chat_log(spark, sf_dir) -> DataFrame:
    df = fr.documents(spark, sf_dir).select(
        F.col("doc_id").alias("row_idx"),
        F.concat(F.lit("hash_"), F.col("doc_id")).alias("conversation_hash"),
        F.col("source").alias("model"),
        F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("doc_id") * 500_000).alias("timestamp"),
        F.array(
            tn.turn(F.lit("user"), F.col("text")), tn.turn(F.lit("assistant"), F.lit(None).cast("string"))
        ).alias("conversation"),
        F.lit(1).alias("turn"),
        fr.document_language().alias("language"),
        fr.pick(F.col("doc_id"), "France", None).alias("country"),
    )
    return registry.source_records("wildchat", df)


@query
def chat_log(spark, sf_dir):
    """The chat-log adapter over documents as stored arrays, timestamps as ISO text."""
    return _chat_log(spark, sf_dir).select(
        "id", *RECORD_COLUMNS, "timestamp", "country", "src_turn", "n_user_turns"
    )


@query
def all_sources(spark, sf_dir):
    """Every kind of source in one table of records, each by the registry's adapter; none is shuffled for it."""
    parts = [
        _chat_log(spark, sf_dir),
        registry.source_records("philosophy_se", fr.question_pairs(spark, sf_dir)),
        registry.source_records("arena_expert", _arena_printed(spark, sf_dir)),
        registry.source_records("lesswrong", fr.nested_posts(spark, sf_dir)),
        registry.source_records("eaforum", fr.forum_posts(spark, sf_dir)),
        registry.source_records("arena_140k", _arena_blocks(spark, sf_dir)),
        registry.source_records("oasst2", fr.messages(spark, sf_dir)),
        *[_stored(spark, sf_dir, name) for name in ("prism", "sharegpt", "lmsys", "se_law")],
    ]
    return registry.all_sources(parts).select(*RECORD_COLUMNS)


# -- filters and scalars ------------------------------------------------------------------------


@query
def filter_language(spark, sf_dir):
    df = fr.documents(spark, sf_dir).withColumn("language", fr.document_language())
    return df.where(select.language_is("EN")).select("doc_id", "language")


@query
def filter_language_set(spark, sf_dir):
    df = fr.documents(spark, sf_dir).withColumn("language", fr.document_language())
    some = df.where(select.language_in(" FR, de ,,")).select("doc_id", F.lit("some").alias("asked"))
    every = df.where(select.language_in("fr,All")).select("doc_id", F.lit("all").alias("asked"))
    return some.unionByName(every)


@query
def filter_language_exact(spark, sf_dir):
    df = fr.documents(spark, sf_dir).withColumn("language", fr.document_language())
    exact = df.where(rebuild.in_language("EN")).select("doc_id", F.lit("EN").alias("asked"))
    none = df.where(rebuild.in_language("")).select("doc_id", F.lit("").alias("asked"))
    return exact.unionByName(none)


@query
def filter_nonempty(spark, sf_dir):
    """Conversations with a turn that has text, and whether their first user text gives a key."""
    kept = adapters.normalised_turns(
        fr.chat_turns(spark, sf_dir, blanks=True), adapters.ChatRules("chat")
    )
    df = assemble_conversations(kept)
    return df.select("id", (tx.dedup_key(F.col("first_user")) != "").alias("has_key"))


@query
def valid_ids(spark, sf_dir):
    df = fr.documents(spark, sf_dir).select("doc_id", fr.document_ids().alias("id"))
    return df.select("doc_id", valid_id(F.col("id")).alias("usable"))


@query
def dedup_keys(spark, sf_dir):
    text = F.col("text")
    key = tx.dedup_key(text)
    return fr.documents(spark, sf_dir).select(
        "doc_id",
        key.alias("key"),
        tx.key_digest(key).alias("digest"),
        tx.preview(text).alias("preview"),
        tx.scan_preview(text).alias("scan_preview"),
        F.length(text).alias("n_chars"),
        tx.ascii_json_length(text).alias("json_chars"),
    )


@query
def natural_keys(spark, sf_dir):
    """Length of each text's key, and the first document with the same key."""
    keyed = fr.documents(spark, sf_dir).select("doc_id", natural_key(F.col("text")).alias("key"))
    df = written(keyed, "keys")  # a Python key is made once
    first = df.groupBy("key").agg(F.min("doc_id").alias("first_doc"))
    return df.join(first, "key").select("doc_id", F.length("key").alias("key_chars"), "first_doc")


@query
def iso_timestamps(spark, sf_dir):
    df = fr.table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    return df.select(
        "event_id",
        tx.iso_timestamp(ts).alias("iso"),
        tx.iso_timestamp(ts, " ", offset=False).alias("plain"),
    )


# -- de-duplication --------------------------------------------------------------------------------


@query
def keep_first(spark, sf_dir):
    df = dedup.keep_first_text(fr.documents(spark, sf_dir), ["doc_id"], F.col("text"))
    return df.select("doc_id", "source", "text")


@query
def keep_first_by_id_then_text(spark, sf_dir):
    df = dedup.keep_first_by_id_then_text(fr.document_records(spark, sf_dir))
    return df.select("id", "row_idx", "first_user")


@query
def keep_first_incremental(spark, sf_dir):
    """Two runs: sources with an even number first, then the others against the keys kept so far."""
    df = fr.documents(spark, sf_dir)
    number = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
    early = dedup.keep_first_text(df.where(number % 2 == 0), ["doc_id"], F.col("text"))
    late = dedup.keep_first_unseen(df.where(number % 2 == 1), early, ["doc_id"], F.col("text"))
    return early.select("doc_id", F.lit(1).alias("run")).unionByName(
        late.select("doc_id", F.lit(2).alias("run"))
    )


@query
def scan_dedup_counters(spark, sf_dir):
    df = fr.documents(spark, sf_dir).withColumn("language", fr.document_language())
    return dedup.scan_counters(df, select.language_in("en,de"), F.col("text"))


# -- rendering and packing ---------------------------------------------------------------------------


def _rendered_chats(spark, sf_dir):
    df = assemble_conversations(fr.chat_turns(spark, sf_dir))
    return render.render_prompts(
        df, fr.PREFIX, fr.SUFFIX, max_turns=3, max_user_chars=120, max_other_chars=60
    )


@query
def render_prompts(spark, sf_dir):
    """Small caps, so that turns are cut and left out."""
    return _rendered_chats(spark, sf_dir).select("id", "prompt")


@query
def render_long_texts(spark, sf_dir):
    """The true caps on documents, as user and as assistant turns."""
    df = fr.documents(spark, sf_dir)
    conversation = F.array(
        tn.turn(F.lit("user"), F.col("text")), tn.turn(F.lit("assistant"), F.col("text"))
    )
    df = df.select("doc_id", conversation.alias("conversation"), F.lit(2).alias("n_turns"))
    return render.render_prompts(df).select("doc_id", "prompt")


@query
def parse_rendered_turns(spark, sf_dir):
    df = _rendered_chats(spark, sf_dir).select("id", "prompt")
    turns = render.explode_rendered_turns(df.withColumn("note", render.rendered_note(F.col("prompt"))))
    return turns.select("id", "turn", "role", "content", "note")


def _numbered(spark, sf_dir) -> DataFrame:
    return fr.document_records(spark, sf_dir).select(
        "source", "file_idx", "row_idx", "id", F.length("first_user").alias("n_bytes")
    )


@query
def request_ids(spark, sf_dir):
    """Ids and ordinals per file, and over the whole source."""
    df = _numbered(spark, sf_dir)
    per_file = ordinals.with_request_id(
        ordinals.with_ordinal(df, ["source", "file_idx"]), ["source", "file_idx"]
    ).withColumn("scope", F.lit("file"))
    whole = ordinals.with_request_id(
        ordinals.with_ordinal(df, ["source"]), ["source"], fallback=ordinals.SOURCE_ID_FORMAT
    ).withColumn("scope", F.lit("source"))
    return per_file.unionByName(whole).select("scope", "row_idx", "ordinal", "custom_id")


def _packed(spark, sf_dir) -> DataFrame:
    df = ordinals.with_ordinal(_numbered(spark, sf_dir), ["source", "file_idx"])
    df = written(df, "numbered")
    packed = shards.pack_shards(
        df, ["source", "file_idx"], max_rows=50, max_bytes=100_000, carry=["row_idx", "n_bytes"]
    )
    return packed.withColumn("shard_id", shards.file_shard_id(F.col("file_idx"), F.col("shard_no")))


@query
def pack_shards(spark, sf_dir):
    return _packed(spark, sf_dir).select("row_idx", "ordinal", "shard_id")


@query
def shard_stats(spark, sf_dir):
    return shards.shard_stats(_packed(spark, sf_dir))


def _prepared(spark, sf_dir) -> DataFrame:
    return prep.prepare(fr.document_records(spark, sf_dir), fr.RUN)


@query
def prepare(spark, sf_dir):
    """Language filter, keep-first, rendering, ids, sizes and packing as one job."""
    return _prepared(spark, sf_dir).select(
        "file_idx", "row_idx", "ordinal", "custom_id", "shard_id", "n_bytes", "prompt_chars"
    )


@query
def prepare_adapter(spark, sf_dir):
    """The same by the rules of adapters: by id first, no empty keys, numbered over the source."""
    df = prep.prepare(fr.document_records(spark, sf_dir), fr.RUN, prep.ADAPTER)
    return df.select("row_idx", "ordinal", "custom_id", "shard_id", "n_bytes")


@query
def prepare_report(spark, sf_dir):
    """Per file: rows in the language, survivors, shards."""
    spoken = fr.document_records(spark, sf_dir).where(select.language_is("en"))
    return reports.file_report(spoken, _prepared(spark, sf_dir))


@query
def prepare_totals(spark, sf_dir):
    return shards.prepare_totals(_prepared(spark, sf_dir))


@query
def manifest(spark, sf_dir):
    return prep.manifest(_prepared(spark, sf_dir)).select(
        "shard_id", "custom_id", "source", "conversation_hash", "language", "src_model", "src_turn",
        "n_turns", "first_user_preview", "prompt_chars",
    )


@query
def requests(spark, sf_dir):
    df = prep.request_lines(_prepared(spark, sf_dir), fr.RUN)
    return df.select(
        "custom_id",
        F.col("params.model").alias("model"),
        F.col("params.max_tokens").alias("max_tokens"),
        F.variant_get("params.output_config", "$.format.type", "string").alias("format"),
        F.get("params.messages", F.lit(0))["role"].alias("role"),
        F.get("params.messages", F.lit(0))["content"].alias("prompt"),
    )


@query
def write_read_shards(spark, sf_dir):
    """Shards written as gzip JSON lines and read back without their metadata."""
    folder = new_folder(spark, "shards")
    sinks.write_shards(
        _prepared(spark, sf_dir), folder, lambda df: prep.request_lines(df, fr.RUN)
    )
    return readers.read_shard_requests(spark, folder).select(
        "shard_id", "custom_id", "fingerprint",
        F.length(F.get("params.messages", F.lit(0))["content"]).alias("prompt_chars"),
        F.variant_get("params.output_config", "$.format.schema.required[0]", "string").alias("first_field"),
    )


@query
def config_drift(spark, sf_dir):
    """Shards prepared under two settings in one folder: what each shard holds, and what has drifted.

    The second run is refused at first, since the folder is the first one's, and goes on by force.
    """
    folder, other = new_folder(spark, "run"), replace(fr.RUN, model="next-model")
    uneven = F.substring("shard_id", -1, 1).cast("int") % 2 == 1
    for run, shards in ((fr.RUN, ~uneven), (other, uneven)):
        try:
            config.guard(spark, folder, run)
        except config.ConfigDrift:
            config.guard(spark, folder, run, force=True)
        requests = prep.prepare(fr.document_records(spark, sf_dir), run).where(shards)
        sinks.write_shards(requests, f"{folder}/shards/{run.model}", lambda df, run=run: prep.request_lines(df, run))
    parts = [readers.read_shard_requests(spark, f"{folder}/shards/{run.model}") for run in (fr.RUN, other)]
    return config.drifted_shards(parts[0].unionByName(parts[1]), fr.RUN)


# -- scoring and results ------------------------------------------------------------------------


def _scored(spark, sf_dir) -> DataFrame:
    df = fr.documents(spark, sf_dir)
    conversation = F.array(tn.turn(F.lit("user"), F.col("text")))
    bodies = df.select("doc_id", render.rendered_body(conversation, F.lit(1)).alias("body"))
    raw = scoring.score_prompts(
        bodies,
        scoring.LexicalScorer(fr.CUES),
        keys=["doc_id"],
        prompt="body",
        static=render.static_text(fr.PREFIX, fr.SUFFIX),
    )
    return results.parse_responses(raw)


@query
def score_prompts(spark, sf_dir):
    return _scored(spark, sf_dir)


@query
def parse_responses(spark, sf_dir):
    return results.parse_responses(fr.answers(spark, sf_dir))


@query
def parse_responses_strict(spark, sf_dir):
    return results.parse_responses(fr.answers(spark, sf_dir), strict=True)


@query
def range_check(spark, sf_dir):
    df = results.check_range(results.parse_responses(fr.answers(spark, sf_dir)))
    return df.select("custom_id", "status", *AXES)


def _results(spark, sf_dir) -> DataFrame:
    return results.parse_responses(fr.answers(spark, sf_dir))


@query
def attach_manifest(spark, sf_dir):
    df = results.attach_manifest(_results(spark, sf_dir), fr.request_manifest(spark, sf_dir))
    return df.select("shard_id", "custom_id", "status", "conversation_hash", "source", "language")


@query
def write_read_results(spark, sf_dir):
    """Results written by shard as JSON lines and read back as one table."""
    df = results.attach_manifest(_results(spark, sf_dir), fr.request_manifest(spark, sf_dir))
    folder = new_folder(spark, "results")
    sinks.write_results(df, folder)
    return readers.read_results(spark, folder).select(
        "shard_id", "custom_id", "batch_id", "status", *AXES, "reasoning", "source", "base_score"
    )


@query
def retry_set(spark, sf_dir):
    return results.retry_set(_results(spark, sf_dir), fr.requests(spark, sf_dir))


def _retried(spark, sf_dir) -> DataFrame:
    """Answers to two more attempts at every request: either may fail, and the last good one counts."""
    df = fr.answers(spark, sf_dir)

    def attempt(number: int, score: int, good: Column) -> DataFrame:
        mended = F.lit(f'{{"conceptual": {score}, "novelty": 2, "well_formed": 3, "reasoning": "again"}}')
        return df.withColumns(
            {
                "text": F.when(good, mended).otherwise(F.lit("{")),
                "result_type": F.lit("succeeded"),
                "stop_reason": F.lit("end_turn"),
                "attempt": F.lit(number),
            }
        )

    tokens = F.col("input_tokens")
    return results.parse_responses(attempt(1, 1, tokens % 3 != 0).unionByName(attempt(2, 3, tokens % 5 == 0)))


@query
def patch_results(spark, sf_dir):
    return results.patch_results(_results(spark, sf_dir), _retried(spark, sf_dir), order=["attempt"])


@query
def patch_shards_on_disk(spark, sf_dir):
    """Stored results whose changed shards are replaced by a new version, read back as one table."""
    folder = new_folder(spark, "versions")
    stored = results.attach_manifest(_results(spark, sf_dir), fr.request_manifest(spark, sf_dir))
    versions.commit(stored, folder)
    # the first shard is retried for nothing, so its files stay as they are
    retry.patch_on_disk(spark, folder, _retried(spark, sf_dir).where("shard_id > '0000'"), order=["attempt"])
    return versions.read_version(spark, folder).select(
        "shard_id", "custom_id", "status", *AXES, "reasoning", "input_tokens", "output_tokens"
    )


@query
def patch_counts(spark, sf_dir):
    return results.patch_counts(_results(spark, sf_dir), _retried(spark, sf_dir))


@query
def pending_shards(spark, sf_dir):
    """Requests without a result."""
    df = results.pending_requests(fr.requests(spark, sf_dir), _results(spark, sf_dir))
    return df.select("shard_id", "custom_id")


# -- publishing and rebuilding -------------------------------------------------------------------


@query
def score_table(spark, sf_dir):
    df = results.attach_manifest(_results(spark, sf_dir), fr.request_manifest(spark, sf_dir))
    return publish.score_table(df, source="documents")


@query
def strong_hits(spark, sf_dir):
    return publish.strong_hits(fr.scores(spark, sf_dir)).select("ord", "key", *AXES)


@query
def conceptual_hits(spark, sf_dir):
    return publish.conceptual_hits(fr.scores(spark, sf_dir)).select("ord", "key", *AXES)


@query
def select_keys(spark, sf_dir):
    return rebuild.selected_keys(fr.scores(spark, sf_dir), ["ord"], conceptual=1, novelty=1, well_formed=1)


def _selected(spark, sf_dir) -> DataFrame:
    return rebuild.selected_keys(
        fr.scores(spark, sf_dir), ["ord"], conceptual=2, novelty=1, well_formed=2
    )


def _source(spark, sf_dir) -> DataFrame:
    return fr.keyed_source(spark, sf_dir).withColumn("key", F.col("id"))


@query
def rebuild_prompts(spark, sf_dir):
    df = rebuild.rebuild_prompts(_selected(spark, sf_dir), _source(spark, sf_dir))
    return df.withColumn("conversation", joined())


@query
def rebuild_prompts_in_place(spark, sf_dir):
    """The same from scores and a source that are stored in buckets of their key."""
    source, scores = new_folder(spark, "source"), new_folder(spark, "scores")
    name = source.rsplit("-", 1)[-1]
    kept = sinks.write_keyed(_source(spark, sf_dir), f"source_{name}", source, 8)
    known = sinks.write_keyed(fr.scores(spark, sf_dir), f"scores_{name}", scores, 8)
    selected = rebuild.selected_keys(known, ["ord"], conceptual=2, novelty=1, well_formed=2)
    return rebuild.rebuild_prompts(selected, kept).withColumn("conversation", joined())


@query
def rebuild_source(spark, sf_dir):
    """Rebuild by a source's name from stored files: its schema and adapter are the registry's."""
    chats, scores = new_folder(spark, "chats"), new_folder(spark, "scores")
    stored = fr.stored_chats(spark, sf_dir, "from", "value").withColumnRenamed("turns", "conversations")
    stored.select("id", "conversations").write.parquet(chats)
    named = fr.scores(spark, sf_dir).withColumn("key", F.regexp_replace("key", "^doc_", "conv_"))
    # of rows with one key the last in the file counts
    named.coalesce(1).sortWithinPartitions("ord").drop("ord").write.parquet(scores)
    prompts, _ = plan_rebuild.rebuild_source(spark, "sharegpt", scores, chats, 1, 1, 1)
    return prompts.select("key", "source", *AXES, joined().alias("conversation"))


@query
def rebuild_turns(spark, sf_dir):
    """Rebuild from a long table: the turns of every conversation whose first user text was kept."""
    turns = fr.chat_turns(spark, sf_dir).withColumn("key", F.col("id"))
    doc_scores = fr.scores(spark, sf_dir).withColumn("key", F.regexp_replace("key", "^doc_", "conv_"))
    chosen = rebuild.selected_keys(doc_scores, ["ord"], conceptual=1, novelty=1, well_formed=1)
    return rebuild.rebuild_turns(chosen, turns).select("key", "turn", "role", "content", *AXES)


@query
def missing_keys(spark, sf_dir):
    return rebuild.missing_keys(_selected(spark, sf_dir), _source(spark, sf_dir)).select("key")


@query
def rebuild_coverage(spark, sf_dir):
    return rebuild.rebuild_coverage(_selected(spark, sf_dir), _source(spark, sf_dir))


@query
def write_read_rebuilt(spark, sf_dir):
    """Rebuilt prompts as JSON lines under a name that carries the thresholds."""
    df = rebuild.rebuild_prompts(_selected(spark, sf_dir), _source(spark, sf_dir))
    path = sinks.write_rebuilt(df, new_folder(spark, "rebuilt"), "documents", 2, 1, 2)
    back = spark.read.schema(df.schema).json(path)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)
    return back.select("key", *AXES, joined().alias("conversation"), name.alias("name"))


@query
def browse_order(spark, sf_dir):
    """The first rows by novelty; a missing status counts as ok."""
    df = fr.scores(spark, sf_dir)
    hits = df.where(rebuild.passes(1, 0, 1, missing_status_is_ok=True))
    top = hits.orderBy(*select.browse_order("novelty", ["ord"])).limit(25)
    return top.select("ord", "key", *AXES, "status")


@query
def browse_window(spark, sf_dir):
    hits = fr.scores(spark, sf_dir).where(
        rebuild.passes(0, 0, 0, missing_status_is_ok=True) & rebuild.in_language("en")
    )
    return select.browse_window(hits, start=11, rows=20, axis="well_formed", ties=["ord"]).select(
        "ord", "key", *AXES
    )


@query
def browse_window_deep(spark, sf_dir):
    """A window that begins at nine tenths of all rows, found by counting ranges of the order."""
    hits = written(fr.scores(spark, sf_dir).where(F.coalesce("status", F.lit("ok")) == "ok"), "hits")
    start = hits.count() * 9 // 10
    return select.browse_window(hits, start=start + 1, rows=20, axis="novelty", ties=["ord"], top_rows=30).select(
        "ord", "key", *AXES
    )


@query
def hit_prompts(spark, sf_dir):
    """Prompts of hits; some hits name requests that nobody made."""
    named = F.when(F.col("ord") % 13 == 0, F.concat(F.lit("none_"), F.col("ord"))).otherwise(F.col("custom_id"))
    hits = publish.strong_hits(fr.unique_scores(spark, sf_dir)).withColumn("custom_id", named)
    df = rebuild.prompts_of_hits(hits, fr.requests(spark, sf_dir))
    return df.select("shard_id", "custom_id", *AXES, "prompt")


# -- reports ----------------------------------------------------------------------------------------


@query
def cost_estimate(spark, sf_dir):
    df = fr.requests(spark, sf_dir).withColumn("prompt_chars", F.length("prompt"))
    return reports.cost_estimate(df)


@query
def cost_actual(spark, sf_dir):
    return reports.cost_actual(_results(spark, sf_dir))


@query
def status_counts(spark, sf_dir):
    return reports.status_counts(_results(spark, sf_dir))


@query
def score_histogram(spark, sf_dir):
    return reports.score_histogram(_results(spark, sf_dir))


@query
def session_counters(spark, sf_dir):
    return reports.session_counters(_results(spark, sf_dir), rebuild.passes(2, 0, 0))


@query
def run_progress(spark, sf_dir):
    return reports.run_progress(fr.requests(spark, sf_dir), _results(spark, sf_dir))


@query
def yield_report(spark, sf_dir):
    return reports.yield_report(fr.scores(spark, sf_dir))


# -- windows of rows and samples -----------------------------------------------------------------


@query
def sequential_scan(spark, sf_dir):
    df = fr.documents(spark, sf_dir)
    return select.sequential_scan(df, 37, 150, ordinal="doc_id").select("doc_id", "text")


@query
def block_sample(spark, sf_dir):
    df = fr.documents(spark, sf_dir)
    return select.block_sample(df, pages=5, seed=42, ordinal="doc_id").select("doc_id", "page", "lang")


@query
def trial_caps(spark, sf_dir):
    """The first files, and the first rows, of a trial run."""
    df = fr.document_records(spark, sf_dir)
    files = select.first_files(df, 2).select("row_idx", F.lit("files").alias("cap"))
    rows = select.first_rows(df, 30).select("row_idx", F.lit("rows").alias("cap"))
    return files.unionByName(rows)


@query
def first_hits(spark, sf_dir):
    df = _scored(spark, sf_dir)
    hits = select.first_hits(df, rebuild.passes(2, 1, 1), 10, order=["doc_id"])
    return hits.select("doc_id", *AXES)


def _scan(spark, sf_dir) -> scan.Scan:
    """A stretch of the documents, some of whose rows are drawn twice, in two languages."""
    df = fr.document_records(spark, sf_dir)
    rows = select.sequential_scan(df, 37, 700, ordinal="row_idx").unionByName(
        select.sequential_scan(df, 100, 60, ordinal="row_idx")
    )
    return scan.scan_and_classify(
        rows, select.language_in("en,de"), scoring.LexicalScorer(fr.CUES), rebuild.passes(2, 1, 1), fr.PREFIX, fr.SUFFIX
    )


@query
def scan_and_classify(spark, sf_dir):
    return _scan(spark, sf_dir).verdicts.select("row_idx", "status", *AXES, "reasoning", "is_hit")


@query
def scan_and_classify_counters(spark, sf_dir):
    return _scan(spark, sf_dir).counters


# -- streams ------------------------------------------------------------------------------------------


def _arrivals(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Documents in four parts that arrive one after the other; together they are the whole table."""
    df = fr.documents(spark, sf_dir)
    low, high = df.agg(F.min("doc_id"), F.max("doc_id")).first()
    step = (high - low) // 4 + 1
    return [
        df.where(F.col("doc_id").between(low + part * step, low + (part + 1) * step - 1))
        .withColumn("file_idx", F.lit(part))
        for part in range(4)
    ]


def _document_stream(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "file_idx", F.col("doc_id").alias("row_idx"), F.col("text").alias("first_user"))


def _streamed(spark: SparkSession, sf_dir: str, stream) -> DataFrame:
    """Run the stream once per arrival, each time from its checkpoint."""
    folder, out, checkpoint = (new_folder(spark, n) for n in ("arriving", "kept", "state"))
    for part in _arrivals(spark, sf_dir):
        part.write.mode("append").parquet(folder)
        stream(
            spark, folder, part.schema, _document_stream, out, checkpoint, files_per_batch=None
        ).awaitTermination()
    return spark.read.parquet(out)


@query
def stream_prepare(spark, sf_dir):
    return _streamed(spark, sf_dir, st_prepare.stream_prepare).select("digest")


@query
def stream_prepare_exact(spark, sf_dir):
    return _streamed(spark, sf_dir, st_prepare.stream_prepare_exact).select("doc_id", "digest")


@query
def stream_prepare_shards(spark, sf_dir):
    """Whole files in four arrivals, each prepared to its packed requests: the rows of one preparation."""
    df = fr.documents(spark, sf_dir)
    file = F.floor(F.col("doc_id") / fr.FILE_ROWS)
    last = df.agg(F.max(file)).first()[0]
    folder, out, checkpoint = (new_folder(spark, n) for n in ("arriving", "prepared", "state"))
    for part in range(4):
        df.where(F.floor(4 * file / (last + 1)) == part).write.mode("append").parquet(folder)
        st_prepare.stream_prepare_shards(
            spark, folder, df.schema, fr.as_document_records, fr.RUN, out, checkpoint
        ).awaitTermination()
    return spark.read.parquet(f"{out}/requests").select(
        "file_idx", "row_idx", "ordinal", "custom_id", "shard_id", "n_bytes", "prompt_chars"
    )


def _written_answers(spark: SparkSession, sf_dir: str) -> str:
    folder = new_folder(spark, "answers")
    fr.answers(spark, sf_dir).write.mode("overwrite").json(folder)
    return folder


@query
def stream_collect(spark, sf_dir):
    answers = _written_answers(spark, sf_dir)
    out, checkpoint = new_folder(spark, "collected"), new_folder(spark, "state")
    stored = new_folder(spark, "manifest")
    sinks.write_manifest(fr.request_manifest(spark, sf_dir), stored)
    manifest = readers.read_manifest(spark, stored)
    st_collect.stream_collect(spark, answers, manifest, out, checkpoint).awaitTermination()
    return spark.read.schema(RESULT).parquet(out).select(
        "shard_id", "custom_id", "status", *AXES, "source"
    )


@query
def collect_progress(spark, sf_dir):
    """Answers collected in two arrivals: one row of counts for each, kept beside the results."""
    df = fr.answers(spark, sf_dir)
    answers, out, checkpoint = (new_folder(spark, n) for n in ("answers", "collected", "state"))
    stored = new_folder(spark, "manifest")
    sinks.write_manifest(fr.request_manifest(spark, sf_dir), stored)
    manifest = readers.read_manifest(spark, stored)
    for later in (False, True):
        df.where((F.col("shard_id") >= "0004") == later).write.mode("append").json(answers)
        st_collect.stream_collect(spark, answers, manifest, out, checkpoint).awaitTermination()
    return st_collect.progress(spark, out)


@query
def stream_watch(spark, sf_dir):
    """Two arrivals, collected by passes until every answer is in."""
    df = fr.answers(spark, sf_dir)
    answers, out, checkpoint = (new_folder(spark, n) for n in ("answers", "collected", "state"))
    manifest = written(fr.request_manifest(spark, sf_dir), "manifest")
    later = F.col("shard_id") >= "0004"
    df.where(~later).write.mode("append").json(answers)

    def start():
        return st_collect.stream_collect(spark, answers, manifest, out, checkpoint)

    def complete() -> bool:
        done = results.pending_requests(df, spark.read.schema(RESULT).parquet(out)).isEmpty()
        if not done:
            df.where(later).write.mode("append").json(answers)
        return done

    st_collect.watch(start, complete, pause_seconds=0)
    back = spark.read.schema(RESULT).parquet(out)
    return reports.status_counts(back)
