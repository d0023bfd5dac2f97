"""Table shapes. Sources are read with these types, so no file is scanned to infer a schema."""

from __future__ import annotations

from pyspark.sql import types as T

from .functions.turns import CONVERSATION


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


_S, _I, _L, _B, _TS = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.BooleanType(),
    T.TimestampType(),
)

SENDER_TURNS = T.ArrayType(_struct(("from", _S), ("value", _S)))
BLOCKS = T.ArrayType(_struct(("type", _S), ("text", _S)))

# -- sources ---------------------------------------------------------------------------------

# Column names and types of the public tables that are read, as those have them.

CHAT_LOG = _struct(
    ("conversation_hash", _S),
    ("model", _S),
    ("timestamp", _TS),
    ("conversation", CONVERSATION),
    ("turn", _I),
    ("language", _S),
    ("country", _S),
)
FORUM_FLAGGED = _struct(
    (
        "post",
        _struct(
            ("_id", _S),
            ("title", _S),
            ("htmlBody", _S),
            ("question", _B),
            ("pageUrl", _S),
            ("baseScore", _I),
            ("postedAt", _TS),
        ),
    )
)
FORUM_TITLED = _struct(
    ("post_id", _S),
    ("title", _S),
    ("htmlBody", _S),
    ("pageUrl", _S),
    ("baseScore", _I),
    ("postedAt", _TS),
)
QA_PAIRS = _struct(("instruction", _S), ("completion", _S), ("conversations", SENDER_TURNS))
QA_SITE = _struct(("conversations", SENDER_TURNS))
PREFERENCE_CHAT = _struct(
    ("conversation_id", _S),
    ("conversation_type", _S),
    ("conversation_history", CONVERSATION),
    ("generated_datetime", _TS),
)
SHARED_CHAT = _struct(("id", _S), ("conversations", SENDER_TURNS))
GATED_CHAT = _struct(
    ("conversation_id", _S), ("model", _S), ("conversation", CONVERSATION), ("language", _S)
)
ARENA_BLOCKS = _struct(
    ("id", _S),
    ("conversation_a", T.ArrayType(_struct(("role", _S), ("content", BLOCKS)))),
    ("language", _S),
)
ARENA_PRINTED = _struct(("id", _S), ("conversation_a", _S), ("language", _S))
MESSAGE_TREE = _struct(
    ("message_id", _S),
    ("parent_id", _S),
    ("text", _S),
    ("role", _S),
    ("lang", _S),
    ("deleted", _B),
)

# -- tables of the pipeline --------------------------------------------------------------------

#: One row per conversation, whatever the source looked like.
RECORD = _struct(
    ("source", _S),
    ("id", _S),
    ("file_idx", _L),
    ("row_idx", _L),
    ("conversation", CONVERSATION),
    ("n_turns", _L),
    ("n_user_turns", _L),
    ("first_user", _S),
    ("title", _S),
    ("url", _S),
    ("base_score", _L),
    ("timestamp", _S),
    ("language", _S),
    ("country", _S),
    ("src_model", _S),
    ("src_turn", _L),
    ("conversation_type", _S),
)

MANIFEST = _struct(
    ("source", _S),
    ("conversation_hash", _S),
    ("title", _S),
    ("url", _S),
    ("base_score", _L),
    ("timestamp", _S),
    ("language", _S),
    ("country", _S),
    ("src_model", _S),
    ("src_turn", _L),
    ("conversation_type", _S),
    ("n_turns", _L),
    ("first_user_preview", _S),
    ("prompt_chars", _L),
)

PARAMS = _struct(
    ("model", _S),
    ("max_tokens", _L),
    ("output_config", T.VariantType()),
    ("messages", T.ArrayType(_struct(("role", _S), ("content", _S)))),
)

#: A line of a shard. The shape of ``output_config`` is up to the scorer.
SHARD_LINE = _struct(
    ("custom_id", _S), ("params", PARAMS), ("manifest", MANIFEST), ("fingerprint", _S)
)

RESPONSE = _struct(
    ("result_type", _S),
    ("stop_reason", _S),
    ("text", _S),
    ("input_tokens", _L),
    ("output_tokens", _L),
)

RESULT = T.StructType(
    MANIFEST.fields
    + _struct(
        ("custom_id", _S),
        ("status", _S),
        ("conceptual", _I),
        ("novelty", _I),
        ("well_formed", _I),
        ("reasoning", _S),
        ("input_tokens", _L),
        ("output_tokens", _L),
        ("shard_id", _S),
        ("batch_id", _S),
    ).fields
)

SCORE = _struct(
    ("source", _S),
    ("key", _S),
    ("conceptual", _I),
    ("novelty", _I),
    ("well_formed", _I),
    ("status", _S),
    ("src_model", _S),
    ("timestamp", _S),
    ("country", _S),
    ("language", _S),
    ("n_turns", _L),
    ("base_score", _L),
    ("url", _S),
)

AXES = ("conceptual", "novelty", "well_formed")
