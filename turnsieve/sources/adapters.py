"""Adapters: each maps the rows of one kind of source to conversation records.

Chat-like sources come either as one row per conversation with an array of turns, or as a long table
with one row per turn. Their rules are stated once (:class:`ChatRules`) and applied to either shape.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import natural_key
from ..functions.once import computed_once
from ..functions.text import (
    has_text,
    iso_timestamp,
    strip,
    text_or_empty,
    title_and_body,
    with_html_text,
)
from ..functions.turns import (
    blocks_text,
    drop_blank,
    first_content,
    map_senders,
    mapped_role,
    plain_turns,
    printed_turns,
    turn,
    user_only,
    with_fallback,
)
from ..operators.conversations import assemble_conversations, records

# Labels in published tables, languages and the origin of human-written text.
TITLE_CHARS = 100
ENGLISH = "English"
HUMAN = "human"
UNKNOWN_MODEL = "unknown"
CHAT_LOG_SOURCE = "wildchat"
FLAGGED_FORUM_SOURCE = "lesswrong"
TITLED_FORUM_SOURCE = "eaforum"
QA_PAIRS_SOURCE = "philosophy_se"


@dataclass(frozen=True)
class ChatRules:
    """What an adapter of a chat-like source does with turns and metadata."""

    source: str
    senders: bool = False  # turns are from/value pairs whose sender is mapped to a role
    user_only: bool = False
    drop_blank: bool = True
    languages: tuple[str, ...] = ()  # accepted languages in lower case; empty accepts all
    language: str | None = ENGLISH
    src_model: str | None = HUMAN  # None: taken from the row


PREFERENCE_CHAT = ChatRules("prism", user_only=True)
SHARED_CHAT = ChatRules("sharegpt", senders=True, language=None, src_model=UNKNOWN_MODEL)
GATED_CHAT = ChatRules("lmsys", languages=("english",), src_model=None)
ARENA_LANGUAGES = ("en", "english")
ARENA = {
    name: ChatRules(name, user_only=True, languages=ARENA_LANGUAGES)
    for name in ("arena_140k", "arena_expert")
}


def qa_site_rules(site: str) -> ChatRules:
    return ChatRules(f"se_{site}", senders=True)


def _spoken(df: DataFrame, rules: ChatRules) -> DataFrame:
    if not rules.languages:
        return df
    return df.where(F.lower(text_or_empty(F.col("language"))).isin(*rules.languages))


def _kept(conversation: Column, rules: ChatRules) -> Column:
    kept = user_only(conversation) if rules.user_only else conversation
    return drop_blank(kept) if rules.drop_blank else kept


def _chat_records(
    df: DataFrame,
    rules: ChatRules,
    key: Column,
    conversation: Column,
    **columns: Column,
) -> DataFrame:
    """Language filter, turn rules, then only rows that still have a turn.

    Turns can be costly to read (printed arrays), so they are read once and not again for the filter.
    """
    df = computed_once(_spoken(df, rules), _kept=_kept(conversation, rules))
    df = df.where(F.size("_kept") > 0)
    columns.setdefault("src_model", F.lit(rules.src_model))
    return records(
        df,
        source=F.lit(rules.source),
        id=key,
        conversation=F.col("_kept"),
        language=F.lit(rules.language),
        **columns,
    )


def _as_text(df: DataFrame, column: str) -> Column:
    """Timestamps are printed with a space; a column that is text already stays as it is."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return iso_timestamp(F.col(column), " ", isinstance(dtype, T.TimestampType))
    return F.col(column).cast("string")


# -- array-shaped sources --------------------------------------------------------------------


def chat_log(df: DataFrame, source: str = CHAT_LOG_SOURCE) -> DataFrame:
    """The big chat log: turns as stored, metadata from the row."""
    timestamp = df.schema["timestamp"].dataType
    written = (
        iso_timestamp(F.col("timestamp"), "T", isinstance(timestamp, T.TimestampType))
        if isinstance(timestamp, (T.TimestampType, T.TimestampNTZType))
        else F.col("timestamp").cast("string")
    )
    return records(
        df,
        source=F.lit(source),
        id=text_or_empty(F.col("conversation_hash")),
        conversation=F.transform("conversation", lambda t: turn(t["role"], t["content"])),
        language=F.col("language"),
        country=F.col("country"),
        src_model=F.col("model"),
        timestamp=written,
        src_turn=F.col("turn"),
    )


def _forum_post(df: DataFrame, source: str, key: Column, **rest: Column) -> DataFrame:
    df = with_html_text(df, "htmlBody", "_body")
    df = df.withColumn("_title", strip(text_or_empty(F.col("title"))))
    df = df.withColumn("_text", title_and_body(F.col("_title"), F.col("_body")))
    return records(
        df.where(F.col("_text") != ""),
        source=F.lit(source),
        id=key,
        conversation=F.array(turn(F.lit("user"), F.col("_text"))),
        title=F.col("_title"),
        language=F.lit(ENGLISH),
        src_model=F.lit(HUMAN),
        **rest,
    )


def forum_flagged(df: DataFrame, source: str = FLAGGED_FORUM_SOURCE) -> DataFrame:
    """Posts carrying the question flag, inside a struct column of which only used fields are read."""
    asked = df.where(F.coalesce(F.col("post.question"), F.lit(False)))
    flat = asked.select(
        *[F.col(c) for c in ("file_idx", "row_idx") if c in df.columns],
        *[
            F.col(f"post.{field}").alias(field)
            for field in ("_id", "title", "htmlBody", "pageUrl", "baseScore", "postedAt")
        ],
    )
    return _forum_post(
        flat,
        source,
        F.col("_id"),
        url=F.col("pageUrl"),
        base_score=F.col("baseScore"),
        timestamp=_as_text(flat, "postedAt"),
    )


def forum_interrogative(df: DataFrame, source: str = TITLED_FORUM_SOURCE) -> DataFrame:
    """Posts whose title ends with a question mark."""
    asked = df.where(F.endswith(strip(text_or_empty(F.col("title"))), F.lit("?")))
    return _forum_post(
        asked,
        source,
        F.col("post_id"),
        url=F.col("pageUrl"),
        base_score=F.col("baseScore"),
        timestamp=_as_text(asked, "postedAt"),
    )


def qa_with_fallback(df: DataFrame, source: str = QA_PAIRS_SOURCE) -> DataFrame:
    """Question and answer rows; the key is a digest of the question, or of the first turn."""
    df = df.withColumn(
        "_turns",
        with_fallback(map_senders(F.col("conversations")), F.col("instruction"), F.col("completion")),
    ).where(F.size("_turns") > 0)
    question = F.coalesce(
        F.nullif(F.col("instruction"), F.lit("")), first_content(F.col("_turns"))
    )
    return records(
        df,
        source=F.lit(source),
        id=natural_key(question),
        conversation=F.col("_turns"),
        title=F.substring(question, 1, TITLE_CHARS),
        language=F.lit(ENGLISH),
        src_model=F.lit(HUMAN),
    )


def preference_chat(df: DataFrame, rules: ChatRules = PREFERENCE_CHAT) -> DataFrame:
    return _chat_records(
        df,
        rules,
        F.col("conversation_id"),
        plain_turns(F.col("conversation_history")),
        timestamp=_as_text(df, "generated_datetime"),
        conversation_type=F.col("conversation_type"),
    )


def shared_chat(df: DataFrame, rules: ChatRules = SHARED_CHAT) -> DataFrame:
    return _chat_records(df, rules, F.col("id"), map_senders(F.col("conversations")))


def gated_chat(df: DataFrame, rules: ChatRules = GATED_CHAT) -> DataFrame:
    return _chat_records(
        df,
        rules,
        F.col("conversation_id"),
        plain_turns(F.col("conversation")),
        src_model=F.col("model"),
    )


def arena(df: DataFrame, rules: ChatRules = ARENA["arena_140k"]) -> DataFrame:
    """Either form of the arena sets: an array of turns with block content, or its printed form."""
    dtype = df.schema["conversation_a"].dataType
    if isinstance(dtype, T.StringType):
        turns = printed_turns(F.col("conversation_a"))
    else:
        content = dtype.elementType["content"].dataType
        turns = F.coalesce(
            F.transform(
                "conversation_a", lambda t: turn(t["role"], blocks_text(t["content"], content))
            ),
            F.array().cast("array<struct<role:string,content:string>>"),
        )
    return _chat_records(df, rules, F.col("id"), turns)


def tree_roots(df: DataFrame, source: str = "oasst2") -> DataFrame:
    """First asks of message trees: English prompter messages without a parent, not deleted."""
    roots = df.where(
        (F.col("role") == "prompter")
        & F.col("parent_id").isNull()
        & ~F.coalesce(F.col("deleted"), F.lit(False))
        & (F.col("lang") == "en")
        & has_text(F.col("text"))
    )
    return records(
        roots,
        source=F.lit(source),
        id=F.col("message_id"),
        conversation=F.array(turn(F.lit("user"), strip(F.col("text")))),
        language=F.lit(ENGLISH),
        src_model=F.lit(HUMAN),
    )


def qa_site(df: DataFrame, site: str) -> DataFrame:
    """Any site of the generic question-and-answer dumps; the key is a digest of the first turn left."""
    turns = drop_blank(map_senders(F.col("conversations")))
    question = first_content(F.col("_kept"))
    return _chat_records(
        df,
        qa_site_rules(site),
        natural_key(question),
        turns,
        title=F.substring(question, 1, TITLE_CHARS),
    )


# -- long tables of turns ----------------------------------------------------------------------


def normalised_turns(turns: DataFrame, rules: ChatRules) -> DataFrame:
    """Apply the turn rules to a long table: projections and filters only, nothing is shuffled.

    ``turns`` has ``id, turn`` and either ``from, value`` or ``role, content``; other columns are
    metadata, equal on all turns of a conversation, and are kept.
    """
    role, content = (
        (mapped_role(F.col("from")), F.col("value"))
        if rules.senders
        else (F.col("role"), F.col("content"))
    )
    rest = [c for c in turns.columns if c not in ("from", "value", "role", "content")]
    out = _spoken(turns, rules).select(
        *rest, role.alias("role"), text_or_empty(content).alias("content")
    )
    if rules.user_only:
        out = out.where(F.col("role") == "user")
    return out.where(has_text(F.col("content"))) if rules.drop_blank else out


def chat_records_from_turns(turns: DataFrame, rules: ChatRules, text_key: bool = False) -> DataFrame:
    """Records of a long table. With ``text_key`` key and title come from the first turn left."""
    kept = normalised_turns(turns, rules)
    placed = ("turn", "role", "content", "id", "file_idx", "row_idx")
    carry = [c for c in kept.columns if c not in placed]
    df = assemble_conversations(kept, "id", carry)
    given = {
        name: F.col(name)
        for name in ("timestamp", "country", "conversation_type", "title", "url", "base_score")
        if name in carry
    }
    if text_key:
        given["title"] = F.substring("first_content", 1, TITLE_CHARS)
    return records(
        df,
        source=F.lit(rules.source),
        id=natural_key(F.col("first_content")) if text_key else F.col("id"),
        conversation=F.col("conversation"),
        n_turns=F.col("n_turns"),
        n_user_turns=F.col("n_user_turns"),
        first_user=F.col("first_user"),
        language=F.lit(rules.language),
        src_model=F.col("model") if rules.src_model is None else F.lit(rules.src_model),
        **given,
    )
