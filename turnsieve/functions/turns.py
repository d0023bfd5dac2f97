"""Expressions on turns: one turn at a time, and on arrays of turns.

The same rule serves a column of a long turn table and, through a higher-order function, an array.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import SPACES, has_text, text_or_empty

TURN = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
CONVERSATION = T.ArrayType(TURN)

# Sender names that stand for the user side.
USER_SENDERS = ("human", "user", "system")


def turn(role: Column, content: Column) -> Column:
    return F.struct(role.alias("role"), content.alias("content"))


def empty_conversation() -> Column:
    return F.array().cast(CONVERSATION)


def mapped_role(sender: Column) -> Column:
    return F.when(sender.isin(*USER_SENDERS), F.lit("user")).otherwise(F.lit("assistant"))


def map_senders(turns: Column) -> Column:
    """``from``/``value`` turns to ``role``/``content`` turns; a null array is an empty one."""
    return F.coalesce(
        F.transform(turns, lambda t: turn(mapped_role(t["from"]), text_or_empty(t["value"]))),
        empty_conversation(),
    )


def plain_turns(turns: Column) -> Column:
    """``role``/``content`` turns without extra fields and without null text."""
    return F.coalesce(
        F.transform(turns, lambda t: turn(t["role"], text_or_empty(t["content"]))),
        empty_conversation(),
    )


def drop_blank(conversation: Column) -> Column:
    return F.filter(conversation, lambda t: has_text(t["content"]))


def user_only(conversation: Column) -> Column:
    return F.filter(conversation, lambda t: t["role"] == "user")


def with_fallback(conversation: Column, instruction: Column, completion: Column) -> Column:
    """An empty conversation is rebuilt as question and answer when there is a question."""
    pair = F.array(
        turn(F.lit("user"), instruction), turn(F.lit("assistant"), text_or_empty(completion))
    )
    return F.when(
        (F.size(conversation) == 0) & (text_or_empty(instruction) != ""), pair
    ).otherwise(conversation)


def blocks_text(content: Column, dtype: T.DataType) -> Column:
    """Text of a content field that is a string, a list of ``{type, text}`` blocks, or a VARIANT."""
    if isinstance(dtype, T.StringType):
        return text_or_empty(content)
    if isinstance(dtype, T.ArrayType):
        texts = F.transform(
            F.filter(content, lambda b: b["type"] == "text"), lambda b: text_or_empty(b["text"])
        )
        return F.coalesce(F.array_join(texts, " "), F.lit(""))
    if isinstance(dtype, T.VariantType):
        items = F.try_variant_get(content, "$", "array<variant>")
        texts = F.transform(
            F.filter(items, lambda b: F.try_variant_get(b, "$.type", "string") == "text"),
            lambda b: text_or_empty(F.try_variant_get(b, "$.text", "string")),
        )
        return (
            F.when(F.schema_of_variant(content) == "STRING", F.try_variant_get(content, "$", "string"))
            .when(items.isNotNull(), F.array_join(texts, " "))
            .otherwise(F.lit(""))
        )
    raise TypeError(f"no rule for content of type {dtype.simpleString()}")


# -- conversations stored as the printed form of an array -------------------------------------

_ROLE_MARK = rf"'role':[{SPACES}]*'(?:user|assistant)'"
_TEXT_MARK = "'text':"
_QUOTED = "|".join(rf"{q}[^{q}\\]*+(?:\\.[^{q}\\]*+)*+\\?+" for q in ("'", '"'))
# Role marker, then (looked at, not consumed) the first text marker before the next role marker and
# the string after it, from its opening quote on. Possessive loops keep long texts off the Java stack.
_PRINTED_TURN = (
    rf"(?s)'role':[{SPACES}]*'(user|assistant)'"
    rf"(?=(?:(?!{_ROLE_MARK}|{_TEXT_MARK}).)*+{_TEXT_MARK}[ \t\n]*+(?!{_ROLE_MARK})({_QUOTED}))"
)


def _unquote(text: Column) -> Column:
    """Decode backslash pairs left to right: n, t and r are control characters, others themselves."""
    for letter, char in (("n", "\n"), ("t", "\t"), ("r", "\r")):
        text = F.regexp_replace(
            text, rf"(?s)\G([^\\]*+(?:\\[^{letter}][^\\]*+)*+)\\{letter}", f"$1{char}"
        )
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def printed_turns(text: Column) -> Column:
    """Turns of a conversation stored as printed text, with either quote and without an end quote."""
    pattern = F.lit(_PRINTED_TURN)
    parts = F.arrays_zip(
        F.regexp_extract_all(text, pattern, F.lit(1)).alias("role"),
        F.regexp_extract_all(text, pattern, F.lit(2)).alias("quoted"),
    )
    return F.coalesce(
        F.transform(
            parts, lambda p: turn(p["role"], _unquote(F.substring(p["quoted"], F.lit(2), F.length(p["quoted"]))))
        ),
        empty_conversation(),
    )


# -- scalars of a conversation ------------------------------------------------------------------


def first_user_content(conversation: Column) -> Column:
    """Content of the first user turn that has any; white space counts as content."""
    asked = F.filter(conversation, lambda t: (t["role"] == "user") & (text_or_empty(t["content"]) != ""))
    return F.coalesce(F.get(asked, F.lit(0))["content"], F.lit(""))


def first_content(conversation: Column) -> Column:
    return F.get(conversation, F.lit(0))["content"]


def user_turn_count(conversation: Column) -> Column:
    return F.size(user_only(conversation))
