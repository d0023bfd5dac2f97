"""Rendering a conversation into one bounded prompt, and reading such a prompt back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip, text_or_empty, truncate

# Caps and markers of a rendered conversation.
MAX_TURNS = 20
MAX_USER_CHARS = 4000
MAX_OTHER_CHARS = 1500
OPEN_TAG = "<conversation>"
CLOSE_TAG = "</conversation>"
TURN_OPEN = '<turn index="%d" role="%s">'
TURN_CLOSE = "</turn>"
OMITTED_NOTE = "[%d later turn(s) omitted]"


def rendered_body(
    conversation: Column,
    n_turns: Column,
    max_turns: int | None = MAX_TURNS,
    max_user_chars: int | None = MAX_USER_CHARS,
    max_other_chars: int | None = MAX_OTHER_CHARS,
) -> Column:
    """The part of a prompt that differs between conversations: capped turns and the omitted note.

    A cap of ``None`` is none.

    ``conversation`` may hold more turns than are shown, or just the shown ones; ``n_turns`` is the
    true number. The result is bounded by the caps, where all are set.
    """

    def capped(text: Column, cap: int | None) -> Column:
        return text if cap is None else truncate(text, cap)

    def shown(t: Column, i: Column) -> Column:
        text = text_or_empty(t["content"])
        text = F.when(t["role"] == "user", capped(text, max_user_chars)).otherwise(
            capped(text, max_other_chars)
        )
        role = F.coalesce(t["role"], F.lit("None"))
        # not format_string: it would scan the text for the format on every turn
        opening, middle, ending = TURN_OPEN.replace("%d", "%s").split("%s")
        return F.concat(
            F.lit(f"\n{opening}"),
            (i + 1).cast("string"),
            F.lit(middle),
            role,
            F.lit(f"{ending}\n"),
            text,
            F.lit(f"\n{TURN_CLOSE}"),
        )

    if max_turns is None:
        return F.array_join(F.transform(conversation, shown), "")
    before, after = OMITTED_NOTE.split("%d")
    note = F.when(
        n_turns > max_turns,
        F.concat(F.lit(f"\n{before}"), (n_turns - max_turns).cast("string"), F.lit(after)),
    ).otherwise(F.lit(""))
    return F.concat(F.array_join(F.transform(F.slice(conversation, 1, max_turns), shown), ""), note)


def static_text(prefix: str, suffix: str) -> tuple[str, str]:
    """What stands before and after every body. The rubric comes first, so a scorer can cache it."""
    return prefix + OPEN_TAG, f"\n{CLOSE_TAG}{suffix}"


def full_prompt(body: Column, prefix: str, suffix: str) -> Column:
    """Add the static text; done after all shuffles."""
    before, after = static_text(prefix, suffix)
    return F.concat(F.lit(before), body, F.lit(after))


def render_prompts(
    records: DataFrame, prefix: str = "", suffix: str = "", **caps: int
) -> DataFrame:
    body = rendered_body(F.col("conversation"), F.col("n_turns"), **caps)
    return records.withColumn("prompt", full_prompt(body, prefix, suffix))


# -- inverse ---------------------------------------------------------------------------------

# white space within a line
_BLANK = r"[\s\x1f&&[^\n]]*+"
_LINE_BREAK = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}]"
_MARK = rf'{_BLANK}<turn index="(\d+)" role="(\w+)">'
_ANY_MARK = rf'{_BLANK}<turn index="\d+" role="\w+">'
_END = rf"{_BLANK}</turn>{_BLANK}$"
# a marker line, then every line that neither ends the turn nor starts another one
_TURN = rf"(?msdU)^{_MARK}[^\n]*+(?:\n|\z)((?:(?!{_ANY_MARK}|{_END})[^\n]*+(?:\n|\z))*+)"
_NOTE = rf"(?mdU)^{_BLANK}(\[[^\n]*later turn[^\n]*)$"


def explode_rendered_turns(df: DataFrame, column: str = "prompt") -> DataFrame:
    """Rows ``(…, turn, role, content)`` of the turns shown in each prompt.

    Only the text between the first opening and the first closing tag is read. Lines break at any
    Unicode line break; a turn ends at a closing line or at the next marker line, and new lines at both
    ends of its text are not part of it, so texts that hold such lines do not come back as they were.
    """
    turns = rendered_turns(F.col(column))
    kept = [c for c in df.columns if c != column]
    return df.select(*kept, F.posexplode(turns)).select(
        *kept,
        (F.col("pos") + 1).alias("turn"),
        F.col("col.role").alias("role"),
        F.col("col.content").alias("content"),
    )


def _block(prompt: Column) -> Column:
    start = F.instr(prompt, OPEN_TAG)
    end = F.instr(prompt, CLOSE_TAG)
    first = start + len(OPEN_TAG)
    block = F.when(
        (start > 0) & (end > first), F.substring(prompt, first, end - first)
    ).otherwise(F.lit(""))
    return F.regexp_replace(block, _LINE_BREAK, "\n")


def rendered_turns(prompt: Column) -> Column:
    block, pattern = _block(prompt), F.lit(_TURN)
    parts = F.arrays_zip(
        F.regexp_extract_all(block, pattern, F.lit(2)).alias("role"),
        F.regexp_extract_all(block, pattern, F.lit(3)).alias("content"),
    )
    return F.transform(
        parts,
        lambda p: F.struct(
            p["role"].alias("role"), F.btrim(p["content"], F.lit("\n")).alias("content")
        ),
    )


def rendered_note(prompt: Column) -> Column:
    """The last note on omitted turns that stands outside of any turn; empty when there is none."""
    outside = F.regexp_replace(_block(prompt), _TURN, "")
    notes = F.regexp_extract_all(outside, F.lit(_NOTE), F.lit(1))
    return F.coalesce(strip(F.get(notes, F.size(notes) - 1)), F.lit(""))
