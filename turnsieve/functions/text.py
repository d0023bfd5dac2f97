"""Column expressions on text. All of them stay inside Catalyst unless a docstring says otherwise."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters that count as white space, and the same set inside a pattern's class.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACES = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
DEDUP_PREFIX = 300
PREVIEW_WIDTH = 90
SCAN_PREVIEW_WIDTH = 70
SCAN_PREVIEW_EMPTY = "(no user content)"
ELLIPSIS = "…"
TRUNCATION_SUFFIX = " [...truncated]"
TRUNCATION_LEEWAY = 5

# Entities resolved without leaving the JVM; any other reference goes through the full table.
PLAIN_ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&nbsp;": "\xa0",
    "&copy;": "\xa9",
    "&middot;": "\xb7",
    "&mdash;": "—",
    "&ndash;": "–",
    "&hellip;": "…",
    "&rsquo;": "’",
    "&lsquo;": "‘",
    "&rdquo;": "”",
    "&ldquo;": "“",
    "&amp;": "&",  # last, so that an escaped ampersand is resolved once only
}


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends (linear, no pattern)."""
    return F.btrim(text, F.lit(WHITESPACE))


def single_spaces(text: Column) -> Column:
    """Every run of white space becomes one space."""
    return F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+", " ")


def collapse(text: Column) -> Column:
    """Every run of white space becomes one space; none is left at the ends."""
    return F.btrim(single_spaces(text), F.lit(" "))


def has_text(text: Column) -> Column:
    """True unless the text is null, empty or white space only. Stops at the first other character."""
    return F.coalesce(text.rlike(f"[^{SPACES}]"), F.lit(False))


def dedup_key(first_user: Column, prefix: int = DEDUP_PREFIX) -> Column:
    """Cut first, then lower, then collapse: extra spaces inside the window change the key."""
    return collapse(F.lower(F.substring(first_user, 1, prefix)))


def key_digest(key: Column) -> Column:
    """Sixteen bytes of SHA-256 in hex; shuffled and stored in place of the key itself."""
    return F.substring(F.sha2(key, 256), 1, 32)


def _start(text: Column, chars: int) -> Column:
    """A start of ``text`` with as many characters other than white space, or all of it if it has
    fewer. Collapsed, it begins like the whole text does; the rest of a long text is not read."""
    return F.regexp_extract(text, f"^(?:[{SPACES}]*+[^{SPACES}]){{0,{chars}}}+", 0)


def preview(first_user: Column, width: int = PREVIEW_WIDTH) -> Column:
    return F.substring(collapse(_start(first_user, width)), 1, width)


def scan_preview(first_user: Column, width: int = SCAN_PREVIEW_WIDTH) -> Column:
    line = collapse(_start(text_or_empty(first_user), width + 1))
    return F.when(line == "", F.lit(SCAN_PREVIEW_EMPTY)).otherwise(
        F.concat(
            F.substring(line, 1, width),
            F.when(F.length(line) > width, F.lit(ELLIPSIS)).otherwise(F.lit("")),
        )
    )


def truncate(text: Column, cap: int, suffix: str = TRUNCATION_SUFFIX) -> Column:
    """Hard cut with the suffix inside the cap; text a few characters over the cap stays whole."""
    return F.when(F.length(text) <= cap + TRUNCATION_LEEWAY, text).otherwise(
        F.concat(F.substring(text, 1, cap - len(suffix)), F.lit(suffix))
    )


def ascii_json_length(text: Column) -> Column:
    """Length of ``text`` inside a JSON string where everything but printable ASCII is escaped.

    Quotes and backslashes take two characters. What is left without printable ASCII is short: short
    escapes take two, a surrogate pair twelve, and any other character six.
    """
    bare = F.replace(F.replace(text, F.lit('"'), F.lit("")), F.lit("\\"), F.lit(""))
    rest = F.regexp_replace(text, "[ -~]++", "")
    short = F.length(rest) - F.length(F.regexp_replace(rest, r"[\n\r\t\x08\x0c]++", ""))
    pairs = F.length(rest) - F.length(F.regexp_replace(rest, r"[\x{10000}-\x{10ffff}]++", ""))
    return 2 * F.length(text) - F.length(bare) + 5 * F.length(rest) - 4 * short + 6 * pairs


def iso_timestamp(ts: Column, separator: str = "T", offset: bool = True) -> Column:
    """Timestamp as text: no fraction when it is zero, six digits otherwise, then the zone offset."""
    day_time = F.concat_ws(
        separator, F.date_format(ts, "yyyy-MM-dd"), F.date_format(ts, "HH:mm:ss")
    )
    fraction = F.date_format(ts, ".SSSSSS")
    out = F.concat(day_time, F.when(fraction == ".000000", F.lit("")).otherwise(fraction))
    if offset:
        out = F.concat(out, F.date_format(ts, "xxx"))
    return F.when(ts.isNotNull(), out)


@F.pandas_udf(T.StringType())
def _unescape_all(text: pd.Series) -> pd.Series:
    return text.map(html.unescape, na_action="ignore")


def _plain_unescape(text: Column) -> Column:
    for reference, char in PLAIN_ENTITIES.items():
        text = F.replace(text, F.lit(reference), F.lit(char))
    return text


def with_html_text(df: DataFrame, markup: str, name: str, full: bool = True) -> DataFrame:
    """Add the text of ``markup``: tags become a space, white space runs become one space, then
    character references are resolved, then the ends are stripped.

    The references in ``PLAIN_ENTITIES`` are replaced by Catalyst. With ``full`` a text holding any
    other one goes, whole and as it was, through the standard library's table by Arrow; all other
    texts travel as null. The text without tags is a column of its own, so it is made only once.
    """
    bare = single_spaces(F.regexp_replace(text_or_empty(F.col(markup)), "<[^>]+>", " "))
    df = df.withColumn("_bare", bare)
    plain = _plain_unescape(F.col("_bare"))
    if full:
        names = "|".join(r[1:-1] for r in PLAIN_ENTITIES)
        other = F.col("_bare").rlike(rf"&(?!(?:{names});)(?=[#A-Za-z])")
        plain = F.coalesce(_unescape_all(F.when(other, F.col("_bare"))), plain)
    return df.withColumn(name, strip(plain)).drop("_bare")


def title_and_body(title: Column, body: Column) -> Column:
    return strip(F.concat(text_or_empty(title), F.lit("\n\n"), text_or_empty(body)))
