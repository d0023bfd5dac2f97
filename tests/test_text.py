import html
import json
import re

import pytest

from turnsieve.functions import keys, text as tx

SPACES = ["\t", "\xa0", " ", "　", "\x1c", "\x85", "\x1f", " "]


def words(s):
    return " ".join(s.split())


def test_white_space_is_that_of_python():
    assert set(tx.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_strip_collapse_and_blank(column):
    texts = [f"{a}one{b}two{a}{b}" for a in SPACES for b in SPACES] + ["", "   ", "\x1c\x85", "a​b", None]
    assert column(texts, tx.strip) == [t and t.strip() for t in texts]
    assert column(texts, tx.collapse) == [t if t is None else words(t) for t in texts]
    assert column(texts, tx.has_text) == [bool((t or "").strip()) for t in texts]


@pytest.mark.parametrize("size", [299, 300, 301])
def test_dedup_key_cuts_before_it_collapses(column, size):
    texts = ["x" * size + "tail", "X" * size + "TAIL", "a " * size, " " * size + "end", "é" * size]
    keys_ = column(texts, tx.dedup_key)
    assert keys_ == [words(t[:300].lower()) for t in texts]
    assert keys_[0] == keys_[1]


def test_dedup_key_counts_code_points(column):
    texts = ["x" * 299 + "😀tail", "x" * 300 + "😀"]
    assert column(texts, tx.dedup_key) == ["x" * 299 + "😀", "x" * 300]


def test_previews(column):
    texts = ["a  b\n" * 100, "x" * 200, " \t ", "", "short", " " * 500 + "late " * 40, "y" * 70, "y" * 71, "y" * 70 + "  "]
    flat = [words(t) for t in texts]
    assert column(texts, tx.preview) == [f[:90] for f in flat]
    assert column(texts, tx.scan_preview) == [
        (f[:70] + ("…" if len(f) > 70 else "")) if f else "(no user content)" for f in flat
    ]


def test_truncation_leeway(column):
    texts = ["u" * n for n in (100, 105, 106)]
    assert column(texts, lambda c: tx.truncate(c, 100)) == [
        texts[0], texts[1], "u" * 85 + " [...truncated]",
    ]


def test_json_length(column):
    texts = ["plain", 'q"b\\s', "\n\r\t\b\f", "\x00\x1f\x7f", "é漢 ", "😀𝄞", "", 'mix "é"\n😀\\']
    assert column(texts, tx.ascii_json_length) == [len(json.dumps(t)) - 2 for t in texts]


def test_html(spark):
    pages = [
        "<p>a</p><b\nclass='x'>b</b>", "a < b and c > d", "&amp;lt;b&amp;gt;", "x&nbsp;&nbsp;y &nbsp;",
        "<script>var x = 1;</script>t", None, "&#65;&#x42;&bogus;&eacute &notit; &amp &copy2",
        "&lt;b&gt; &amp;amp; &hellip;", "  \n\t ", "a &; b & c &#xZZ;", "&AMP; &Eacute;l&aacute;n",
    ]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, page string")
    rows = tx.with_html_text(df, "page", "text").orderBy("i").collect()
    assert [r.text for r in rows] == [
        html.unescape(words_around(re.sub("<[^>]+>", " ", p or ""))).strip() for p in pages
    ]
    plain = tx.with_html_text(df, "page", "text", full=False).where("i = 2").first()
    assert plain.text == "&lt;b&gt;"


def words_around(s):
    """White space runs to single spaces, those at the ends too."""
    out = words(s)
    return (" " if s[:1].isspace() else "") + out + (" " if out and s[-1:].isspace() else "")


def test_iso_timestamps(spark):
    import datetime as dt

    stamps = [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5, 60), None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], "i int, t timestamp_ntz")
    from pyspark.sql import functions as F

    out = df.select("i", tx.iso_timestamp(F.col("t"), offset=False).alias("s")).orderBy("i").collect()
    assert [r.s for r in out] == [s.isoformat() if s else None for s in stamps]
    zoned = df.select("i", tx.iso_timestamp(F.col("t").cast("timestamp")).alias("s")).orderBy("i").first()
    assert zoned.s == "2024-01-02T03:04:05+00:00"


def test_natural_key(column):
    values = column(["a", None, "é", ""], keys.natural_key)
    assert values[0] == "1ba3c523e770f3313cc91ab1"
    assert values[1] is None and len({*values}) == 4 and len(values[2]) == 24


def test_id_shape(column):
    texts = ["a" * 64, "a" * 65, "a b", "", None, "ok_-9", "ok\n", "é"]
    assert column(texts, keys.valid_id) == [True, False, False, False, False, True, False, False]
