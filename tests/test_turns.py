from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnsieve.functions import turns as tn

SENT = "array<struct<`from`:string,value:string>>"
CHAT = "array<struct<role:string,content:string>>"


def pairs(turns):
    return [(t.role, t.content) for t in turns]


def test_senders(column):
    rows = [[("human", "a"), ("gpt", None), ("system", "c"), (None, "d"), ("user", "e")], None, []]
    out = column(rows, tn.map_senders, SENT)
    assert pairs(out[0]) == [("user", "a"), ("assistant", ""), ("user", "c"), ("assistant", "d"), ("user", "e")]
    assert out[1] == [] and out[2] == []


def test_blank_and_user_turns(column):
    rows = [[("user", " \xa0"), ("assistant", "x"), ("user", "y"), ("user", None)]]
    assert pairs(column(rows, lambda c: tn.drop_blank(tn.plain_turns(c)), CHAT)[0]) == [
        ("assistant", "x"), ("user", "y"),
    ]
    assert pairs(column(rows, lambda c: tn.user_only(tn.plain_turns(c)), CHAT)[0]) == [
        ("user", " \xa0"), ("user", "y"), ("user", ""),
    ]


def test_first_user(column):
    rows = [
        [("assistant", "a"), ("user", ""), ("user", None), ("user", " "), ("user", "b")],
        [("assistant", "a")], [], None,
    ]
    assert column(rows, tn.first_user_content, CHAT) == [" ", "", "", ""]


def test_fallback(spark):
    df = spark.createDataFrame(
        [(0, [], "q", None), (1, [("user", "t")], "q", "a"), (2, [], "", "a"), (3, [], None, "a")],
        f"i int, c {CHAT}, q string, a string",
    )
    out = df.select("i", tn.with_fallback(F.col("c"), F.col("q"), F.col("a")).alias("o")).orderBy("i")
    assert [pairs(r.o) for r in out.collect()] == [
        [("user", "q"), ("assistant", "")], [("user", "t")], [], [],
    ]


def test_blocks(spark, column):
    dtype = T.ArrayType(T.StructType().add("type", "string").add("text", "string"))
    rows = [[("text", "a"), ("image", "b"), ("text", None), ("text", "c")], [], None, [("image", None)]]
    assert column(rows, lambda c: tn.blocks_text(c, dtype), dtype.simpleString()) == ["a  c", "", "", ""]
    loose = ['"s"', '[{"type":"text","text":"a"},{"type":"image"},{"type":"text"}]', "[]", "null", "3", "{}"]
    out = column(loose, lambda c: tn.blocks_text(F.parse_json(c), T.VariantType()))
    assert out == ["s", "a ", "", "", "", ""]


def printed(column, text):
    return pairs(column([text], tn.printed_turns)[0])


def test_printed_quotes_and_escapes(column):
    text = (
        "[{'role': 'user', 'content': array([{'type': 'text', 'text': 'it\\'s\\n\\x41 \\\\n'}])}\n"
        " {'role':\t'assistant', 'content': array([{'type': 'text', 'text': \"say 'hi'\\t\\\"\"}])}]"
    )
    assert printed(column, text) == [("user", "it's\nx41 \\n"), ("assistant", "say 'hi'\t\"")]


def test_printed_turns_without_text_or_end(column):
    assert printed(column, "{'role': 'user', 'x': 1} {'role': 'user', 'text': 'open\\") == [("user", "open\\")]
    assert printed(column, "{'role': 'user', 'text': 7}") == []
    assert printed(column, "nothing") == [] and printed(column, "") == []


def test_printed_first_text_of_a_turn_counts(column):
    text = "'role': 'user' 'text': 'one' 'text': 'two' 'role': 'assistant' 'text': 'three'"
    assert printed(column, text) == [("user", "one"), ("assistant", "three")]


def test_printed_marker_inside_a_text_starts_a_turn(column):
    text = """'role': 'user', 'text': "see 'role': 'assistant' here", 'role': 'user', 'text': 'b'"""
    assert printed(column, text) == [("user", "see 'role': 'assistant' here"), ("user", "b")]


def test_printed_long_text_does_not_exhaust_the_stack(column):
    long = "a\\n" * 200_000
    assert printed(column, f"'role': 'user', 'text': '{long}'") == [("user", "a\n" * 200_000)]
    gap = "'role': 'user'" + " x" * 200_000 + "'text': 'end'"
    assert printed(column, gap) == [("user", "end")]
