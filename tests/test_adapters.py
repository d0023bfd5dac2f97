import datetime as dt

import pytest
from pyspark.sql import functions as F

from turnsieve import schemas
from turnsieve.operators.conversations import assemble_conversations
from turnsieve.sources import adapters, readers, registry

TS = dt.datetime(2024, 5, 6, 7, 8, 9)


def source(spark, rows, schema):
    """A source frame with positions in the order of the rows."""
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], schemas.T.StructType(
        schema.fields + [schemas.T.StructField("row_idx", schemas.T.LongType())]
    ))
    return df


def read(name, df):
    return registry.source_records(name, df).orderBy("row_idx").collect()


def turns(record):
    return [(t.role, t.content) for t in record.conversation]


def test_every_source_gives_the_record_shape(spark):
    assert len(registry.SOURCES) == 22
    for name, entry in registry.SOURCES.items():
        out = registry.source_records(name, source(spark, [], entry.schema))
        assert out.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.RECORD.fields], name
        assert out.count() == 0


def test_rows_without_a_position_are_refused(spark):
    with pytest.raises(ValueError, match="position"):
        adapters.chat_log(spark.createDataFrame([], schemas.CHAT_LOG))


def test_chat_log(spark):
    rows = [("h1", "m", TS, [("user", "a"), ("assistant", None)], 1, "English", "France"),
            (None, None, None, [], None, None, None)]
    one, two = read("wildchat", source(spark, rows, schemas.CHAT_LOG))
    assert (one.id, one.src_model, one.timestamp, one.n_turns, one.first_user) == (
        "h1", "m", "2024-05-06T07:08:09+00:00", 2, "a",
    )
    assert turns(one) == [("user", "a"), ("assistant", None)]
    assert (two.id, two.timestamp, two.n_turns, two.first_user) == ("", None, 0, "")


def test_flagged_forum(spark):
    rows = [
        (("p1", " T ", "<p>b &amp; c</p>", True, "u", 3, TS),),
        (("p2", "T", "b", False, "u", 3, TS),), (("p3", "T", "b", None, "u", 3, TS),), (None,),
        (("p4", None, None, True, None, None, None),), (("p5", None, "<i>only</i>", True, None, None, None),),
    ]
    out = read("lesswrong", source(spark, rows, schemas.FORUM_FLAGGED))
    assert [r.id for r in out] == ["p1", "p5"]
    assert turns(out[0]) == [("user", "T\n\nb & c")] and out[0].title == "T"
    assert (out[0].base_score, out[0].timestamp, out[0].src_model) == (3, "2024-05-06 07:08:09+00:00", "human")
    assert turns(out[1]) == [("user", "only")]


def test_flagged_forum_reads_only_what_it_uses(spark, tmp_path):
    wide = "struct<_id:string,title:string,htmlBody:string,question:boolean,pageUrl:string,baseScore:int,postedAt:timestamp,extra:string>"
    spark.createDataFrame([], f"post {wide}, other string").write.parquet(str(tmp_path / "f_0.parquet"))
    df = readers.with_positions(readers.read_parquet(spark, str(tmp_path / "f_0.parquet")))
    plan = adapters.forum_flagged(df)._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1]
    assert "extra" not in schema and "other" not in schema and "htmlBody" in schema


def test_titled_forum(spark):
    rows = [("a", "Why? ", "x", "u", 1, TS), ("b", "Why", "x", "u", 1, TS), ("c", None, "x?", "u", 1, TS),
            ("d", "?", None, None, None, None)]
    out = read("eaforum", source(spark, rows, schemas.FORUM_TITLED))
    assert [(r.id, r.title, r.first_user) for r in out] == [("a", "Why?", "Why?\n\nx"), ("d", "?", "?")]


def test_question_pairs(spark):
    rows = [
        ("q", "a", [("human", "t"), ("gpt", "  ")]), ("q2", None, None), ("", "a", None), (None, None, []),
        (None, None, [("human", "t3")]),
    ]
    out = read("philosophy_se", source(spark, rows, schemas.QA_PAIRS))
    assert [turns(r) for r in out] == [
        [("user", "t"), ("assistant", "  ")], [("user", "q2"), ("assistant", "")], [("user", "t3")],
    ]
    assert [r.title for r in out] == ["q", "q2", "t3"] and len({r.id for r in out}) == 3


def test_site(spark):
    rows = [([("human", " "), ("gpt", "a"), ("human", "b")],), ([("human", " ")],), (None,)]
    (only,) = read("se_law", source(spark, rows, schemas.QA_SITE))
    assert (only.source, only.title, turns(only)) == ("se_law", "a", [("assistant", "a"), ("user", "b")])


def test_preference_shared_and_gated(spark):
    history = [("user", "a"), ("model", "b"), ("user", " "), ("user", "c")]
    (only,) = read("prism", source(spark, [("p", "open", history, TS), ("q", "open", history[1:3], TS)], schemas.PREFERENCE_CHAT))
    assert (turns(only), only.conversation_type) == ([("user", "a"), ("user", "c")], "open")
    sent = [("system", "s"), ("human", "h"), ("gpt", None)]
    one, two = read("sharegpt", source(spark, [("i", sent), (None, sent)], schemas.SHARED_CHAT))
    assert turns(one) == [("user", "s"), ("user", "h")] and one.language is None and one.src_model == "unknown"
    assert two.id is None
    rows = [("c", "m", [("system", "s"), ("user", "u")], lang) for lang in ("English", "ENGLISH", "en", None)]
    out = read("lmsys", source(spark, rows, schemas.GATED_CHAT))
    assert [r.row_idx for r in out] == [0, 1]
    assert turns(out[0]) == [("system", "s"), ("user", "u")] and out[0].src_model == "m"


def test_arena_forms(spark):
    text = [("text", "q"), ("image", None), ("text", "r")]
    rows = [("i", [("user", text), ("assistant", text)], "EN"), ("j", [("user", [])], "en"), ("k", None, "en"),
            ("l", [("user", text)], "polish")]
    (only,) = read("arena_140k", source(spark, rows, schemas.ARENA_BLOCKS))
    assert turns(only) == [("user", "q r")]
    rows = [("i", "'role': 'user' 'text': 'q' 'role': 'assistant' 'text': 'r'", "english"), ("j", None, "en")]
    (only,) = read("arena_expert", source(spark, rows, schemas.ARENA_PRINTED))
    assert turns(only) == [("user", "q")] and only.source == "arena_expert"


def test_tree_roots(spark):
    rows = [("a", None, " x ", "prompter", "en", None), ("b", None, "x", "prompter", "en", True),
            ("c", "a", "x", "prompter", "en", False), ("d", None, "x", "assistant", "en", False),
            ("e", None, "x", "prompter", "EN", False), ("f", None, " \xa0", "prompter", "en", False)]
    (only,) = read("oasst2", source(spark, rows, schemas.MESSAGE_TREE))
    assert (only.id, turns(only)) == ("a", [("user", "x")])


CHATS = {
    "a": [("user", "q"), ("assistant", " "), ("user", "r")], "b": [("assistant", "x")],
    "c": [("user", " "), ("user", "\xa0")], "d": [("system", "s"), ("user", "u")] + [("user", str(i)) for i in range(40)],
}


@pytest.mark.parametrize("name,rules", [
    ("prism", adapters.PREFERENCE_CHAT), ("lmsys", adapters.GATED_CHAT), ("sharegpt", adapters.SHARED_CHAT),
    ("se_law", adapters.qa_site_rules("law")),
])
def test_long_tables_give_the_same_records(spark, name, rules):
    ids = list(CHATS)
    if rules.senders:
        stored = {k: [({"user": "human"}.get(r, r), c) for r, c in v] for k, v in CHATS.items()}
        names = ("from", "value")
    else:
        stored, names = CHATS, ("role", "content")
    arrays = {
        "prism": [(k, "t", stored[k], TS) for k in ids], "lmsys": [(k, "m", stored[k], "English") for k in ids],
        "sharegpt": [(k, stored[k]) for k in ids], "se_law": [(stored[k],) for k in ids],
    }[name]
    want = read(name, source(spark, arrays, registry.SOURCES[name].schema))
    extra = {
        "prism": {"timestamp": F.lit("2024-05-06 07:08:09+00:00"), "conversation_type": F.lit("t")},
        "lmsys": {"language": F.lit("English"), "model": F.lit("m")},
    }.get(name, {})
    rows = [(k, i, n, *t) for i, k in enumerate(ids) for n, t in enumerate(stored[k])]
    long = spark.createDataFrame(rows, ["id", "row_idx", "turn", *names]).withColumns(extra).repartition(5)
    got = adapters.chat_records_from_turns(long, rules, text_key=name == "se_law").orderBy("row_idx").collect()
    assert [r.asDict(recursive=True) | {"conversation": None} for r in got] == [
        r.asDict(recursive=True) | {"conversation": None} for r in want
    ]
    assert [turns(r) for r in got] == [turns(r) for r in want]


def test_one_long_conversation(spark):
    df = spark.range(60_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 7000)).alias("id"),
        F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("content"),
    )
    whole = assemble_conversations(df)
    hot = whole.where("id = 'hot'").first()
    assert (hot.n_turns, hot.first_user, [t.content for t in hot.conversation]) == (20_000, "0", [str(3 * i) for i in range(20_000)])
    assert "SortAggregate" not in whole._jdf.queryExecution().executedPlan().toString()
    out = assemble_conversations(df, head_turns=20)
    hot = out.where("id = 'hot'").first()
    assert (hot.n_turns, hot.n_user_turns, hot.first_user, len(hot.conversation)) == (20_000, 20_000, "0", 20)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Broadcast" not in plan


def test_positions_follow_file_numbers(spark, tmp_path):
    for number in (10, 9):
        spark.createDataFrame([(number, i) for i in range(3)], "f int, r int").coalesce(1).write.parquet(
            str(tmp_path / f"w{number}")
        )
        (part,) = (tmp_path / f"w{number}").glob("*.parquet")
        (tmp_path / f"train-{number:05d}.parquet").write_bytes(part.read_bytes())
    files = [str(tmp_path / f"train-{n:05d}.parquet") for n in (10, 9)]
    out = readers.with_positions(readers.read_parquet(spark, files)).collect()
    assert {(r.f, r.r) for r in out} == {(r.file_idx, r.row_idx) for r in out} and len(out) == 6


def test_json_array(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": "x", "conversations": [{"from": "human", "value": "q"}]}, {"id": null}]')
    df = readers.read_json_array(spark, str(tmp_path / "a.json"), schemas.SHARED_CHAT, str(tmp_path / "p"))
    (only,) = registry.source_records("sharegpt", df).collect()
    assert (only.id, only.row_idx, turns(only)) == ("x", 0, [("user", "q")])


def test_digits_too_long_for_a_number(spark, tmp_path):
    spark.range(2).coalesce(1).write.parquet(str(tmp_path / "w"))
    (part,) = (tmp_path / "w").glob("*.parquet")
    (tmp_path / f"train-{'9' * 23}.parquet").write_bytes(part.read_bytes())
    placed = readers.with_positions(readers.read_parquet(spark, str(tmp_path / f"train-{'9' * 23}.parquet")))
    assert sorted((r.file_idx, r.row_idx) for r in placed.collect()) == [(0, 0), (0, 1)]


def test_files_with_one_number_are_numbered_by_path(spark, tmp_path):
    for name in ("train-0", "test-0"):
        spark.createDataFrame([(1,)], "x int").coalesce(1).write.parquet(str(tmp_path / "w" / name))
        (part,) = (tmp_path / "w" / name).glob("*.parquet")
        (tmp_path / f"{name}.parquet").write_bytes(part.read_bytes())
    df = readers.read_parquet(spark, [str(tmp_path / "train-0.parquet"), str(tmp_path / "test-0.parquet")])
    df = df.select("*", "_metadata", F.col("_metadata.file_name").alias("name"))
    rows = readers.with_positions(df).collect()
    assert {r.name: r.file_idx for r in rows} == {"test-0.parquet": 0, "train-0.parquet": 1}


def test_positions_of_a_folder_that_was_appended_to(spark, tmp_path):
    folder = str(tmp_path / "by language")
    for start in (0, 50):
        df = spark.range(start, start + 50).withColumn("lang", F.concat(F.lit("l"), F.col("id") % 3)).repartition(2)
        df.write.partitionBy("lang").mode("append").parquet(folder)
    placed = readers.with_positions(spark.read.parquet(folder))
    assert placed.columns == ["id", "lang", "file_idx", "row_idx"]
    rows = placed.collect()
    assert len(rows) == len({(r.file_idx, r.row_idx) for r in rows}) == 100
    files = {r.file_idx for r in rows}
    assert files == set(range(len(files))) and [tuple(r) for r in rows] == [tuple(r) for r in placed.collect()]
