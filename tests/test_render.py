from pyspark.sql import functions as F

from turnsieve.operators import render

CHAT = "array<struct<role:string,content:string>>"


def prompts(spark, conversations, **caps):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(conversations)], f"i int, conversation {CHAT}")
    df = df.withColumn("n_turns", F.size("conversation"))
    return render.render_prompts(df, "P\n", "\nS", **caps).orderBy("i")


def test_shape(spark):
    out = prompts(spark, [[("user", "hi"), ("assistant", None)], []]).collect()
    assert out[0].prompt == (
        'P\n<conversation>\n<turn index="1" role="user">\nhi\n</turn>'
        '\n<turn index="2" role="assistant">\n\n</turn>\n</conversation>\nS'
    )
    assert out[1].prompt == "P\n<conversation>\n</conversation>\nS"


def test_turn_cap(spark):
    out = prompts(spark, [[("user", str(i)) for i in range(n)] for n in (1, 20, 21, 25)]).collect()
    shown = [r.prompt.count("<turn index=") for r in out]
    assert shown == [1, 20, 20, 20]
    assert ["omitted" in r.prompt for r in out] == [False, False, True, True]
    assert "\n[5 later turn(s) omitted]\n</conversation>" in out[3].prompt


def test_text_caps_by_role(spark):
    sizes = (4000, 4005, 4006)
    users = prompts(spark, [[("user", "z" * n)] for n in sizes]).collect()
    assert [r.prompt.count("z") for r in users] == [4000, 4005, 3985]
    for role in ("assistant", "system"):
        others = prompts(spark, [[(role, "z" * n)] for n in (1500, 1505, 1506)]).collect()
        assert [r.prompt.count("z") for r in others] == [1500, 1505, 1485]
        assert "z [...truncated]\n</turn>" in others[2].prompt


def back(spark, text):
    df = spark.createDataFrame([(text,)], "prompt string")
    rows = render.explode_rendered_turns(df).orderBy("turn").collect()
    note = df.select(render.rendered_note(F.col("prompt")).alias("n")).first().n
    return [(r.turn, r.role, r.content) for r in rows], note


def test_inverse(spark):
    turns = [("user", "a\n\nb"), ("assistant", " kept  spaces "), ("user", "")]
    prompt = prompts(spark, [turns], max_turns=2).first().prompt
    assert back(spark, prompt) == (
        [(1, "user", "a\n\nb"), (2, "assistant", " kept  spaces ")], "[1 later turn(s) omitted]",
    )


def test_inverse_limits(spark):
    # new lines at the ends go; a closing line ends a turn; a marker line starts one
    turns = [("user", "\n\nx\n</turn>\nlost"), ("user", 'y\n  <turn index="9" role="system"> z\nw')]
    rows, note = back(spark, prompts(spark, [turns]).first().prompt)
    assert rows == [(1, "user", "x"), (2, "user", "y"), (3, "system", "w")] and note == ""
    # the first closing tag ends the block
    assert back(spark, prompts(spark, [[("user", "a</conversation>b")]]).first().prompt)[0] == [(1, "user", "a")]
    # other line breaks come back as new lines
    assert back(spark, prompts(spark, [[("user", "a\x0bb c\r\nd\x85e")]]).first().prompt)[0] == [
        (1, "user", "a\nb\nc\nd\ne")
    ]
    assert back(spark, "no tags") == ([], "")


def test_note_inside_a_turn_is_text(spark):
    turns = [("user", "[3 later turn(s) omitted]")]
    rows, note = back(spark, prompts(spark, [turns]).first().prompt)
    assert rows == [(1, "user", "[3 later turn(s) omitted]")] and note == ""
