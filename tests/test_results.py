import pytest

from turnsieve.operators import reports, results
from turnsieve.operators.rebuild import passes

RAW = "i int, result_type string, stop_reason string, text string, input_tokens long, output_tokens long"


def parsed(spark, texts, strict=False, kind="succeeded", stop="end_turn"):
    df = spark.createDataFrame([(i, kind, stop, t, 7, None) for i, t in enumerate(texts)], RAW)
    return results.parse_responses(df, strict).orderBy("i").collect()


def answer(value, rest=', "reasoning": "r"'):
    return f'{{"conceptual": {value}, "novelty": 1, "well_formed": 2{rest}}}'


@pytest.mark.parametrize(
    "value,score",
    [("2", 2), ('"1"', 1), ("3.7", 3), ("true", 1), ("false", 0), ('" 2 "', 2), ('"2.7"', None),
     ("null", None), ("[1]", None), ("{}", None), ('"x"', None), ("-0.5", 0), ("7", 7), ("1e1", 10)],
)
def test_integers(spark, value, score):
    row = parsed(spark, [answer(value)])[0]
    assert row.conceptual == score
    assert (row.status == "ok") == (score is not None)
    if score is None:
        assert row.status.startswith("parse_error: ") and row.novelty is None
        assert row.reasoning == answer(value)[:200]


def test_bad_answers(spark):
    long = "x" * 300
    rows = parsed(spark, ["", "{", "[1]", '"s"', "3", "null", '{"conceptual": 1, "novelty": 1}', long, None])
    assert all(r.status.startswith("parse_error: ") for r in rows)
    assert all(r.conceptual is None and r.input_tokens == 7 and r.output_tokens == 0 for r in rows)
    assert rows[7].reasoning == "x" * 200


def test_reasoning(spark):
    texts = [answer(1, ""), answer(1, ', "reasoning": null'), answer(1)]
    loose, strict = parsed(spark, texts), parsed(spark, texts, strict=True)
    assert [(r.status, r.reasoning) for r in loose] == [("ok", ""), ("ok", None), ("ok", "r")]
    assert [r.status for r in strict] == ["parse_error: no reasoning", "ok", "ok"]
    assert strict[0].conceptual is None and strict[0].reasoning.startswith("parse error: no reasoning: {")


def test_doubled_key_keeps_the_last(spark):
    row = parsed(spark, ['{"conceptual": 1, "conceptual": 3, "novelty": 1, "well_formed": 1}'])[0]
    assert (row.status, row.conceptual) == ("ok", 3)


def test_other_outcomes(spark):
    for kind, status in (("errored", "errored"), ("expired", "expired"), (None, "unknown"), ("", "unknown")):
        row = parsed(spark, [answer(1)], kind=kind)[0]
        assert (row.status, row.conceptual, row.input_tokens, row.reasoning) == (status, None, 0, "")
    row = parsed(spark, [answer(1)], stop="refusal")[0]
    assert (row.status, row.conceptual, row.input_tokens, row.reasoning) == ("refusal", None, 7, "")
    assert parsed(spark, [answer(1)], strict=True, stop="refusal")[0].reasoning == "refusal"


def test_range(spark):
    df = spark.createDataFrame(
        [("ok", 0, 3, 1), ("ok", 4, 1, 1), ("ok", 1, -1, 1), ("refusal", None, None, None)],
        "status string, conceptual int, novelty int, well_formed int",
    )
    assert [r.status for r in results.check_range(df).collect()] == ["ok", "out_of_range", "out_of_range", "refusal"]


ROW = (
    "shard_id string, custom_id string, status string, conceptual int, novelty int, well_formed int, "
    "reasoning string, input_tokens long, output_tokens long"
)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 1, "why", 5, 6) if len(r) == 4 else r for r in rows], ROW)


def test_patch(spark):
    old = frame(spark, [
        ("0", "a", "ok", 1), ("0", "b", "parse_error: x", None, None, None, "t", 1, 2),
        ("0", "c", "errored", None, None, None, "", 0, 0), ("1", "a", "refusal", None, None, None, "", 3, 0),
        ("2", "z", "ok", 2),
    ])
    new = frame(spark, [
        ("0", "a", "ok", 3), ("0", "b", "ok", 3), ("0", "c", "errored", None), ("9", "q", "ok", 3),
    ])
    out = {(r.shard_id, r.custom_id): r for r in results.patch_results(old, new).collect()}
    assert len(out) == 5
    assert out["0", "a"].conceptual == 1  # an ok row never changes
    assert (out["0", "b"].status, out["0", "b"].conceptual, out["0", "b"].reasoning) == ("ok", 3, "why")
    assert out["0", "c"].status == "errored" and out["1", "a"].status == "refusal"
    assert results.patch_counts(old, new).first().asDict() == {"fixed": 1, "still_failing": 2}
    assert {r.shard_id for r in results.patched_shards(old, new).collect()} == {"0"}


def test_retry_and_pending(spark):
    old = frame(spark, [("0", "a", "ok", 1), ("0", "b", "errored", None), ("0", "gone", "errored", None)])
    requests = spark.createDataFrame(
        [("0", "a", 300, "p"), ("0", "b", 900, "q"), ("1", "a", None, "r")],
        "shard_id string, custom_id string, max_tokens int, prompt string",
    )
    retry = results.retry_set(old, requests).collect()
    assert [(r.custom_id, r.max_tokens) for r in retry] == [("b", 900)]
    assert [(r.shard_id, r.custom_id) for r in results.pending_requests(requests, old).collect()] == [("1", "a")]
    shards = requests.select("shard_id").distinct()
    assert [r.shard_id for r in results.pending_shards(shards, old).collect()] == ["1"]


def test_thresholds_and_nulls(spark):
    df = spark.createDataFrame(
        [("ok", 2, 2, 2), ("ok", None, 3, 3), (None, 2, 2, 2), ("parse_error: x", 3, 3, 3), ("ok", 2, 2, 1)],
        "status string, conceptual int, novelty int, well_formed int",
    )
    assert df.where(passes()).count() == 1
    assert df.where(passes(missing_status_is_ok=True)).count() == 2
    assert reports.yield_report(df.selectExpr("'s' source", "*")).where("source is null").first().strong == 1


def test_reports_of_nothing(spark):
    none = frame(spark, []).selectExpr("*", "'s' source", "1L prompt_chars")
    assert reports.cost_estimate(none).first().mean_prompt_tokens is None
    assert reports.cost_actual(none).first().cost == 0
    assert reports.status_counts(none).count() == 0
