import json

import pytest
from pyspark.sql import functions as F

from turnsieve import session
from turnsieve.functions.turns import turn
from turnsieve.operators import dedup, rebuild, render, results, scoring, select
from turnsieve.operators.conversations import records
from turnsieve import schemas
from turnsieve.plans import config, prepare, publish, retry
from turnsieve.plans import rebuild as plan_rebuild
from turnsieve.sources import readers, sinks

CONFIG = config.RunConfig("d", "m", "RUBRIC\n", "\nEND", shard_max_requests=3, shard_max_bytes=2400)


def chats(spark, texts, file_rows=4, language="English"):
    rows = [(i // file_rows, i % file_rows, f"id{i % 7}", t, language) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "file_idx long, row_idx long, key string, t string, language string")
    return records(
        df, source=F.lit("s"), id=F.col("key"), language=F.col("language"),
        conversation=F.array(turn(F.lit("user"), F.col("t"))),
    )


TEXTS = ["one", "ONE ", "two\n\"q\"", "", " ", "é漢😀", "x" * 1200, "y" * 5000, "two \"q\"", "last\\"]


def test_prepare(spark):
    df = prepare.with_prompt(prepare.prepare(chats(spark, TEXTS), CONFIG), CONFIG)
    out = df.orderBy("file_idx", "row_idx").collect()
    # each first text stays, the empty key once; ids and ordinals are of one file
    assert [(r.file_idx, r.row_idx) for r in out] == [(0, 0), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 1)]
    assert [r.ordinal for r in out] == [0, 1, 2, 0, 1, 2, 0]
    assert [r.custom_id for r in out] == ["id0", "id2", "id3", "id5", "id6", "id0", "id2"]
    for r in out:
        params = {
            "model": "m", "max_tokens": 300, "output_config": CONFIG.output_config(),
            "messages": [{"role": "user", "content": r.prompt}],
        }
        assert r.n_bytes == len(json.dumps({"custom_id": r.custom_id, "params": params}))
        assert r.prompt_chars == len(r.prompt)
        assert r.prompt.startswith("RUBRIC\n<conversation>\n<turn") and r.prompt.endswith("</conversation>\nEND")
    shards = {}
    for r in out:
        shards.setdefault((r.file_idx, r.shard_id), []).append(r.n_bytes)
    assert all(k[1].startswith(f"{k[0]:04d}_") for k in shards)
    assert all(len(v) == 1 or (len(v) <= 3 and sum(v) <= 2400) for v in shards.values())


def test_prepare_by_adapter_rules(spark):
    out = prepare.prepare(chats(spark, TEXTS), CONFIG, prepare.ADAPTER).orderBy("ordinal").collect()
    # rows 7, 8, 9 lose by id; the two rows without a text key are dropped
    assert [(r.file_idx, r.row_idx) for r in out] == [(0, 0), (0, 2), (1, 1), (1, 2)]
    assert [r.ordinal for r in out] == [0, 1, 2, 3] and all(len(r.shard_id) == 4 for r in out)


def test_language_filter(spark):
    assert prepare.survivors(chats(spark, TEXTS, language="German"), CONFIG).count() == 0
    assert prepare.survivors(chats(spark, TEXTS, language=None), CONFIG).count() == 0


def exchanges(df):
    """Columns of every shuffle in the plan."""
    stack, found = [df._jdf.queryExecution().executedPlan()], []
    while stack:
        n = stack.pop()
        if n.nodeName() == "AdaptiveSparkPlan":
            stack.append(n.executedPlan())
        if n.nodeName() == "Exchange":
            found.append({c.split("#")[0] for c in n.output().mkString(",").split(",")})
        stack += [n.children().apply(i) for i in range(n.children().length())]
    return found


@pytest.mark.parametrize("rules", [prepare.CHAT_LOG, prepare.ADAPTER])
def test_bodies_are_shuffled_once(spark, tmp_path, rules):
    """With a slim side too large to broadcast a body crosses one exchange, and unbounded texts cross none."""
    chats(spark, TEXTS).write.parquet(str(tmp_path / "chats"))
    rows = spark.read.parquet(str(tmp_path / "chats"))
    with session.settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plans = [exchanges(f(rows, CONFIG, rules)) for f in (prepare.survivors, prepare.prepare)]
    for found in plans:
        assert sum("body" in names for names in found) == 1
        assert not any(names & {"first_user", "conversation"} for names in found)


@pytest.mark.parametrize("steps", [1, 2])
def test_whole_rows_are_shuffled_once_for_both_steps(spark, tmp_path, steps):
    chats(spark, TEXTS).write.parquet(str(tmp_path / "chats"))
    rows = spark.read.parquet(str(tmp_path / "chats"))
    with session.settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        found = exchanges(dedup.keep_first_text(rows) if steps == 1 else dedup.keep_first_by_id_then_text(rows))
    assert sum("conversation" in names for names in found) == 1


def test_stored_spellings_reach_the_reader(spark, tmp_path):
    import dataclasses

    rows = chats(spark, TEXTS, language="English").unionByName(chats(spark, ["three"], language="german"))
    rows.write.parquet(str(tmp_path / "chats"))
    run = dataclasses.replace(CONFIG, language="english", stored_languages=("English", "english"))
    df = prepare.survivors(spark.read.parquet(str(tmp_path / "chats")), run)
    assert "PushedFilters: [In(language, [English,english])" in df._jdf.queryExecution().toString()
    assert df.count() == prepare.survivors(rows, CONFIG).count()


def test_caps_are_settings(spark):
    import dataclasses

    whole = dataclasses.replace(CONFIG, max_turns=None, max_user_chars=None, max_other_chars=None)
    bodies = [r.body for r in prepare.survivors(chats(spark, TEXTS), whole).collect()]
    assert any("y" * 5000 in b for b in bodies)
    assert set(config.drift(CONFIG.values(), whole)) == {"max_turns", "max_user_chars", "max_other_chars"}
    assert whole.fingerprint != CONFIG.fingerprint


def test_positions_of_any_size(spark):
    rows = [("a", 2**40, 5), ("a", 2**40 - 1, 2**50), ("b", 20240115, 2**62), ("b", 20240115, 2**62 - 1), ("c", 2**62, 0), ("d", 0, 0)]
    df = spark.createDataFrame(rows, "key string, file_idx long, row_idx long")
    found = {r.key: (r.file_idx, r.row_idx) for r in rebuild.first_positions(df).collect()}
    assert found == {"a": (2**40 - 1, 2**50), "b": (20240115, 2**62 - 1), "c": (2**62, 0), "d": (0, 0)}
    assert "SortAggregate" not in rebuild.first_positions(df)._jdf.queryExecution().executedPlan().toString()


def test_made_up_ids_do_not_collide_with_own_ones(spark):
    from turnsieve.operators import ordinals

    rows = [(0, "row_000002"), (1, "x"), (2, ""), (3, "row_7"), (4, "r0000004")]
    df = spark.createDataFrame(rows, "ordinal long, id string").withColumn("scope", F.lit(0))
    ids = [r.custom_id for r in ordinals.with_request_id(df, ["scope"]).orderBy("ordinal").collect()]
    assert ids == ["row_000000", "x", "row_000002", "row_000003", "r0000004"]


def test_several_attempts_at_one_request(spark):
    kinds = "shard_id string, custom_id string, status string, conceptual int, novelty int, well_formed int, reasoning string, input_tokens long, output_tokens long"
    first = spark.createDataFrame([("0", "a", "errored", None, None, None, "", 0, 0), ("0", "b", "ok", 1, 1, 1, "", 1, 1)], kinds)
    again = [("0", "a", "ok", 1, 1, 1, "x", 1, 1, 1), ("0", "a", "ok", 2, 2, 2, "y", 2, 2, 2), ("0", "a", "errored", None, None, None, "", 0, 0, 3)]
    retried = spark.createDataFrame(again, kinds + ", attempt int")
    rows = {r.custom_id: r for r in results.patch_results(first, retried, order=["attempt"]).collect()}
    assert len(rows) == 2 and (rows["a"].reasoning, rows["b"].conceptual) == ("y", 1)
    assert results.patch_results(first, retried).count() == 2
    assert results.patch_counts(first, retried).first().fixed == 1


def test_shards_round_trip(spark, tmp_path):
    df = session.written(prepare.prepare(chats(spark, TEXTS), CONFIG), "requests")
    folder = str(tmp_path / "shards")
    sinks.write_shards(df, folder, lambda requests: prepare.request_lines(requests, CONFIG))
    assert all(p.suffix == ".gz" for p in (tmp_path / "shards").glob("*/part*"))
    back = {(r.shard_id, r.custom_id): r for r in readers.read_shard_requests(spark, folder).collect()}
    want = prepare.with_prompt(df, CONFIG).collect()
    assert len(back) == len(want)
    for r in want:
        line = back[r.shard_id, r.custom_id]
        assert line.params.messages[0].content == r.prompt and line.fingerprint == CONFIG.fingerprint
        assert line.params.output_config.toPython() == CONFIG.output_config()
    manifest = readers.read_shards(spark, folder).select("shard_id", "custom_id", "manifest.*")
    assert {(r.conversation_hash, r.n_turns) for r in manifest.collect()} == {(r.id, 1) for r in want}


def test_guard(spark, tmp_path):
    folder = str(tmp_path)
    config.guard(spark, folder, CONFIG)
    config.guard(spark, folder, CONFIG)
    import dataclasses

    same = dataclasses.replace(CONFIG, shard_max_requests=5)  # packing may change
    config.guard(spark, folder, same)
    other = dataclasses.replace(CONFIG, model="n", prefix="OTHER")
    with pytest.raises(config.ConfigDrift, match="template_sha.*model|model.*template_sha"):
        config.guard(spark, folder, other)
    config.guard(spark, folder, other, force=True)
    assert len(CONFIG.fingerprint) == 16 and other.fingerprint != CONFIG.fingerprint
    assert config.fingerprint({"b": 1, "a": 2}) == config.fingerprint({"a": 2, "b": 1})


def bad_scorer():
    def answer(prompts):
        if any("two" in p for p in prompts):
            raise RuntimeError("no luck")
        return [{"result_type": "succeeded", "text": '{"conceptual":1,"novelty":1,"well_formed":1}'} for _ in prompts]

    return answer


def test_scoring_failures_are_rows(spark):
    df = session.written(prepare.prepare(chats(spark, TEXTS), CONFIG), "requests")
    static = render.static_text(CONFIG.prefix, CONFIG.suffix)
    raw = scoring.score_prompts(df, bad_scorer, prompt="body", static=static, partitions=3)
    out = results.parse_responses(raw).collect()
    assert len(out) == df.count()
    assert sorted(r.status for r in out) == ["errored"] + ["ok"] * (len(out) - 1)
    told = results.parse_responses(raw, strict=True).where("status = 'errored'").first()
    assert told.reasoning == "API error: no luck"


def test_short_answers_are_failures(spark):
    df = spark.createDataFrame([("0", "a", "p"), ("0", "b", "q")], "shard_id string, custom_id string, prompt string")
    raw = scoring.score_prompts(df, lambda: (lambda prompts: []), partitions=1).collect()
    assert [r.result_type for r in raw] == ["errored"] * 2


def test_publish_patch_and_rebuild(spark, tmp_path):
    source = chats(spark, TEXTS)
    df = session.written(prepare.prepare(source, CONFIG), "requests")
    cues = {a: ("x", "n", "e") for a in ("conceptual", "novelty", "well_formed")}
    raw = session.written(scoring.score_prompts(df, scoring.LexicalScorer(cues), prompt="body"), "raw")
    full = results.attach_manifest(results.check_range(results.parse_responses(raw)), prepare.manifest(df))
    full = full.withColumn("batch_id", F.lit("b"))
    sinks.write_results(full, str(tmp_path / "results"))
    merged = readers.read_results(spark, str(tmp_path / "results"))
    assert merged.count() == 7
    scores = publish.score_table(merged)
    assert "reasoning" not in scores.columns and "first_user_preview" not in scores.columns
    sinks.write_scores(scores, str(tmp_path / "scores"))
    back = readers.read_scores(spark, str(tmp_path / "scores"))
    assert sorted(map(str, back.collect())) == sorted(map(str, scores.select(*back.columns).collect()))
    path, coverage = plan_rebuild.rebuild_to(
        str(tmp_path), "s", back.withColumn("ord", F.lit(0)), source, 1, 1, 1
    )
    assert path.endswith("/s_c1n1w1.jsonl")
    found = coverage.first()
    assert found.selected == found.found == spark.read.json(path).count() > 0 and found.missing == 0


def test_patched_shards_are_overwritten_alone(spark, tmp_path):
    folder = str(tmp_path / "results")
    row = "shard_id string, custom_id string, status string, conceptual int, novelty int, well_formed int, reasoning string, input_tokens long, output_tokens long"
    old = spark.createDataFrame([("0", "a", "ok", 1, 1, 1, "", 1, 1), ("1", "b", "errored", None, None, None, "", 0, 0)], row)
    sinks.write_results(old, folder)
    before = {p.name for p in (tmp_path / "results" / "_shard=0").iterdir()}
    new = spark.createDataFrame([("1", "b", "ok", 3, 3, 3, "", 1, 1)], row)
    sinks.write_results(session.written(results.patched_shards(old, new), "patched"), folder, "dynamic")
    assert {p.name for p in (tmp_path / "results" / "_shard=0").iterdir()} == before
    rows = readers.read_results(spark, folder).orderBy("custom_id").collect()
    assert [(r.custom_id, r.status, r.conceptual) for r in rows] == [("a", "ok", 1), ("b", "ok", 3)]


def test_rebuild_rules(spark):
    scores = spark.createDataFrame(
        [(0, "a", "ok", 2, 2, 2), (1, "a", "ok", 3, 2, 2), (2, "a", "ok", 1, 2, 2), (3, "b", "ok", 2, 2, 2),
         (4, "c", "refusal", 3, 3, 3), (5, "gone", "ok", 3, 3, 3)],
        "ord int, key string, status string, conceptual int, novelty int, well_formed int",
    )
    selected = rebuild.selected_keys(scores, ["ord"])
    assert {r.key: r.conceptual for r in selected.collect()} == {"a": 3, "b": 2, "gone": 3}
    rows = [(1, 5, "a", "later"), (0, 9, "a", "first"), (0, 10, "b", "b1"), (0, 11, "b", "b2"), (0, 1, "z", "z")]
    source = spark.createDataFrame(rows, "file_idx long, row_idx long, key string, conversation string")
    source = source.withColumn("source", F.lit("s"))
    out = rebuild.rebuild_prompts(selected, source).collect()
    assert {r.key: (r.conversation, r.conceptual) for r in out} == {"a": ("first", 3), "b": ("b1", 2)}
    assert [r.key for r in rebuild.missing_keys(selected, source).collect()] == ["gone"]
    assert rebuild.rebuild_coverage(selected, source).first().asDict() == {"selected": 3, "found": 2, "missing": 1}


def test_stored_by_key_scores_and_sources_join_in_place(spark, tmp_path):
    """Nothing small enough to broadcast, and still only the rows found are shuffled, by their position."""
    rows = [(i, f"k{i % 40}", "ok", i % 4, 3, 3) for i in range(200)]
    scores = spark.createDataFrame(rows, "ord int, key string, status string, conceptual int, novelty int, well_formed int")
    source = spark.createDataFrame([(0, i, f"k{i % 60}", f"text {i}", "s") for i in range(300)], "file_idx long, row_idx long, key string, conversation string, source string")
    wanted = rebuild.rebuild_prompts(rebuild.selected_keys(scores, ["ord"]), source)
    scores = sinks.write_keyed(scores, "keyed_scores", f"{tmp_path}/scores", 4)
    source = sinks.write_keyed(source, "keyed_source", f"{tmp_path}/source", 4)
    with session.settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        selected = rebuild.selected_keys(scores, ["ord"])
        out = rebuild.rebuild_prompts(selected, source)
        plan = out._jdf.queryExecution().executedPlan().toString()
        dealt = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
        assert len(dealt) == 2 and all("hashpartitioning(file_idx" in line for line in dealt)
        covered = rebuild.rebuild_coverage(selected, source)
        assert "hashpartitioning(key" not in covered._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, out.collect())) == sorted(map(tuple, wanted.collect()))


def test_browsing(spark):
    hits = spark.createDataFrame(
        [(i, c, n, w) for i, (c, n, w) in enumerate([(2, 1, 3), (3, 0, 0), (2, 3, 0), (3, 0, 1), (2, 1, 3)])],
        "ord int, conceptual int, novelty int, well_formed int",
    )
    def order(axis):
        return [r.ord for r in hits.orderBy(*select.browse_order(axis, ["ord"])).collect()]
    assert order("conceptual") == [3, 1, 2, 0, 4]
    assert order("novelty") == [2, 0, 4, 3, 1]
    assert order("well_formed") == [0, 4, 3, 1, 2]
    assert order("none") == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError):
        select.browse_order("status")
    assert [r.ord for r in select.browse_window(hits, 2, 2, ties=["ord"]).collect()] == [1, 2]


def test_block_sample_depends_on_the_seed_only(spark):
    df = spark.range(5000).withColumnRenamed("id", "ordinal")

    def sample(frame, seed):
        return sorted(r.ordinal for r in select.block_sample(frame, 7, seed).collect())

    one = sample(df, 1)
    assert len(one) == 140 and len({o // 100 for o in one}) == 7
    assert one == sample(df.repartition(9), 1) != sample(df, 2)


def test_scan_and_caps(spark):
    df = spark.range(300).withColumnRenamed("id", "ordinal")
    assert [r.ordinal for r in select.sequential_scan(df, 298, 10).orderBy("ordinal").collect()] == [298, 299]
    assert select.sequential_scan(spark.range(120_000).withColumnRenamed("id", "ordinal"), 0, 110_000).count() == 110_000
    for offset in (-1, 300):
        with pytest.raises(ValueError):
            select.sequential_scan(df, offset)
    verdicts = df.withColumn("conceptual", F.when(F.col("ordinal") % 2 == 0, 3))
    assert [r.ordinal for r in select.first_hits(verdicts, F.col("conceptual") >= 2, 2).collect()] == [0, 2]


def test_language_forms(spark):
    df = spark.createDataFrame([("English",), ("ENGLISH",), (None,), ("German",)], "language string")
    assert df.where(select.language_is("english")).count() == 2
    assert df.where(select.language_in("german, English")).count() == 3
    assert df.where(select.language_in("all")).count() == df.where(select.language_in("")).count() == 4
    assert df.where(rebuild.in_language("")).count() == 1


def test_cross_source_folder(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert session.new_folder(spark, "a") != session.new_folder(spark, "a")


def test_rendered_conversation_survives_the_round_trip(spark):
    df = prepare.with_prompt(prepare.prepare(chats(spark, ["a\n\nb", "plain"]), CONFIG), CONFIG)
    back = render.explode_rendered_turns(df.select("custom_id", "prompt")).orderBy("custom_id").collect()
    assert [r.content for r in back] == ["a\n\nb", "plain"]


def test_rebuild_by_the_name_of_a_source(spark, tmp_path):
    rows = [("a", [("user", "first")]), ("b", [("user", "second")]), ("a", [("user", "later copy")])]
    stored = [(k, [{"from": "human", "value": t} for _, t in turns]) for k, turns in rows]
    spark.createDataFrame(stored, schemas.SHARED_CHAT).coalesce(1).write.parquet(str(tmp_path / "chats"))
    kinds = "key string, conceptual int, novelty int, well_formed int, status string"
    scores = [("a", 2, 2, 2, "ok"), ("a", 3, 3, 3, "ok"), ("b", 1, 3, 3, "ok"), ("gone", 3, 3, 3, "ok")]
    spark.createDataFrame(scores, kinds).coalesce(1).write.parquet(str(tmp_path / "scores"))
    prompts, coverage = plan_rebuild.rebuild_source(spark, "sharegpt", str(tmp_path / "scores"), str(tmp_path / "chats"))
    (only,) = prompts.collect()
    assert (only.key, only.source, only.conceptual, only.conversation[0].content) == ("a", "sharegpt", 3, "first")
    assert tuple(coverage.first()) == (2, 1, 1)


def closed_scorer():
    raise RuntimeError("no client")


def test_retry_of_failed_rows(spark):
    requests = spark.createDataFrame(
        [("0", "a", 300, "p a"), ("0", "b", 300, "p b"), ("0", "c", None, None)], "shard_id string, custom_id string, max_tokens long, prompt string"
    )
    raw = scoring.score_prompts(requests, closed_scorer)
    assert [r.result_type for r in raw.collect()] == ["errored"] * 3
    manifest = requests.select("shard_id", "custom_id")
    first = session.written(results.collected(raw, manifest), "first")
    scorer = scoring.LexicalScorer({"conceptual": ("a",), "novelty": ("b",), "well_formed": ("p",)})
    again = session.written(retry.retry_failed(first, requests, scorer), "again")
    rows = {r.custom_id: (r.status, r.conceptual, r.novelty, r.well_formed) for r in again.collect()}
    assert rows == {"a": ("ok", 1, 0, 1), "b": ("ok", 0, 1, 1), "c": ("ok", 0, 0, 0)}
    assert retry.retry_failed(again, requests, closed_scorer).exceptAll(again).isEmpty()
