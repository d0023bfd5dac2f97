import shutil

from pyspark.sql import functions as F

from turnsieve.operators import dedup, results
from turnsieve.sources import readers, sinks
from turnsieve.streaming import collect, prepare

SCHEMA = "file_idx long, row_idx long, first_user string"


def arrive(spark, folder, number, texts):
    rows = [(number, i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


FILES = [["a", "b", "A "], ["c", "a", ""], [" ", "d", "b"], ["e", "c", "f"]]


def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def everything(spark):
    rows = [(n, i, t) for n, texts in enumerate(FILES) for i, t in enumerate(texts)]
    return {(r.file_idx, r.row_idx) for r in dedup.keep_first_text(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_exact_stream_stops_and_goes_on(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        prepare.stream_prepare_exact(spark, str(folder), schema(spark), lambda d: d, out, state).awaitTermination()

    for n in (0, 1):
        arrive(spark, folder, n, FILES[n])
    run()
    assert spark.read.parquet(out).count() == 4
    for n in (2, 3):
        arrive(spark, folder, n, FILES[n])
    run()
    run()  # nothing new
    kept = [(r.file_idx, r.row_idx) for r in spark.read.parquet(out).collect()]
    assert sorted(kept) == sorted(everything(spark))


def test_replayed_batch_changes_nothing(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), tmp_path / "state"
    for n, texts in enumerate(FILES):
        arrive(spark, folder, n, texts)

    def run():
        prepare.stream_prepare_exact(spark, str(folder), schema(spark), lambda d: d, out, str(state)).awaitTermination()

    run()
    before = sorted(map(str, spark.read.parquet(out).collect()))
    last = max((state / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    shutil.copy(last, tmp_path / "kept-commit")
    last.unlink()  # as if the driver had died before the commit
    (state / "commits" / f".{last.name}.crc").unlink(missing_ok=True)
    run()
    assert sorted(map(str, spark.read.parquet(out).collect())) == before


def test_stateful_stream_keeps_one_row_per_key(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    for n, texts in enumerate(FILES):
        arrive(spark, folder, n, texts)
    prepare.stream_prepare(spark, str(folder), schema(spark), lambda d: d, out, state).awaitTermination()
    kept = spark.read.parquet(out)
    assert kept.count() == kept.select("digest").distinct().count() == len(everything(spark))


GOOD = '{"conceptual": 1, "novelty": 1, "well_formed": 1}'


def answers(spark, folder, rows):
    df = spark.createDataFrame([(s, c, "b", "succeeded", "end_turn", t, 1, 1) for s, c, t in rows], collect.ANSWER)
    df.coalesce(1).write.mode("append").json(str(folder))


def test_a_batch_reads_its_own_files_only(spark, tmp_path, monkeypatch):
    """What a batch reads does not grow with history: its keys are looked up in the state, its rows in its files."""
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    read = []
    rows_of = prepare.rows_of

    def watched(session, at, kinds, to_records, files):
        df = rows_of(session, at, kinds, to_records, files)
        read.append(df.rdd.getNumPartitions())  # a task for each file here
        return df

    monkeypatch.setattr(prepare, "rows_of", watched)
    sizes = []
    for n in range(4):
        arrive(spark, folder, n, [f"{n} {i}" for i in range(50)])
        query = prepare.stream_prepare_exact(spark, str(folder), schema(spark), lambda d: d, out, state)
        query.awaitTermination()
        sizes.append(query.lastProgress["numInputRows"])
    assert sizes == [50] * 4 and read == [1] * 4
    assert spark.read.parquet(out).count() == 200


def test_keys_out_of_order_are_kept_once(spark, tmp_path):
    """A key that comes again from an earlier file, and one whose rows are spread over the files of a batch."""
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        prepare.stream_prepare_exact(
            spark, str(folder), schema(spark), lambda d: d, out, state, files_per_batch=None
        ).awaitTermination()

    arrive(spark, folder, 5, ["x", "y"])
    run()
    arrive(spark, folder, 1, ["x", "z", "w"])
    arrive(spark, folder, 0, ["w", "v", "Z "])
    run()
    kept = {(r.file_idx, r.row_idx) for r in spark.read.parquet(out).collect()}
    assert kept == {(5, 0), (5, 1), (0, 0), (0, 1), (0, 2)}


def test_a_batch_without_new_keys(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    for texts in (["a", "b"], ["B ", "a"], ["c"]):
        arrive(spark, folder, len(list(folder.glob("*.parquet"))) if folder.exists() else 0, texts)
        prepare.stream_prepare_exact(spark, str(folder), schema(spark), lambda d: d, out, state).awaitTermination()
    assert sorted((r.file_idx, r.row_idx) for r in spark.read.parquet(out).collect()) == [(0, 0), (0, 1), (2, 0)]


def test_the_session_keeps_its_settings(spark, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    folder = tmp_path / "in"
    arrive(spark, folder, 0, ["a"])
    prepare.stream_prepare(
        spark, str(folder), schema(spark), lambda d: d, str(tmp_path / "out"), str(tmp_path / "state")
    ).awaitTermination()
    assert spark.conf.get(key) == before


def manifests(spark, rows):
    kinds = "shard_id string, custom_id string, conversation_hash string"
    return spark.createDataFrame(rows, kinds)


def test_collect_by_passes(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    manifest = manifests(spark, [("0", "a", "h"), ("0", "b", "i")])
    answers(spark, folder, [("0", "a", GOOD), ("0", "x", "{")])
    seen = []

    def start():
        return collect.stream_collect(spark, str(folder), manifest, out, state)

    def complete():
        seen.append(spark.read.parquet(out).count())
        if len(seen) == 1:
            answers(spark, folder, [("0", "b", GOOD), ("1", "a", GOOD.replace("1", "9"))])
        return len(seen) == 2

    assert collect.watch(start, complete, pause_seconds=0) == 2
    assert seen == [2, 4]
    rows = {(r.custom_id, r.status.split(":")[0], r.conversation_hash) for r in spark.read.parquet(out).collect()}
    assert rows == {("a", "ok", "h"), ("x", "parse_error", None), ("b", "ok", "i"), ("a", "out_of_range", None)}
    per_batch = sorted(map(tuple, collect.progress(spark, out).collect()))
    assert per_batch == [(0, 2, 1, 0, 1), (1, 2, 1, 0, 1)]
    assert tuple(collect.totals(spark, out).first()) == (2, 4, 2, 0, 2)


def test_a_replayed_batch_is_collected_once(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), tmp_path / "state"
    manifest = manifests(spark, [("0", "a", "h"), ("1", "a", "i")])

    def run():
        collect.stream_collect(spark, str(folder), manifest, out, str(state)).awaitTermination()

    def stored():
        return sorted(map(str, spark.read.parquet(out).collect())), collect.totals(spark, out).first()

    for shard in "01":
        answers(spark, folder, [(shard, "a", GOOD), (shard, "b", "[")])
        run()
    before = stored()
    for name in ("1", ".1.crc"):  # the last batch was not committed
        (state / "commits" / name).unlink(missing_ok=True)
    run()
    assert stored() == before and before[1].n_rows == 4
    answers(spark, folder, [("1", "c", GOOD)])
    run()  # goes on after the replay
    assert tuple(collect.totals(spark, out).first()) == (3, 5, 3, 0, 2)


def test_only_the_shards_of_a_batch_are_looked_up(spark, tmp_path):
    rows = [(str(s), str(i), "h") for s in range(20) for i in range(3)]
    sinks.write_manifest(manifests(spark, rows), str(tmp_path / "manifest"))
    manifest = readers.read_manifest(spark, str(tmp_path / "manifest"))
    some = collect.manifest_of(manifest, ["3", "17", None])
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [shard_id" in plan.replace("isnotnull(shard_id", "shard_id")
    assert {r.shard_id for r in some.collect()} == {"3", "17"}


def test_collect_equals_batch(spark, tmp_path):
    folder = tmp_path / "in"
    answers(spark, folder, [("0", str(i), GOOD if i % 3 else "[") for i in range(30)])
    manifest = spark.range(20).select(F.lit("0").alias("shard_id"), F.col("id").cast("string").alias("custom_id"), F.lit("h").alias("conversation_hash"))
    out = str(tmp_path / "out")
    collect.stream_collect(spark, str(folder), manifest, out, str(tmp_path / "s"), files_per_batch=1).awaitTermination()
    batch = results.attach_manifest(
        results.check_range(results.parse_responses(spark.read.schema(collect.ANSWER).json(str(folder)))), manifest
    )
    back = spark.read.schema(batch.schema).parquet(out).select(*batch.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, batch.collect()))


def test_preparation_is_continued_and_replayed(spark, tmp_path):
    from turnsieve.functions.turns import turn
    from turnsieve.operators.conversations import records
    from turnsieve.plans import config, prepare as plan

    run = config.RunConfig("d", "m", "RUBRIC\n", "\nEND", shard_max_requests=2)
    kinds = "file_idx long, row_idx long, t string"

    def to_records(df):
        return records(
            df, source=F.lit("s"), id=F.concat(F.lit("k"), F.col("row_idx")), language=F.lit("English"),
            conversation=F.array(turn(F.lit("user"), F.col("t"))),
        )

    files = [["one", "two", "one ", "three"], ["TWO", "four", "five"], ["six", "six", "one", "seven"]]
    folder, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    rows = []
    for number, texts in enumerate(files):
        part = [(number, i, t) for i, t in enumerate(texts)]
        rows += part
        spark.createDataFrame(part, kinds).coalesce(1).write.mode("append").parquet(folder)
        for _ in range(2):  # the second time there is nothing new
            prepare.stream_prepare_shards(spark, folder, spark.createDataFrame([], kinds).schema, to_records, run, out, state).awaitTermination()
    columns = ["file_idx", "row_idx", "ordinal", "custom_id", "shard_id", "n_bytes", "body"]

    def got():
        return sorted(map(tuple, spark.read.parquet(f"{out}/requests").select(*columns).collect()))

    want = sorted(map(tuple, plan.prepare(to_records(spark.createDataFrame(rows, kinds)), run).select(*columns).collect()))
    assert got() == want and len(want) == 7
    for name in ("2", ".2.crc"):  # the last batch was not committed: it is run again
        (tmp_path / "state" / "commits" / name).unlink(missing_ok=True)
    prepare.stream_prepare_shards(spark, folder, spark.createDataFrame([], kinds).schema, to_records, run, out, state).awaitTermination()
    assert got() == want
