"""Results on disk that are patched by versions, and the claim of a run's folder."""

import threading

import pytest
from pyspark.sql import functions as F

from turnsieve import schemas
from turnsieve.operators import results
from turnsieve.operators.scoring import LexicalScorer
from turnsieve.plans import config, retry
from turnsieve.sources import versions

RUN = config.RunConfig("d", "m", "RUBRIC\n", "\nEND")


def frame(spark, rows):
    """``(shard, id, status, score)`` as results."""
    df = spark.createDataFrame(rows, "shard_id string, custom_id string, status string, conceptual int")
    missing = [f for f in schemas.RESULT.fields if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})


ROWS = [("0", "a", "ok", 1), ("0", "b", "errored", None), ("1", "a", "errored", None), ("2", "a", "ok", 2)]


def stored(spark, folder, version=None):
    return sorted((r.shard_id, r.custom_id, r.status, r.conceptual) for r in versions.read_version(spark, folder, version).collect())


def files(folder):
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("*.json")}


def test_a_patch_replaces_only_its_shards(spark, tmp_path):
    folder = str(tmp_path)
    assert versions.commit(frame(spark, ROWS), folder) == 0
    before = files(tmp_path)
    retried = frame(spark, [("0", "b", "ok", 3), ("1", "a", "errored", None), ("2", "a", "ok", 0), ("7", "x", "ok", 1)])
    assert retry.patch_on_disk(spark, folder, retried) == 1
    after = files(tmp_path)
    assert {k: after[k] for k in before} == before
    assert {k.split("_shard=")[1].split("/")[0] for k in after.keys() - before.keys() if "_shard=" in k} == {"0"}
    assert stored(spark, folder) == [("0", "a", "ok", 1), ("0", "b", "ok", 3), ("1", "a", "errored", None), ("2", "a", "ok", 2)]
    assert stored(spark, folder, 0) == sorted(ROWS, key=lambda r: r[:2])
    assert retry.patch_on_disk(spark, folder, retried) is None  # nothing left to mend
    assert retry.patch_on_disk(spark, folder, frame(spark, [("1", "a", "ok", 0)])) == 2
    assert stored(spark, folder)[2] == ("1", "a", "ok", 0) and len(stored(spark, folder)) == 4


def test_a_version_without_its_line_is_not_read(spark, tmp_path):
    """As if a writer had died before its commit, or were at work."""
    folder = str(tmp_path)
    versions.commit(frame(spark, ROWS), folder)
    before = stored(spark, folder)
    from turnsieve.sources.sinks import write_results

    write_results(frame(spark, [("0", "b", "ok", 3)]), f"{folder}/data/version=1")
    assert versions.versions(spark, folder) == [0] and stored(spark, folder) == before


def test_one_of_two_patches_wins(spark, tmp_path):
    folder = str(tmp_path)
    versions.commit(frame(spark, ROWS), folder)
    assert versions.commit(frame(spark, [("0", "b", "ok", 3)]), folder, onto=0) == 1
    with pytest.raises(versions.Conflict):
        versions.commit(frame(spark, [("0", "b", "ok", 2)]), folder, onto=0)
    assert ("0", "b", "ok", 3) in stored(spark, folder)


def test_only_the_patched_shards_are_opened(spark, tmp_path):
    versions.commit(frame(spark, ROWS), str(tmp_path))
    retry.patch_on_disk(spark, str(tmp_path), frame(spark, [("0", "b", "ok", 3)]))
    plan = versions.read_version(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "NOT (_shard" in plan


def test_retry_to_the_end(spark, tmp_path):
    folder = str(tmp_path)
    versions.commit(frame(spark, ROWS), folder)
    requests = spark.createDataFrame([("0", "b", 300, "p b"), ("1", "a", 300, "p a")], "shard_id string, custom_id string, max_tokens long, prompt string")
    scorer = LexicalScorer({"conceptual": ("p",), "novelty": ("b",), "well_formed": ()})
    assert retry.retry_on_disk(spark, folder, requests, scorer) == 1
    rows = {(r.shard_id, r.custom_id): (r.status, r.conceptual, r.novelty) for r in versions.read_version(spark, folder).collect()}
    assert rows["0", "b"] == ("ok", 1, 1) and rows["1", "a"] == ("ok", 1, 0) and len(rows) == 4
    assert retry.retry_on_disk(spark, folder, requests, scorer) is None
    patched = results.patched_shards(versions.read_version(spark, folder, 0), frame(spark, [("1", "a", "ok", 2)]))
    assert {r.shard_id for r in patched.collect()} == {"1"}


def test_no_version(spark, tmp_path):
    with pytest.raises(ValueError):
        versions.read_version(spark, str(tmp_path))


def test_one_of_many_claims_wins(spark, tmp_path):
    """Callers at the same moment: one creates the file, and all find its whole text."""
    won, start = [], threading.Barrier(8)

    def claim(i):
        start.wait()
        if config.create_once(spark, f"{tmp_path}/run/claim", f"caller {i}"):
            won.append(i)

    callers = [threading.Thread(target=claim, args=(i,)) for i in range(8)]
    for c in callers:
        c.start()
    for c in callers:
        c.join()
    assert len(won) == 1 and (tmp_path / "run" / "claim").read_text() == f"caller {won[0]}"
    assert [p.name for p in (tmp_path / "run").iterdir() if not p.name.endswith(".crc")] == ["claim"]


def test_a_run_begun_by_another(spark, tmp_path):
    folder = str(tmp_path / "run")
    config.guard(spark, folder, RUN)
    other = config.RunConfig("d", "another", "RUBRIC\n", "\nEND")
    with pytest.raises(config.ConfigDrift, match="another"):
        config.guard(spark, folder, other)
    config.guard(spark, folder, other, force=True)
    assert config.drift(config.stored_settings(spark, folder, RUN), RUN) == {}
    lines = [("0", RUN.fingerprint), ("0", RUN.fingerprint), ("0", None), ("1", other.fingerprint)]
    found = config.drifted_shards(spark.createDataFrame(lines, "shard_id string, fingerprint string"), RUN).collect()
    assert {(r.shard_id, r.n_requests, r.drifted) for r in found} == {("0", 2, False), ("0", 1, True), ("1", 1, True)}
