"""Each stage of the pipeline against a plain version, on the smallest tables and on awkward rows."""

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from turnsieve.llm import toxicity
from turnsieve.llm.common import table
from turnsieve.session import BATCH_BYTES

from ..conftest import SMALL
from .fixtures import SCHEMA, documents, nothing, on_disk, prose
from .test_decontaminate import plain as plain_hits
from .test_linededup import plain as plain_lines
from .test_queries import check_pieces
from .test_simhash import classes
from .test_simhash import plain as plain_print

STAGES = dict(corpus_pipeline.STAGES)


def test_stages(spark):
    assert list(STAGES) == ["toxicity", "line_dedup", "simhash", "decontaminate", "packing"]
    docs = table(spark, SMALL, "documents").cache()
    start = {r.doc_id: r for r in docs.collect()}
    benchmark = [tuple(r) for r in table(spark, SMALL, "benchmark").select("item_id", "text").collect()]

    kept = corpus_pipeline.written(STAGES["toxicity"](spark, docs, SMALL), "test")
    assert kept.columns == docs.columns
    labels = table(spark, SMALL, "labels")
    model = toxicity.fit(docs, labels.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
    score = model.scorer()
    now = {i: r.text for i, r in start.items() if score(r.text) < 0.5}
    assert {r.doc_id: r.text for r in kept.collect()} == now  # too few labels here to learn much: see below

    kept = corpus_pipeline.written(STAGES["line_dedup"](spark, kept, SMALL), "test")
    assert kept.columns == docs.columns
    ids = sorted(now)
    after = dict(zip(ids, plain_lines([now[i] for i in ids], 50), strict=True))
    now = {i: t for i, t in after.items() if t or not now[i]}
    rows = kept.collect()
    assert {r.doc_id: r.text for r in rows} == now
    assert all(r.n_chars == (len(r.text) if r.text != start[r.doc_id].text else start[r.doc_id].n_chars) for r in rows)

    kept = corpus_pipeline.written(STAGES["simhash"](spark, kept, SMALL), "test")
    prints = {i: plain_print(t) for i, t in now.items()}
    of = classes(sorted(now), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    now = {i: t for i, t in now.items() if of[i] == i}
    assert {r.doc_id: r.text for r in kept.collect()} == now

    kept = corpus_pipeline.written(STAGES["decontaminate"](spark, kept, SMALL), "test")
    hit = {i for i, _, n, _ in plain_hits(list(now.items()), benchmark) if n}
    now = {i: t for i, t in now.items() if i not in hit}
    assert {r.doc_id: r.text for r in kept.collect()} == now

    check_pieces(STAGES["packing"](spark, kept, SMALL).collect(), now)


def test_toxic_documents_go_and_clean_ones_stay(spark):
    folder = SMALL.replace("sf0.001", "sf0.1")
    kept = {r.doc_id for r in STAGES["toxicity"](spark, table(spark, folder, "documents"), folder).select("doc_id").collect()}
    labels = duckdb.sql(f"SELECT doc_id, toxic FROM '{folder}/labels.parquet'").fetchall()
    toxic, clean = {i for i, y in labels if y}, {i for i, y in labels if not y}
    assert len(toxic & kept) < 0.1 * len(toxic) and len(clean - kept) < 0.01 * len(clean)


def test_items_without_an_id_count(spark, tmp_path):
    items = spark.createDataFrame([(None, prose(12, 1)), (None, prose(12, 2)), (3, prose(12, 3))], "item_id bigint, text string")
    on_disk(items, tmp_path / "benchmark.parquet")
    rows = [(i, prose(5, 10 + i) + " " + prose(12, i), "en", "s", 1) for i in range(1, 5)]
    docs = on_disk(spark.createDataFrame(rows, SCHEMA), tmp_path / "docs")
    assert [r.doc_id for r in STAGES["decontaminate"](spark, docs, str(tmp_path)).collect()] == [4]


@pytest.mark.parametrize("make", ["awkward", "empty"])
def test_awkward_rows(spark, tmp_path, make):
    docs = on_disk(documents(spark, clashing=True) if make == "awkward" else nothing(spark), tmp_path / "docs")
    for name, stage in corpus_pipeline.STAGES:
        new = stage(spark, docs, SMALL)
        if name != "packing":
            assert new.columns == docs.columns
        docs = on_disk(new, tmp_path / name)
    assert (docs.count() > 0) == (make == "awkward")


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES if name != "line_dedup"])
def test_batches_are_small(spark, tmp_path, name):
    """Workers get a few megabytes at once, unless the caller has set a bound of their own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["rows", "bytes"])

    docs = on_disk(documents(spark), tmp_path / "docs")
    many = spark.range(0, 6000, 1, 1).select("id", F.repeat(F.lit("text of a document "), 100).alias("text"))  # 11 MB
    before = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        STAGES[name](spark, docs, SMALL)
        found = many.mapInArrow(sizes, "rows bigint, bytes bigint").collect()
        assert max(r.bytes for r in found) < 1.1 * BATCH_BYTES and sum(r.rows for r in found) == 6000
        spark.conf.set(key, str(8 << 20))
        STAGES[name](spark, docs, SMALL)
        assert spark.conf.get(key) == str(8 << 20)
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)


def test_run_is_the_stages_in_turn(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    ids = {r.doc_id for r in rows}
    total = duckdb.sql(f"SELECT count(*) FROM '{SMALL}/documents.parquet'").fetchall()[0][0]
    assert 0 < len(ids) < total
