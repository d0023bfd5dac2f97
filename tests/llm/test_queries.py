"""The registered queries on the smallest tables: against SQL where there is some, else against plain versions."""

import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
from turnsieve.checks.compare import TABLES, compare
from turnsieve.llm import licenses

from ..conftest import SMALL
from .fixtures import words
from .test_embeddings import plain as plain_links
from .test_simhash import classes
from .test_simhash import plain as plain_print

QUERIES, ORACLES = entry_points.LLM_QUERIES, entry_points.LLM_ORACLES


def named(n):
    return next(k for k in QUERIES if k.startswith(f"op{n}_"))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    yield con
    con.close()


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.sql("SELECT doc_id, text FROM documents").fetchall())


def rows(spark, n):
    return QUERIES[named(n)](spark, SMALL).collect()


def test_names():
    assert [k for k in QUERIES if k != "pipeline"] and {k.split("_")[0] for k in QUERIES} == {"pipeline", *(f"op{n}" for n in range(1, 14))}
    assert set(ORACLES) == {named(n) for n in (5, 6, 7, 10, 11, 12, 13)}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    relation = duck.sql(ORACLES[name])
    assert compare(df.columns, [tuple(r) for r in df.collect()], relation.columns, relation.fetchall()) is None


def test_op1(spark, texts):
    found = {r.doc_id: r for r in rows(spark, 1)}
    prints = {i: plain_print(t) for i, t in texts.items()}
    assert {i: r.fingerprint for i, r in found.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    of = classes(sorted(prints), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    assert {i: r.component_id for i, r in found.items()} == of


@pytest.mark.parametrize(("n", "label", "fold", "rest", "limit"), [(2, "toxic", 5, 0, 0.5), (9, "quality", 4, 2, 0.7)])
def test_classifiers(spark, n, label, fold, rest, limit):
    """Held-out accuracy, on tables with some thousand labels: the smallest ones have nine toxic documents."""
    large = SMALL.replace("sf0.001", "sf0.1")
    found = QUERIES[named(n)](spark, large).collect()
    assert sorted(r.doc_id for r in found) == [r[0] for r in duckdb.sql(f"SELECT doc_id FROM '{large}/documents.parquet' ORDER BY 1").fetchall()]
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % fold == rest)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= limit)
    known = dict(duckdb.sql(f"SELECT doc_id, {label} FROM '{large}/labels.parquet'").fetchall())
    held = [r for r in found if r.held_out and r.doc_id in known]
    assert len(held) > 500 and np.mean([r.predicted == known[r.doc_id] for r in held]) > 0.98
    assert min(np.mean([r.predicted == y for r in held if known[r.doc_id] == y]) for y in (0, 1)) > 0.9


def test_op3(spark, texts):
    for r in rows(spark, 3):
        ws = words(texts[r.doc_id])
        at = [(i, x) for p, x in licenses.BASE.items() for i in range(len(ws)) if ws[i : i + len(p.split())] == p.split()]
        starts = [i for i, _ in at]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (
            len(ws), len(at), min(starts, default=None), max(starts, default=None),
        )
        assert r.base_labels == ",".join(sorted({x for _, x in at}))
        assert {x for _, x in at} <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_op4(spark, texts):
    found = rows(spark, 4)
    assert {r.doc_id: (r.size, r.text_crc32) for r in found} == {
        i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts.items()
    }
    assert {(r.law, r.grown_shard) for r in found} == {("bytes", None)}
    shards, groups = defaultdict(list), defaultdict(set)
    for r in found:
        shards[r.shard].append(r.slot)
        groups[texts[r.doc_id]].add(r.shard)
    assert set(shards) <= set(range(16)) and all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert all(len(g) == 1 for g in groups.values())
    loads = [sum(r.size for r in found if r.shard == s) for s in range(16)]
    assert max(loads) - min(loads) <= 0.02 * np.mean(loads)  # no text here is larger than a fraction of a shard


def test_op5(spark, duck):
    want = plain_links(duck.sql("SELECT vec_id, embedding, label FROM embeddings").fetchall())
    for r in rows(spark, 5):
        assert (r.n_links, r.component_id, r.kept) == (*want[r.vec_id], r.vec_id == want[r.vec_id][1])


def check_pieces(found, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs, used = defaultdict(list), Counter()
    for r in found:
        docs[r.doc_id].append(r)
        used[r.sequence_id] += r.length
    assert set(docs) == set(texts) and max(used.values()) <= 1024
    for i, pieces in docs.items():
        ids, at = np.array([*tokenizer.encode(texts[i] or "", add_special_tokens=False).ids, 0], dtype="<u4"), 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)


def test_op8(spark, texts):
    check_pieces(rows(spark, 8), texts)
