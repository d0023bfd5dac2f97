import random

import pytest

from turnsieve.llm import linededup

from .fixtures import SPACED, documents, nothing, on_disk


def plain(texts, min_words):
    """Lines of each text that lie in a run of enough words with an earlier copy; every pair of places is compared."""
    docs = [t.split("\n") for t in texts]
    places = [(d, p) for d, ls in enumerate(docs) for p in range(len(ls))]
    gone = set()
    for i, (d, p) in enumerate(places):
        for e, q in places[:i]:
            n = 0
            while p + n < len(docs[d]) and q + n < len(docs[e]) and docs[d][p + n] == docs[e][q + n]:
                n += 1
            if sum(len(SPACED.findall(x)) for x in docs[d][p : p + n]) >= min_words:
                gone |= {(d, p + k) for k in range(n)}
    return ["\n".join(x for p, x in enumerate(ls) if (d, p) not in gone) for d, ls in enumerate(docs)]


@pytest.mark.parametrize("seed", range(4))
def test_against_all_pairs(spark, tmp_path, seed):
    rng = random.Random(seed)
    lines = ["", "a", "b c", "d e f", "g g g g", "h i j k l m", " ".join("n" * 12)]
    texts = ["\n".join(rng.choice(lines[: 3 + seed]) for _ in range(rng.randint(1, 14))) for _ in range(14)]
    texts += [texts[2], texts[3] + "\n" + texts[4]]
    df = on_disk(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3), tmp_path / "docs")
    for min_words in (1, 6, 12):
        found = {r.doc_id: r.text for r in linededup.deduplicate_lines(df, min_words=min_words).collect()}
        assert [found[i] for i in range(len(texts))] == plain(texts, min_words)


def test_awkward_rows(spark, tmp_path):
    df = on_disk(documents(spark, clashing=True), tmp_path / "docs")
    found = linededup.deduplicate_lines(df)
    assert found.columns == [*df.columns, "_lines", "_gone", "_words_gone"]
    rows = found.collect()
    assert len(rows) == df.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].text is None and by_id[0]["_lines"] == 0
    assert by_id[1].text == "" and by_id[3].text == "\n\n"
    assert by_id[7].text == "" and by_id[7]["_gone"] == 6  # a copy of document 6
    assert by_id[8]["_gone"] == 6 and by_id[9]["_gone"] == 6 and "\n" not in by_id[9].text
    assert sorted(r["_gone"] for r in rows if r.doc_id == 6) == [0, 6]  # a repeated row
    assert by_id[13]["_gone"] == 0


def test_plan_has_no_python(spark, tmp_path):
    plan = linededup.deduplicate_lines(on_disk(documents(spark), tmp_path / "docs"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoop"))


def test_no_python_rows(spark, tmp_path):
    """A frame made of rows on the driver is read through Python workers, even one without rows."""
    for name, df in (("docs", documents(spark)), ("none", nothing(spark))):
        df = on_disk(df, tmp_path / name)
        for found in (linededup.deduplicate_lines(df), linededup.repeated_runs(df)):
            assert "RDD" not in found._jdf.queryExecution().toString()
        assert dict(found.dtypes) == {"id": "bigint", "line": "int", "n": "bigint", "first_id": "bigint", "first_line": "int"}


def test_empty(spark):
    assert linededup.deduplicate_lines(nothing(spark)).collect() == []


def test_stretches_of_blank_lines(spark, tmp_path):
    """Two copies with 20,000 blank lines before the repeated words: work grows with the lines, not with their square."""
    text = "\n" * 20_000 + " ".join("w" * 50)
    df = on_disk(spark.createDataFrame([(1, text), (2, text)], "doc_id bigint, text string"), tmp_path / "docs")
    rows = {r.doc_id: r for r in linededup.deduplicate_lines(df).collect()}
    assert (rows[1]["_gone"], rows[2]["_gone"], rows[2].text) == (0, 20_001, "")


def test_stretches_are_disjoint(spark):
    rng = random.Random(7)
    runs = [(d, rng.randint(0, 60), rng.randint(1, 6)) for d in (1, 2) for _ in range(25)]
    got = linededup._stretches(spark.createDataFrame(runs, "doc bigint, pos int, n bigint"), ["doc"]).collect()
    lines = [(r.doc, r.pos + i) for r in got for i in range(r.n)]
    assert len(lines) == len(set(lines)) and set(lines) == {(d, p + i) for d, p, n in runs for i in range(n)}
    starts = {(r.doc, r.pos + r.n) for r in got}
    assert not starts & {(r.doc, r.pos) for r in got}  # stretches that touch are one


def common(a, i, b, j):
    n = 0
    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
        n += 1
    return n


def test_maximal_runs_against_common_prefixes(spark, tmp_path):
    """Each reported run is the longest common prefix of its two places, cannot begin earlier, and all together are what goes."""
    rng = random.Random(11)
    lines = ["", "a", "b c", "d e f", "g g g g", "h i j k l m"]
    docs = [[rng.choice(lines) for _ in range(rng.randint(1, 18))] for _ in range(16)]
    docs += [docs[2][1:], docs[3] + docs[4]]
    texts = ["\n".join(d) for d in docs]
    df = on_disk(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3), tmp_path / "docs")
    for min_words in (4, 9):
        runs = linededup.repeated_runs(df, min_words=min_words).collect()
        gone = set()
        for r in runs:
            assert (r.first_id, r.first_line) < (r.id, r.line)
            a, b = docs[r.id], docs[r.first_id]
            assert a[r.line : r.line + r.n] == b[r.first_line : r.first_line + r.n]
            assert sum(len(SPACED.findall(x)) for x in a[r.line : r.line + r.n]) >= min_words
            gone |= {(r.id, r.line + k) for k in range(r.n)}
        assert runs and len(runs) == len({(r.id, r.line, r.first_id, r.first_line) for r in runs})
        kept = ["\n".join(x for p, x in enumerate(d) if (i, p) not in gone) for i, d in enumerate(docs)]
        assert kept == plain(texts, min_words)
        # where a document's only earlier copy is one place, the run is as long as the common prefix there
        for r in runs:
            others = [(d, p) for d in range(len(docs)) for p in range(len(docs[d])) if (d, p) < (r.id, r.line) and docs[d][p] == docs[r.id][r.line]]
            if others == [(r.first_id, r.first_line)]:
                assert r.n == common(docs[r.id], r.line, docs[r.first_id], r.first_line) or r.id == r.first_id
