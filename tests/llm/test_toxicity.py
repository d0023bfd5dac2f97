import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnsieve.llm import toxicity

from .fixtures import documents, nothing, prose

RUDE = ["moron", "stupid", "worthless"]


def corpus(spark, n=240):
    rows, labels = [], []
    for i in range(n):
        text = prose(40, i)
        if i % 3 == 0:
            ws = text.split(" ")
            ws[i % 40] = RUDE[i % 9 // 3]
            text = " ".join(ws)
        rows.append((i, text))
        labels.append((i, int(i % 3 == 0)))
    return (
        spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3),
        spark.createDataFrame(labels, "doc_id bigint, toxic int"),
    )


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.fit(*corpus(spark))


@pytest.mark.parametrize(
    ("hidden", "word"),
    [
        ("m0r0n", "moron"),
        ("m o r o n", "moron"),
        ("m.o.r.o.n", "moron"),
        ("mooooron", "moron"),
        ("5tup1d", "stupid"),
        ("$tup!d", "stupid"),
        ("st*pid", "stupid"),
        ("w0rthle55", "worthless"),
        ("wwworth-less", "worthless"),
        ("$ t u p i d", "stupid"),
        ("s  t  u p i d", "stupid"),
        ("s t u p 1 d", "stupid"),
        ("worthles5", "worthless"),
        ("worthle$$", "worthless"),
    ],
)
def test_restored(model, hidden, word):
    restorer = toxicity.Restorer(model.language)
    assert word in toxicity.words_of(f"xy {hidden} zu", restorer)


def test_plain_words_are_left_alone(model):
    restorer = toxicity.Restorer(model.language)
    text = "Some plain words, with commas. A line\nand 12 numbers (456) 555-2186!! erheat$$$ ou&&&"
    assert toxicity.words_of(text, restorer) == set(toxicity._WORD.findall(text.lower()))
    assert toxicity.disguised("", restorer.kinds) == set() == toxicity.disguised("a b", restorer.kinds)


def test_counts_grow_with_the_corpus(spark):
    docs, _ = corpus(spark)
    once = toxicity.character_counts(docs)
    assert np.array_equal(toxicity.character_counts(docs.union(docs)), 2 * once)
    assert toxicity.character_counts(nothing(spark)).sum() == 0


def test_scores(spark, model):
    new = [(i, prose(30, 1000 + i)) for i in range(40)]
    new += [(100 + i, prose(30, 2000 + i) + " " + RUDE[i % 3] + " " + prose(9, i)) for i in range(40)]
    new += [(200 + i, prose(30, 3000 + i) + " " + ["m0r0n", "s t u p i d", "w0rthless"][i % 3]) for i in range(40)]
    scores = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(new, "doc_id bigint, text string"), model).collect()}
    assert all((s >= 0.5) == (i >= 100) for i, s in scores.items())


def test_awkward_rows(spark, model):
    df = documents(spark, clashing=True)
    rows = toxicity.score(df, model).collect()
    assert len(rows) == df.count() and all(0 <= r.score <= 1 for r in rows)
    assert sum(c == "score" for c in rows[0].asDict()) == 1
    assert toxicity.score(nothing(spark), model).collect() == []
    empty = toxicity.fit(nothing(spark), spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert all(r.score < 0.5 for r in toxicity.score(df, empty).collect())


def test_labels_are_bounded_and_cleaned(spark):
    docs, labels = corpus(spark)
    labels = labels.union(spark.createDataFrame([(None, 1), (3, None), (4, 0), (4, 0)], "doc_id bigint, toxic int"))
    assert toxicity.labelled(docs, labels, "toxic", 50, "doc_id", "text").count() == 50
    assert toxicity.labelled(docs, labels, "toxic", 500, "doc_id", "text").count() == 240


def test_all_labelled_rows_are_learnt_from(spark):
    """Each rare word is in five toxic texts of 40,000 labelled ones: the least a feature needs."""
    rare = [f"{c}rare" for c in "abcdefghijklmnopqrst"]
    word = F.element_at(F.array(*map(F.lit, rare)), (F.floor(F.col("id") / 400) % 20 + 1).cast("int"))
    text = F.when(F.col("id") % 400 == 1, F.concat(F.lit("plain text "), word)).otherwise("plain text")
    rows = spark.range(0, 40_000, 1, 3).select(F.col("id").alias("doc_id"), text.alias("text"), (F.col("id") % 2).cast("int").alias("toxic"))
    model = toxicity.fit(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))
    assert set(rare) <= set(model.weights)


def test_labelled_words(spark, model):
    """Words of every labelled row: repeated ids, labels of another type, null ids, texts and labels."""
    texts = [(i % 900, f"text number {'ab' * (i % 7)} {'cd' * (i % 11)}" if i % 13 else None) for i in range(1000)] + [(None, "without id")]
    marks = [(i, i % 3) for i in range(0, 1200, 2)] + [(4, 5), (6, None), (None, 1)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    labels = spark.createDataFrame(marks, "doc_id int, toxic bigint")
    found = toxicity.labelled_words(docs, labels, "toxic", model.language, "doc_id", "text").collect()
    y = {i: i % 3 for i in range(0, 1200, 2)} | {4: 5}
    assert sorted((r.y, sorted(r.words.split())) for r in found) == sorted((y[i], sorted(set((t or "").split()))) for i, t in texts if i in y)


def readings(restorer, token):
    """Every path of the lattice by itself: its cost and its letters."""
    paths = [(0.0, "")]
    for options in restorer.lattice(token):
        paths = [(cost + c, text + x) for cost, text in paths for x, c in options]
    return paths


def likelihood(model, text):
    """Of a text under the trigrams; edges in a row count once, and one at the end."""
    a = b = 0
    total = 0.0
    for x in text:
        code = 0 if x == " " else toxicity._CODE.get(x, toxicity.CODES - 1)
        if code == 0 and b == 0:
            continue
        total += model[a][b][code]
        a, b = b, code
    return total + (model[a][b][0] if b else 0)


@pytest.mark.parametrize("token", ["m0r0n", "a$$", "hat3", "5tup1d!", "s*t", "m o r", "ttt1lll", "s**t", "x1l|!", "w.0.r", "***", "h3ll0ooo", "1", ""])
def test_decoder_takes_the_best_path(model, token):
    restorer = toxicity.Restorer(model.language)
    scored = [(likelihood(restorer.model, t) - c, " ".join(t.split())) for c, t in readings(restorer, token)]
    best = max(s for s, _ in scored)
    found = " ".join(restorer.decode(token).split())
    assert max(s for s, t in scored if t == found) == pytest.approx(best, abs=1e-4)


def test_signs_at_the_end_open_a_lattice(model):
    kinds = toxicity.Restorer(model.language).kinds
    assert toxicity.disguised("a$$ hat3 di3, a55. x", kinds) == {"a$$", "hat3", "di3,", "a55."}
    assert toxicity.disguised("so! (see) 1990 erheat$$$ a1b2c3 r2000", kinds) == {"(see)", "a1b2c3"}
    assert toxicity.Restorer(model.language).decode("worthless9") in ("worthless ", "worthless", "worthlessg")


@pytest.mark.parametrize("signs", ["aGVsbG8gd29ybGQ0", "x1", "1l", "$", "a*", "ab...", "eee"])
def test_a_long_token_takes_linear_time(model, signs):
    """A token of a million signs without white space ends, and twice the signs take about twice the time."""
    restorer = toxicity.Restorer(model.language)
    seconds = []
    for n in (100_000, 200_000):
        token = (signs * (n // len(signs) + 1))[:n]
        begin = time.perf_counter()
        toxicity.words_of(token + " end", restorer)
        seconds.append(time.perf_counter() - begin)
    assert seconds[1] < 30 and seconds[1] < 4 * seconds[0] + 1
