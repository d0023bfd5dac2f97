import itertools

import numpy as np

from turnsieve.llm import quality

from .fixtures import documents, nothing, prose


def test_sum_of_squares_is_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    w, v = rng.normal(size=12), rng.normal(size=(12, quality.RANK))
    at, x = np.array([1, 4, 5, 9]), np.array([0.5, -1.0, 2.0, 0.25])
    pairs = sum(v[at[i]] @ v[at[j]] * x[i] * x[j] for i, j in itertools.combinations(range(4), 2))
    assert np.isclose(quality.raw_score(at, x, w, v), w[at] @ x + pairs)


def test_inputs_of_any_text():
    for text in (None, "", " ", "\n\n", "a", prose(20_000, 1), "\U0001f600 ß!!"):
        at, value = quality.inputs(text)
        assert len(at) == len(value) == len(set(at.tolist())) and np.isfinite(value).all()
        assert at.max() < len(quality.STATISTICS) + quality.BUCKETS


def test_held_out_accuracy(spark):
    rows = [(i, prose(60, i) if i % 4 else " ".join([prose(1, i) + "!!"] * 60)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(600) if i % 5], "doc_id bigint, quality int")
    model = quality.fit(docs, labels)
    held = [r for r in quality.score(docs, model).collect() if r.doc_id % 5 == 0]
    assert np.mean([(r.score >= 0.7) == (r.doc_id % 4 > 0) for r in held]) > 0.97
    again = quality.fit(docs.repartition(5), labels)
    assert np.allclose(model[0], again[0])


def test_awkward_rows(spark):
    df = documents(spark, clashing=True)
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)] + [(None, 1), (2, None)], "doc_id bigint, quality int")
    rows = quality.score(df, quality.fit(df, labels)).collect()
    assert len(rows) == df.count() and all(0 <= r.score <= 1 for r in rows)
    none = quality.fit(df, labels.where("false"))
    assert {r.score for r in quality.score(df, none).collect()} == {0.5}
    assert quality.score(nothing(spark), none).collect() == []
