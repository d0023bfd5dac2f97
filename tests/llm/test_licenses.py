import random
import time

import pytest

from turnsieve.llm import licenses

from .fixtures import documents, nothing, prose, words


def one(spark, text, **more):
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    return licenses.summary(licenses.scan(df, **more)).first()


def test_base_phrases(spark):
    text = "X. CC-BY, cc by; the Apache\nLicense and the MIT LICENSES. mit license GNU General Public License gnu general public license"
    r, ws = one(spark, text), words(text)
    at = [(i, label) for p, label in licenses.BASE.items() for i in range(len(ws)) if ws[i : i + len(p.split())] == p.split()]
    assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(ws), len(at), min(at)[0], max(at)[0])
    assert r.base_labels == ",".join(sorted({x for _, x in at})) and r.score == 1


@pytest.mark.parametrize("edits", [0, 1, 3, 5])
def test_fuzzy_notice(spark, edits):
    notice = "permission is hereby granted free of charge to any person obtaining a copy"
    broken = list(notice)
    for i in range(edits):
        broken[5 + 11 * i] = "q"
    text = prose(50, 1) + " " + "".join(broken) + " " + prose(50, 2)
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    spans = [s for s in licenses.scan(df).first().spans if s.label == "mit-text"]
    assert len(spans) == 1 and spans[0].errors == edits
    assert spans[0].first == 50 and spans[0].found == "".join(broken)


def test_every_copy_and_the_best_of_similar_notices(spark):
    text = "licensed under cc by nc 4.0. " * 3 + prose(5, 3) + " licensed under cc by sa 4.0"
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    spans = [s for s in licenses.scan(df).first().spans if not s.exact]
    assert [s.label for s in spans] == ["cc-by-nc-4.0"] * 3 + ["cc-by-sa-4.0"]


def test_clean_texts_have_no_labels(spark):
    df = spark.createDataFrame([(i, prose(500, i)) for i in range(40)], "doc_id bigint, text string")
    assert all(r.labels == "" and r.score == 0 for r in licenses.summary(licenses.scan(df)).collect())


def test_awkward_rows(spark):
    rows = licenses.summary(licenses.scan(documents(spark, clashing=True))).collect()
    assert len(rows) == documents(spark).count()
    empty = next(r for r in rows if r.doc_id == 0)
    assert (empty.n_words, empty.n_base, empty.first_word, empty.labels, empty.score) == (0, 0, None, "", 0)
    assert licenses.summary(licenses.scan(nothing(spark))).collect() == []


def test_many_matches_in_one_text():
    """Time grows with the text: 200,000 exact and 20,000 fuzzy places."""
    scanner = licenses.Scanner(licenses.BASE, licenses.NOTICES, licenses.LETTERS_PER_EDIT)
    begin = time.perf_counter()
    places = scanner.exact(b" " + b"cc by " * 200_000)
    assert [w for w, _, _ in places] == list(range(0, 400_000, 2))
    text = " " + "all rights resarved x " * 20_000
    near = scanner.fuzzy(text)
    assert licenses._word_numbers(text, near) == [(4 * i, 4 * i + 2) for i in range(20_000)]
    assert time.perf_counter() - begin < 20


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_against_edit_distances():
    """Every place within the allowed edits is found, and what is found is within them."""
    notice = "licensed under creative commons attribution"
    scanner = licenses.Scanner({}, {notice: "cc"}, licenses.LETTERS_PER_EDIT)
    k, rng = len(notice) // licenses.LETTERS_PER_EDIT, random.Random(4)
    for n in range(120):
        broken = list(notice)
        for _ in range(n % (k + 3)):
            i = rng.randrange(len(broken))
            broken[i : i + 1] = rng.choice(([], ["q"], [broken[i], "q"]))
        broken, before = "".join(broken), prose(6, n)
        text = f" {before} {broken} {prose(6, n + 500)} "
        found = scanner.fuzzy(text)
        spans = [text[a:b] for a, b, *_ in found]
        assert all(edits(notice, s) == e <= k for s, (_, _, _, e, _) in zip(spans, found, strict=True))
        # the smallest distance of any part of the text that begins or ends about there
        low = len(before) + 2
        best = min(edits(notice, text[a:b]) for a in range(low - 2, low + 3) for b in range(low + len(broken) - 3, low + len(broken) + 3))
        assert bool(found) == (best <= k)
