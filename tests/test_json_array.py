"""A JSON array read in many byte ranges, against the parser of the standard library."""

import json
import random

import pytest

from turnsieve.session import settings
from turnsieve.sources import json_array, readers

SCHEMA = "id string, n long, tags array<string>, deep struct<a:struct<b:array<array<long>>>>"
TEXTS = [
    "plain", "", 'quote " inside', "back\\slash", 'both \\" of them', "brackets ]}[{,", 'a comma, "and", more', "line\nfeed\ttab",
    "ends with a backslash \\", "\\\\", '"', '",', '\\",[', "ünï \U0001f600 code", "long " * 400, ",", ",,,", "]", "[",
]


def elements(n, seed):
    rng = random.Random(seed)
    return [
        {
            "id": rng.choice(TEXTS),
            "n": rng.randint(0, 9),
            "tags": [rng.choice(TEXTS) for _ in range(rng.randint(0, 4))],
            "deep": {"a": {"b": [[rng.randint(0, 9) for _ in range(rng.randint(0, 3))] for _ in range(rng.randint(0, 3))]}},
        }
        for _ in range(n)
    ]


def read(spark, path, size):
    # blocks of a few bytes, and a task for each
    with settings(spark, spark__sql__files__maxPartitionBytes=str(size), spark__sql__files__openCostInBytes="16"):
        rows = readers.read_json_array(spark, str(path), spark.createDataFrame([], SCHEMA).schema)
        return [r.asDict(recursive=True) for r in rows.orderBy("row_idx").collect()]


@pytest.mark.parametrize(("indent", "ascii_only"), [(None, True), (2, False)])
@pytest.mark.parametrize(("size", "n"), [(250, 7), (3000, 60)])
def test_against_the_standard_parser(spark, tmp_path, size, n, indent, ascii_only):
    rows = elements(n, 1)
    path = tmp_path / "array.json"
    path.write_text(json.dumps(rows, indent=indent, ensure_ascii=ascii_only), encoding="utf-8")
    assert read(spark, path, size) == [{**r, "row_idx": i} for i, r in enumerate(rows)]


def test_several_tasks_on_one_file(spark, tmp_path):
    path = tmp_path / "array.json"
    path.write_text(json.dumps(elements(300, 2)))
    with settings(spark, spark__sql__files__maxPartitionBytes="8k", spark__sql__files__openCostInBytes="16"):
        pieces = json_array._pieces(spark, str(path))
        assert pieces.rdd.getNumPartitions() > 5
        assert pieces.select("start").distinct().count() == pieces.rdd.getNumPartitions()


@pytest.mark.parametrize(("text", "n"), [("[]", 0), (" [ \n ] \n", 0), ("\ufeff[{}]", 1), ("[{}, {}]\n", 2), ('[{"id": "x"}]', 1)])
def test_small_arrays(spark, tmp_path, text, n):
    (tmp_path / "a.json").write_text(text, encoding="utf-8")
    assert len(read(spark, tmp_path / "a.json", 1 << 20)) == n


def test_an_element_longer_than_many_blocks(spark, tmp_path):
    rows = [{"id": "first"}, {"id": "x,\"]" * 3000, "tags": ["a"] * 500}, {"id": "last"}]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    got = read(spark, tmp_path / "a.json", 4000)
    assert [(r["row_idx"], r["id"]) for r in got] == [(i, r["id"]) for i, r in enumerate(rows)]
    assert got[1]["tags"] == ["a"] * 500


def test_elements_that_do_not_fit(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 5, "n": "x"}, 7, null, {"id": "ok"}]')
    got = read(spark, tmp_path / "a.json", 1 << 20)
    assert len(got) == 4 and got[3]["id"] == "ok" and got[1]["id"] is None


def test_each_file_of_a_folder(spark, tmp_path):
    for name, seed in (("a", 3), ("b", 4)):
        (tmp_path / f"{name}.json").write_text(json.dumps(elements(30, seed)))
    with settings(spark, spark__sql__files__maxPartitionBytes="3000", spark__sql__files__openCostInBytes="16"):
        rows = json_array.elements(spark, str(tmp_path)).collect()
    for name, seed in (("a", 3), ("b", 4)):
        own = sorted((r.row_idx, json.loads(r.text)["id"]) for r in rows if r.path.endswith(f"{name}.json"))
        assert own == [(i, e["id"]) for i, e in enumerate(elements(30, seed))]


def test_other_files_are_refused(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "x"}')
    with pytest.raises(Exception, match="not a JSON array"):
        read(spark, tmp_path / "a.json", 1 << 20)
