import pyarrow.parquet as pq
import pytest

from turnsieve.llm import decontaminate

from .fixtures import documents, nothing, on_disk, prose, words

ITEMS = "item_id bigint, text string"


def items(spark, rows):
    return spark.createDataFrame(rows, ITEMS)


def plain(docs, rows):
    out = []
    for i, text in docs:
        ws, hit, found = words(text), set(), set()
        for item, t in rows:
            qs = words(t)
            n = min(10, len(qs))
            if item is None or not n:
                continue
            windows = {tuple(qs[k : k + n]) for k in range(len(qs) - n + 1)}
            for p in range(len(ws) - n + 1):
                if tuple(ws[p : p + n]) in windows:
                    hit |= set(range(p, p + n))
                    found.add(str(item))
        out.append((i, len(ws), len(hit), sorted(found)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("segment", "block"), [(1 << 19, 50_000), (300, 20)])
def test_against_brute_force(spark, segment, block):
    rows = [(k, prose(14 + k, 500 + k)) for k in range(6)]
    rows += [(10, "Three short words"), (11, "the"), (12, ""), (13, None), (None, prose(12, 500)), (14, prose(14, 500)), (9, "Two words")]
    docs = [(r.doc_id, r.text) for r in documents(spark).collect()]
    docs += [(900 + k, prose(20, k) + "\n" + rows[k][1].upper() + " the " + prose(8, k)) for k in range(6)]
    docs += [(950, " ".join(words(rows[2][1])[3:13])), (951, " ".join(words(rows[2][1])[3:12])), (952, "the " * 40), (953, rows[1][1] + " " + rows[1][1])]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumnsRenamed({}).repartition(2)
    for c in ("segment", "row", "items", "id"):
        df = df.selectExpr("*", f"'x' AS {c}")
    found = decontaminate.decontaminate(df, items(spark, rows), segment_words=segment, block_windows=block).collect()
    assert sorted(((r.id, r.n_words, r.n_hit, r["items"]) for r in found), key=str) == plain(docs, rows)


def test_proximity(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    moved = "beta alpha gamma delta filler epsilon zeta eta theta iota kappa"
    df = spark.createDataFrame([(1, item), (2, moved), (3, "alpha " + prose(40, 1) + " kappa")], "doc_id bigint, text string")
    rows = {r.id: r for r in decontaminate.decontaminate(df, items(spark, [(1, item)])).collect()}
    assert (rows[1].n_hit, rows[1].n_near) == (10, 0)
    assert (rows[2].n_hit, rows[2].n_near) == (0, 1)
    assert (rows[3].n_hit, rows[3].n_near) == (0, 0)


def test_empty(spark):
    assert decontaminate.decontaminate(nothing(spark), items(spark, [(1, "a b")])).collect() == []
    rows = decontaminate.decontaminate(documents(spark), items(spark, [])).collect()
    assert len(rows) == documents(spark).count() and all(r.n_hit == 0 and r["items"] == [] for r in rows)


def test_blocks_follow_each_other(spark, monkeypatch):
    """With hundreds of blocks each is written before the next is collected, and none stays broadcast."""
    order = []
    write = decontaminate.written

    def watched(df, name, path=None):
        if name == "matches":
            order.append("written")
        return write(df, name, path)

    one = decontaminate._search_block

    def block(index, rows, item, near):
        order.append("collected")
        return one(index, rows, item, near)

    monkeypatch.setattr(decontaminate, "written", watched)
    monkeypatch.setattr(decontaminate, "_search_block", block)
    rows = [(k, prose(12, 700 + k)) for k in range(10)]
    docs = [(k, prose(5, k) + " " + t) for k, t in rows]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(2)
    found = decontaminate.decontaminate(df, items(spark, rows), block_windows=1).collect()
    assert len(order) >= 40 and order == ["collected", "written"] * (len(order) // 2)
    assert sorted(((r.id, r.n_words, r.n_hit, r["items"]) for r in found), key=str) == plain(docs, rows)


def test_index_files_open_few_segments_at_once(spark, tmp_path):
    docs = spark.createDataFrame([(i, prose(400, i)) for i in range(12)], "doc_id bigint, text string").coalesce(1)
    index = decontaminate.build_index(on_disk(docs, tmp_path / "docs"), segment_words=400)
    files = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in index.inputFiles()]
    groups = [m.row_group(g) for m in files for g in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 12 and max(g.num_rows for g in groups) == 2
