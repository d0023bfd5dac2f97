"""Repeated runs of lines, found by a suffix array over line ids and deleted but for their first copy.

A line's id is its digest. Lines that occur once end every repeat, so only suffixes that start with a
repeated line are ordered. Prefix doubling sorts them by their first 1, 2, 4 … lines: a rank is the place
in a range-partitioned sort of the pairs (rank, rank ``2^k`` lines further on). Suffixes whose prefix has
become unique leave; the order is refined until it tells apart the longest prefix that is asked for.

Suffixes that share ``n`` lines form one interval of the array with a common prefix of at least ``n``; its
members have equal ranks for the two overlapping halves of those lines. Every line is asked for the shortest run of
``MIN_WORDS`` words that starts with it and the shortest that ends with it. Those two cover every maximal
repeated run of that many words exactly. In each interval the first place is kept, and every later one is
paired with it. Pairs that go on from line to line at the same distance grow together into the longest common
prefix of the two places: a maximal repeated run (:func:`repeated_runs`). The later copies' lines are deleted, as
disjoint stretches of a document; the first place of a line's text never is.

Built-in DataFrame functions only. Ranks are fixed by writing each order to the shared folder before it is
used. The largest window partition is one document; counts, minima and joins are all that runs over
a line's copies.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .common import free_name

MIN_WORDS = 50


def _ordered(df: DataFrame, *by: str, name: str, label: str) -> DataFrame:
    """``df`` with a number that grows with ``by``; written, so that it stays as it is."""
    rows = df.repartitionByRange(*by).sortWithinPartitions(*by)
    return written(rows.withColumn(name, F.monotonically_increasing_id()), label)


def _lines(docs: DataFrame, key: str, id_col: str, text_col: str) -> DataFrame:
    """``(doc, id, pos, line, words)`` of every line; null texts have none."""
    lines = docs.select(
        F.col(key).alias("doc"), F.col(id_col).alias("id"), F.posexplode(F.split(text_col, "\n", -1)).alias("pos", "text")
    )
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")
    return written(lines.select("doc", "id", "pos", F.unhex(F.md5("text")).alias("line"), words.alias("words")), "lines")


def _suffixes(lines: DataFrame) -> DataFrame:
    """``(at, doc, pos, words, rank)`` of each repeated line: its place in the order of documents and its rank."""
    repeated = lines.groupBy("line").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("line")
    rank = _ordered(repeated, "line", name="rank", label="ranks")
    found = lines.join(rank, "line").select("id", "doc", "pos", "words", "rank")
    return _ordered(found, "id", "doc", "pos", name="at", label="suffixes").drop("id")


def _runs(suffixes: DataFrame, min_words: int) -> DataFrame:
    """``(doc, pos, n)``: the shortest runs of ``min_words`` words from each line, and up to each line.

    A stretch is a series of repeated lines without a gap. Words before each line are summed; a line's run
    ends at the first boundary that lies ``min_words`` further on, found by a running minimum over
    boundaries and questions in one order, and likewise backwards.
    """
    by_doc = Window.partitionBy("doc").orderBy("pos")
    stretch = suffixes.withColumn("stretch", F.col("pos") - F.row_number().over(by_doc))
    inside = Window.partitionBy("doc", "stretch").orderBy("pos")
    sums = stretch.withColumn("after", F.sum("words").over(inside)).select(
        "doc", "stretch", "pos", "after", (F.col("after") - F.col("words")).alias("before")
    )

    def row(kind: int, value: Column, pos: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.alias("value"), pos.alias("pos"))

    # 0: a line begins before so many words; 1: a line ends; 2: where does the run from here end; 3: where did it begin
    rows = sums.select(
        "doc",
        "stretch",
        F.inline(
            F.array(
                row(0, F.col("before"), F.col("pos")),
                row(1, F.col("after"), F.col("pos")),
                row(2, F.col("before") + min_words, F.col("pos")),
                row(3, F.col("after") - min_words, F.col("pos")),
            )
        ),
    )
    running = (Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy("doc", "stretch").orderBy(F.desc("value"), "kind", "pos").rowsBetween(*running)
    up = Window.partitionBy("doc", "stretch").orderBy("value", "kind", "pos").rowsBetween(*running)
    found = rows.withColumn("last", F.min(F.when(F.col("kind") == 1, F.col("pos"))).over(down)).withColumn(
        "first", F.max(F.when(F.col("kind") == 0, F.col("pos"))).over(up)
    )
    begin = F.when(F.col("kind") == 2, F.col("pos")).when(F.col("kind") == 3, F.col("first"))
    end = F.when(F.col("kind") == 2, F.col("last")).when(F.col("kind") == 3, F.col("pos"))
    runs = found.select("doc", begin.alias("pos"), (end - begin + 1).alias("n"))
    return runs.where("n >= 1").distinct()


def _later(ranks: DataFrame, runs: DataFrame, half: int) -> DataFrame:
    """``(doc, pos, n, first_doc, first_pos)``: runs of ``half`` to ``2 * half - 1`` lines that have an earlier
    copy, and the first one. The interval of such suffixes is told by the ranks of the run's two halves."""
    wanted = runs.where((F.col("n") >= half) & (F.col("n") < 2 * half))
    tail = ranks.select("doc", F.col("pos").alias("tail"), F.col("rank").alias("rank2"))
    cells = (
        wanted.join(ranks.select("doc", "pos", "at", "rank"), ["doc", "pos"])
        .withColumn("tail", F.col("pos") + F.col("n") - half)
        .join(tail, ["doc", "tail"])
    )
    interval = cells.groupBy("n", "rank", "rank2").agg(
        F.min("at").alias("first"),
        F.min_by("doc", "at").alias("first_doc"),
        F.min_by("pos", "at").alias("first_pos"),
        F.count(F.lit(1)).alias("copies"),
    )
    later = cells.join(interval.where("copies > 1"), ["n", "rank", "rank2"]).where("at > first")
    return later.select("doc", "pos", "n", "first_doc", "first_pos")


def _stretches(runs: DataFrame, within: list[str]) -> DataFrame:
    """``(*within, pos, n)``: runs that overlap or touch as one, so that no line is in two; ``n`` lines from ``pos``.

    In the order of ``pos`` a run begins a new stretch if it lies behind the end of all runs before it.
    """
    order = Window.partitionBy(*within).orderBy("pos", "n")
    end = F.col("pos") + F.col("n")
    before = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = runs.select(*within, "pos", "n", F.when(F.coalesce(before < F.col("pos"), F.lit(True)), 1).otherwise(0).alias("_opens"))
    number = F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    merged = opens.withColumn("_stretch", number).groupBy(*within, "_stretch").agg(F.min("pos").alias("pos"), F.max(end).alias("_end"))
    return merged.select(*within, "pos", (F.col("_end") - F.col("pos")).alias("n"))


def _doubled(ranks: DataFrame, half: int) -> DataFrame:
    """Suffixes whose first ``2 * half`` lines repeat, with ranks by them."""
    further = ranks.select("doc", (F.col("pos") - half).alias("pos"), F.col("rank").alias("rank2"))
    pairs = ranks.join(further, ["doc", "pos"]).withColumnRenamed("rank", "rank1")
    repeated = pairs.groupBy("rank1", "rank2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("rank1", "rank2")
    rank = _ordered(repeated, "rank1", "rank2", name="rank", label="ranks")
    return written(pairs.join(rank, ["rank1", "rank2"]).select("at", "doc", "pos", "rank"), "suffixes")


def _without(text: Column, gone: Column) -> Column:
    """The text's lines but those at the sorted places ``gone``: slices between them, in linear time."""
    lines = F.split(text, "\n", -1)
    kept = F.transform(
        F.sequence(F.lit(0), F.size(gone)),
        lambda i: F.struct(
            F.when(i == 0, 0).otherwise(F.get(gone, i - 1) + 1).alias("from"),
            F.when(i == F.size(gone), F.size(lines)).otherwise(F.get(gone, i)).alias("to"),
        ),
    )
    kept = F.filter(kept, lambda r: r["from"] < r["to"])
    return F.array_join(F.flatten(F.transform(kept, lambda r: F.slice(lines, r["from"] + 1, r["to"] - r["from"]))), "\n")


def _later_copies(lines: DataFrame, min_words: int) -> DataFrame:
    """All runs of ``min_words`` words or little more that have an earlier copy, with the first one."""
    ranks = _suffixes(lines)
    runs = written(_runs(ranks, min_words), "runs")
    longest = runs.agg(F.max("n")).first()[0] or 1  # without runs one empty part
    half = 1
    later = []
    while half <= longest:
        later.append(written(_later(ranks, runs, half), "later"))
        if 2 * half <= longest:
            ranks = _doubled(ranks, half)
        half *= 2
    return reduce(DataFrame.unionByName, later).withColumn("n", F.col("n").cast("bigint"))


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``(id, line, n, first_id, first_line)``: maximal repeated runs of lines, each later place with an earlier one.

    ``n`` lines from ``line`` of a document are those from ``first_line`` of ``first_id``, the first place in order
    that has the run's beginning. Lines count from 0. A copy of several earlier places has a row for each that is the
    first one of some of its lines. The rules of :func:`deduplicate_lines` hold.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("doc", F.monotonically_increasing_id())
    later = _later_copies(_lines(base, "doc", "id", "text"), min_words)
    shift = (F.col("first_pos") - F.col("pos")).alias("shift")
    runs = _stretches(later.select("doc", "first_doc", shift, "pos", "n"), ["doc", "first_doc", "shift"])
    ids = base.select("doc", "id")
    firsts = ids.select(F.col("doc").alias("first_doc"), F.col("id").alias("first_id"))
    named = runs.join(ids, "doc").join(firsts, "first_doc")
    return named.select("id", F.col("pos").alias("line"), "n", "first_id", (F.col("pos") + F.col("shift")).alias("first_line"))


def deduplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the later copies of repeated runs of at least ``min_words`` words.

    All columns stay; three are added, in place of columns of the same names: ``_lines`` (lines before),
    ``_gone`` (lines deleted) and ``_words_gone``. Documents count in the order of their ids, rows with equal
    ids in the order in which they are read; a null id comes first. A document that loses every line has an
    empty text. Null texts stay null and have no lines, empty texts are one empty line. ``docs`` is read twice
    and must be a table or another source that gives its rows in the same order again. The work grows with the number
    of lines, also for stretches of many blank ones. An empty table gives no rows.
    """
    docs = docs.drop("_lines", "_gone", "_words_gone")
    key = free_name(docs, "_doc")
    base = docs.withColumn(key, F.monotonically_increasing_id())
    lines = _lines(base, key, id_col, text_col)
    later = _later_copies(lines, min_words)
    gone = _stretches(later, ["doc"]).select("doc", F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("n") - 1)).alias("pos"))
    counted = (
        lines.select("doc", "pos", "words")
        .join(gone, ["doc", "pos"])
        .groupBy(F.col("doc").alias(key))
        .agg(F.struct(F.array_sort(F.collect_list("pos")).alias("at"), F.sum("words").alias("words")).alias("_gone"))
    )
    at = F.col("_gone.at")
    text = F.when(at.isNull(), F.col(text_col)).otherwise(_without(F.col(text_col), at))
    columns = [text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return base.join(counted, key, "left").select(
        *columns,
        F.when(F.col(text_col).isNull(), 0).otherwise(F.size(F.split(text_col, "\n", -1))).cast("bigint").alias("_lines"),
        F.when(at.isNull(), 0).otherwise(F.size(at)).cast("bigint").alias("_gone"),
        F.coalesce("_gone.words", F.lit(0).cast("bigint")).alias("_words_gone"),
    )
