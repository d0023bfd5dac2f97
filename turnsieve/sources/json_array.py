"""A file that is one JSON array, read by many tasks.

The text reader cuts the file at commas, so Spark can split it anywhere. Whether a comma parts two elements
depends on all that stands before it: on the number of quotes, and on the brackets outside of strings. A first
pass sums up each block (a task's byte range) for both ways of entering it, outside and inside a string. Running
sums over those, one row a block, say how each block is really entered. A second pass walks a block's pieces and gives
whole elements; only what reaches over the border of a block is joined with its other parts, by a shuffle
of those fragments. No task holds more than a block and the elements at its borders.

Escapes never reach over a comma, so a piece can be counted by itself: escaped signs are taken out first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written

_BLANK = "\ufeff \t\r\n"


def _signs(text: Column, signs: str) -> Column:
    return F.length(text) - F.length(F.translate(text, signs, ""))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Pieces between commas in their order within a block, with their quotes and their brackets when begun outside and inside a string."""
    plain = F.regexp_replace("value", r"\\[\s\S]", "")
    strings = r'"[^"]*"?'
    out, within = F.regexp_replace(plain, strings, ""), F.regexp_replace(F.concat(F.lit('"'), plain), strings, "")
    return spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        _signs(plain, '"').alias("quotes"),
        (_signs(out, "[{") - _signs(out, "]}")).alias("out"),
        (_signs(within, "[{") - _signs(within, "]}")).alias("within"),
        F.col("value").alias("text"),
    )


def _by_block(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], slice]]:
    """Rows of a batch that belong to one block."""
    path, start = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
    at = 0
    while at < len(path):
        end = at + 1
        while end < len(path) and start[end] == start[at] and path[end] == path[at]:
            end += 1
        yield (path[at], int(start[at])), slice(at, end)
        at = end


def _numbers(batch: pa.RecordBatch, rows: slice, first: int) -> list[np.ndarray]:
    return [batch.column(first + i).to_numpy(zero_copy_only=False)[rows].astype(np.int64) for i in range(3)]


def _effects(pieces: DataFrame) -> DataFrame:
    """``(path, start, quotes, out, within)``: what a block does when it is entered outside and inside a string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, np.zeros(3, dtype=np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"path": key[0], "start": key[1], "quotes": int(total[0]), "out": int(total[1]), "within": int(total[2])}])

        for batch in batches:
            for block, rows in _by_block(batch):
                if block != key:
                    if key is not None:
                        yield out()
                    key, total = block, np.zeros(3, dtype=np.int64)
                quotes, outside, inside = _numbers(batch, rows, 2)
                odd = (total[0] + np.cumsum(quotes) - quotes) % 2 == 1
                total += [quotes.sum(), np.where(odd, inside, outside).sum(), np.where(odd, outside, inside).sum()]
        if key is not None:
            yield out()

    slim = pieces.select("path", "start", "quotes", "out", "within")
    return slim.mapInArrow(run, "path string, start bigint, quotes bigint, out bigint, within bigint")


def _entered(effects: DataFrame) -> DataFrame:
    """``(path, start, odd, depth)``: how each block is entered. One slim row a block is all that a window holds."""
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    odd = effects.withColumn("odd", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    taken = F.when(F.col("odd") == 1, F.col("within")).otherwise(F.col("out"))
    return odd.withColumn("depth", F.coalesce(F.sum(taken).over(before), F.lit(0))).select("path", "start", "odd", "depth")


def _segments(pieces: DataFrame, entered: DataFrame) -> DataFrame:
    """``(path, start, seq, whole, closes, text)``: a block's text parted at the commas between elements.

    ``whole`` segments are elements; the others, the first and the last of a block, may have parts elsewhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, odd, depth, seq, held = None, 0, 0, 0, []

        def rows(texts: list[str], closes: bool) -> pa.RecordBatch:
            n = len(texts)
            columns = {
                "path": pa.array([key[0]] * n, pa.string()),
                "start": pa.array([key[1]] * n, pa.int64()),
                "seq": pa.array(range(seq, seq + n), pa.int64()),
                "whole": pa.array([closes and seq + i > 0 for i in range(n)]),
                "closes": pa.array([closes] * n),
                "text": pa.array(texts, pa.string()),
            }
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            for block, at in _by_block(batch):
                if block != key:
                    if held:
                        yield rows([",".join(held)], False)
                    first = batch.column(5)[at.start].as_py()
                    if first is None:
                        raise ValueError(f"{block[0]}: the file was split in another way; read it again")
                    key, odd, depth, seq, held = block, first, batch.column(6)[at.start].as_py(), 0, []
                quotes, outside, inside = _numbers(batch, at, 2)
                texts = batch.column(7).slice(at.start, at.stop - at.start).to_pylist()
                after = odd + np.cumsum(quotes)
                depths = depth + np.cumsum(np.where((after - quotes) % 2 == 1, inside, outside))
                if depth == 0 and seq == 0 and not held and block[1] == 0:
                    head = texts[0].lstrip(_BLANK)
                    if not head.startswith("["):
                        raise ValueError(f"{block[0]} is not a JSON array")
                    texts[0] = head[1:]
                for i in np.flatnonzero((depths == 0) & (after % 2 == 0))[:1]:
                    texts[i] = texts[i].rstrip(_BLANK).removesuffix("]")
                ends = np.flatnonzero((depths == 1) & (after % 2 == 0))
                made, low = [], 0
                for end in ends.tolist():
                    made.append(",".join([*held, *texts[low : end + 1]]))
                    held, low = [], end + 1
                if made:
                    yield rows(made, True)
                    seq += len(made)
                held += texts[low:]
                odd, depth = int(after[-1] % 2), int(depths[-1])
        if held:
            yield rows([",".join(held)], False)

    known = pieces.join(F.broadcast(entered), ["path", "start"], "left")  # one row for each byte range of a task
    slim = known.select("path", "start", "quotes", "out", "within", "odd", "depth", "text")
    return slim.mapInArrow(run, "path string, start bigint, seq bigint, whole boolean, closes boolean, text string")


def elements(spark: SparkSession, path: str) -> DataFrame:
    """``(path, row_idx, text)``: the elements of the array in each file, numbered from 0 in the file's order."""
    pieces = _pieces(spark, path)
    entered = written(_entered(written(_effects(pieces), "effects")), "entered")
    segments = written(_segments(pieces, entered), "segments")
    order = Window.partitionBy("path").orderBy("start", "seq")
    # slim rows, two a block: a fragment belongs to the element that the last closing fragment before it has left open
    ends = F.col("closes").cast("bigint")
    fragments = segments.where(~F.col("whole")).select(
        "path", "start", "seq", (F.sum(ends).over(order) - ends).alias("group")
    )
    texts = segments.where(~F.col("whole")).join(fragments, ["path", "start", "seq"])
    place = F.struct("start", "seq")
    joined = texts.groupBy("path", "group").agg(
        F.min(place).alias("at"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(place.alias("p"), "text"))), lambda x: x["text"]), ",").alias("text"),
    )
    joined = joined.where(F.col("text").rlike(r"\S")).select("path", "at.start", "at.seq", "text")
    both = written(segments.where("whole").select("path", "start", "seq", "text").union(joined), "elements")
    # elements that begin in a block have numbers without a gap there
    blocks = both.groupBy("path", "start").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("low"))
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("path", "start", "low", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin"))
    number = F.col("begin") + F.col("seq") - F.col("low")
    return both.join(F.broadcast(starts), ["path", "start"]).select("path", number.alias("row_idx"), "text")


def read_json_array(spark: SparkSession, path: str, schema: T.StructType, parquet_path: str | None = None) -> DataFrame:
    """Rows of the array in a file, or in each file of a folder, with ``row_idx``; optionally stored as Parquet.

    Elements that do not fit the schema have nulls, as in Spark's own reader. Blank files are refused, as is a file
    whose outermost value is not an array. Compressed files cannot be split and are one block.
    """
    found = elements(spark, path).select(F.from_json("text", schema).alias("row"), "row_idx")
    found = found.select(*[F.col(f"row.`{n}`").alias(n) for n in schema.names], "row_idx")
    return found if parquet_path is None else written(found, "json-array", parquet_path)
