"""A corpus pipeline of five of the training-data operators, each stage written before the next reads it.

Stages take ``(spark, docs, sf_dir)`` and return a DataFrame. All but the last return the columns of
``docs``; a stage works on all that its predecessor kept. A session without a bound of its own on the bytes of
Arrow batches gets one (``small_batches``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnsieve.llm import decontaminate, linededup, packing, simhash, toxicity
from turnsieve.llm.common import free_name, table
from turnsieve.session import new_folder, remove, small_batches, written

TOXIC, FOLDS = 0.5, 5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below one half. Learnt from the same labels as the operator's query."""
    small_batches(spark)
    fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(fold != 0))
    name = free_name(docs, "_toxicity")
    return toxicity.score(docs, model, name=name).where(F.col(name) < TOXIC).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later copies of repeated runs of lines.

    One that consists of such copies alone is left out; one that was empty before stays. ``n_chars`` is
    counted again where lines were deleted.
    """
    found = linededup.deduplicate_lines(docs).where((F.col("_gone") == 0) | (F.col("_gone") < F.col("_lines")))
    changed = F.when(F.col("_gone") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", changed).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (four-word shingles, four bits): the one with the smallest id.

    A null id comes before the others. Of rows that share the smallest id one stays, the first read. ``docs`` is read
    several times and must be a table or another source that gives its rows in the same order again. Null and empty
    texts are one group, that of fingerprint zero.
    """
    small_batches(spark)
    row = free_name(docs, "_row")
    keyed = docs.withColumn(row, F.monotonically_increasing_id())
    both = F.struct(F.col("doc_id"), F.col(row).alias("row"))
    groups = simhash.near_duplicates(keyed.select(both.alias("key"), "text"), id_col="key")
    first = groups.where(F.col("id") == F.col("component")).select(F.col("id.row").alias(row))
    return keyed.join(written(first, "first"), row, "left_semi").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of ten words of a benchmark item, also of items without an id.

    Rows are told apart by id and text, so each of several rows with one id, or with a null one, is judged by its own
    text; repeated rows share their fate. Null and empty texts stay. No documents give none; without items all stay.
    """
    small_batches(spark)
    # the operator leaves out items with a null id, and only whether a document has a hit counts here
    items = table(spark, sf_dir, "benchmark").withColumn("item_id", F.coalesce(F.col("item_id").cast("string"), F.lit("")))
    row = free_name(docs, "_row")
    keyed = docs.withColumn(row, F.concat_ws(":", F.col("doc_id"), F.xxhash64("text")))
    found = decontaminate.decontaminate(keyed.select(row, "text"), items, id_col=row)
    hit = written(found.where("n_hit > 0").select(F.col("id").alias(row)).distinct(), "contaminated")
    return keyed.join(hit, row, "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens."""
    small_batches(spark)
    return packing.digest(packing.pack(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("packing", pack),
]

#: The restoration of words, the fingerprints' hash and the tokenizer have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_folder(spark, f"stage-{name}")
        docs = written(stage(spark, docs, sf_dir), name, path)
        if before:
            remove(spark, before)
        before = path
    return docs
