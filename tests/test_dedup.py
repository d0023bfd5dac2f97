from pyspark.sql import functions as F

from turnsieve.operators import dedup, select


def texts(spark, rows):
    return spark.createDataFrame(rows, "file_idx int, row_idx long, id string, first_user string").withColumn(
        "source", F.lit("s")
    )


ROWS = [
    (0, 0, "a", "Hello  world"), (0, 1, "b", "hello WORLD"), (0, 2, "a", "other"), (0, 3, "c", ""),
    (1, 0, "d", " "), (1, 1, None, "one"), (1, 2, None, "two"), (1, 3, "e", "HELLO world "), (1, 4, "f", "two"),
]


def positions(df):
    return sorted((r.file_idx, r.row_idx) for r in df.collect())


def test_first_per_text_keeps_one_empty_key(spark):
    df = texts(spark, ROWS)
    assert positions(dedup.keep_first_text(df)) == [(0, 0), (0, 2), (0, 3), (1, 1), (1, 2)]


def test_result_does_not_depend_on_partitions(spark):
    df = texts(spark, ROWS * 1)
    want = positions(dedup.keep_first_text(df))
    for n in (1, 3, 7):
        assert positions(dedup.keep_first_text(df.repartition(n, "id"))) == want


def test_by_id_then_text(spark):
    # the second row of id a is gone before its text can claim a key; null is one id
    df = texts(spark, ROWS)
    assert positions(dedup.keep_first_by_id_then_text(df)) == [(0, 0), (1, 1), (1, 4)]


def test_unseen(spark):
    df = texts(spark, ROWS)
    early = dedup.keep_first_text(df.where("file_idx = 0"))
    late = dedup.keep_first_unseen(df.where("file_idx = 1"), early)
    assert positions(early.unionByName(late)) == positions(dedup.keep_first_text(df))


def test_counters(spark):
    df = texts(spark, ROWS).withColumn("language", F.when(F.col("row_idx") < 3, "En"))
    row = dedup.scan_counters(df, select.language_in("en")).first()
    assert row.asDict() == {"rows_seen": 9, "other_language": 3, "duplicates": 1, "candidates": 5}


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(200_000, numPartitions=8).select(
        F.lit(0).alias("file_idx"), F.col("id").alias("row_idx"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("first_user"),
    )
    kept = dedup.keep_first_text(df)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange") < plan.index("row_number(), 1, Partial")
    assert kept.where("first_user = 'hot'").collect()[0].row_idx == 0
