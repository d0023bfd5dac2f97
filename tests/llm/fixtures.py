"""Small tables with the awkward rows that every operator must stand, and plain versions of shared rules."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

#: Names that operators use inside, as columns of the caller.
CLASHING = "id fp key rank pos at doc line words score shard segment row items n y _row _doc _at size group".split()


def lower(text: str | None) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text: str | None) -> list[str]:
    return WORD.findall(lower(text))


def prose(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdeilnorstuäé") for _ in range(rng.randint(2, 8))) for _ in range(n))


def texts() -> list[str | None]:
    long = prose(6000, 1)
    lines = "\n".join(prose(30, s) for s in range(2, 8))
    near = prose(300, 9)
    return [
        None,
        "",
        "   ",
        "\n\n",
        "One",
        "Two words",
        lines,
        lines,
        lines + "\n" + prose(5, 20),
        prose(12, 21) + "\n" + lines,
        near,
        near + " x",
        near.replace(" ", "  "),
        long,
        long + " end",
        "tie tie tie tie tie",
        "Ünïcode Ärger \U0001f600 <|endoftext|> text",
        "two  spaces \t and\ttabs ",
        *[prose(60, s) for s in range(30, 50)],
    ]


def documents(spark: SparkSession, clashing: bool = False) -> DataFrame:
    """Documents with a null id, a repeated row and one id with two texts; optionally with clashing columns."""
    rows = [(i, t, "en", f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts())]
    rows += [rows[6], (None, prose(20, 60), None, None, None), (5, prose(25, 61), "en", "s0", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    if clashing:
        for c in CLASHING:
            df = df.selectExpr("*", f"'other' AS `{c}`")
    return df.repartition(3)


def nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def on_disk(df: DataFrame, folder) -> DataFrame:
    """The rows as a table, which gives them in the same order each time."""
    path = str(folder)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
