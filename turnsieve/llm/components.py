"""Connected components of a graph of links, by large-star and small-star steps.

Each round hangs the larger neighbours of a node on its smallest neighbour, then its smaller ones
(Kiveris et al., 2014). The number of rounds grows with the logarithm of the longest chain. A round is
two partial minima and two joins; a hub with a third of all links is a single row in the minimum, and its
links are an ordinary join side that adaptive execution can split. Every round is written to the shared
folder, which also cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_folder
from .common import remove


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node that has a link; the root is the component's smallest node.

    Links are undirected; self-links, null ends and repeated links do no harm. No links give no rows.
    """
    spark = links.sparkSession
    now = (
        links.where(f"{a} IS NOT NULL AND {b} IS NOT NULL AND {a} <> {b}")
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    state = path = None
    while True:
        old, path = path, new_folder(spark, "components")
        now.write.parquet(path)
        now = spark.read.schema(now.schema).parquet(path)
        if old:
            remove(spark, old)
        # unchanged when neither the number of links nor the sum of their hashes has moved
        last, state = state, now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last or not state[0]:
            roots = now.select("v").distinct()
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("v", "v"))
        now = _small_star(_large_star(now))
