import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from turnsieve.session import configure  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("turnsieve-tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield configure(session)
    session.stop()


@pytest.fixture
def column(spark):
    """Values of an expression over a list of texts, in their order."""
    from pyspark.sql import functions as F

    def values(texts, expression, dtype="string"):
        df = spark.createDataFrame(list(enumerate(texts)), f"i int, x {dtype}")
        rows = df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()
        return [r.y for r in rows]

    return values
