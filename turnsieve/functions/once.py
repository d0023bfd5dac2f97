"""Columns that are costly to compute and often filtered on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns by a generator of one row.

    A filter on a plain computed column is pushed below the projection with a copy of its expression,
    so a text would be parsed once for the filter and again for the result. A filter on what a
    generator makes stays above it. Still one narrow step: no shuffle, no extra rows.
    """
    values = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(values)))
