"""Keys that Spark has no built-in function for, and the shape rule of request ids."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Digest size of published text keys, and the shape of a usable request id.
NATURAL_KEY_BYTES = 12
ID_PATTERN = r"^[A-Za-z0-9_-]{1,64}\z"


@F.pandas_udf(T.StringType())
def natural_key(text: pd.Series) -> pd.Series:
    """BLAKE2b of the UTF-8 text, hex. Only needed to join keys that were published this way."""
    return text.map(
        lambda t: hashlib.blake2b(
            t.encode("utf-8", "replace"), digest_size=NATURAL_KEY_BYTES
        ).hexdigest(),
        na_action="ignore",
    )


def valid_id(value: Column) -> Column:
    return F.coalesce(value.rlike(ID_PATTERN), F.lit(False))
