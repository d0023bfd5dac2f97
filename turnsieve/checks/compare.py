"""Compare a query with its SQL counterpart by value."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

#: Tables of the checks.
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _plain(value: object) -> object:
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (int, float, Decimal)):
        number = float(value)
        return None if math.isnan(number) else round(number, 5)
    return str(value)


def rows_of(names: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(names: list[str], rows: list[tuple], sql_names: list[str], sql_rows: list[tuple]) -> str | None:
    """What differs, or None."""
    if sorted(names) != sorted(sql_names):
        return f"columns {sorted(names)} and {sorted(sql_names)}"
    mine, theirs = rows_of(names, rows), rows_of(sql_names, sql_rows)
    if mine == theirs:
        return None
    return (
        f"{sum(mine.values())} and {sum(theirs.values())} rows; "
        f"only here {list((mine - theirs).elements())[:2]}; only in SQL {list((theirs - mine).elements())[:2]}"
    )
