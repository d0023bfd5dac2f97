"""Packing an ordered table of requests into size-capped shards, exactly and in parallel.

The rule is greedy and depends on order: a shard is closed when one more row would pass the row cap or
the byte cap; a row over the byte cap gets a shard of its own. A running sum cannot express it, and a
fold over a whole source in one task would not scale. It is a scan of composable functions instead:

1. rows are cut into blocks of their ordinal. For each of the first ``max_rows`` rows of a block, the
   only ones where the first new shard of the block can begin, a task finds where in the next block
   the following one begins, and how many shards lie between;
2. these maps are composed over runs of blocks, and walked from the first row, which gives for each
   run, then for each block, the row where its first shard begins and that shard's number;
3. each block numbers its own rows.

Every group holds at most a block of slim ``(ordinal, bytes)`` rows, or a run of maps. The last block of
a scope needs no map, so scopes that fit in one block, like the files of a corpus, go straight to step 3.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Caps of a shard.
SHARD_MAX_REQUESTS = 10_000
SHARD_MAX_BYTES = 150 * 1024 * 1024

BLOCK_ROWS = 1 << 18
RUN_BLOCKS = 1 << 9


def _next_starts(sizes: np.ndarray, max_rows: int, max_bytes: int) -> np.ndarray:
    """For a shard beginning at each row, the row at which the next one begins."""
    total = np.concatenate(([0], np.cumsum(sizes)))
    rows = np.arange(len(sizes))
    fits = np.searchsorted(total, total[:-1] + max_bytes, side="right") - 1
    return np.maximum(np.minimum(fits, rows + max_rows), rows + 1)


def _follow(nxt: np.ndarray, entries: np.ndarray, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """Walk from each entry until ``stop`` is reached; where that is, and the number of steps."""
    at, steps = entries.copy(), np.zeros(len(entries), dtype=np.int64)
    inside = at < stop
    while inside.any():
        at[inside] = nxt[at[inside]]
        steps[inside] += 1
        inside = at < stop
    return at, steps


def pack_shards(
    df: DataFrame,
    scope: Sequence[str],
    size: str = "n_bytes",
    ordinal: str = "ordinal",
    max_rows: int = SHARD_MAX_REQUESTS,
    max_bytes: int = SHARD_MAX_BYTES,
    block_rows: int = BLOCK_ROWS,
    run_blocks: int = RUN_BLOCKS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Rows ``(scope…, ordinal, shard_no)`` and the slim columns in ``carry``; shards never cross
    ``scope`` and count from zero in it.

    ``ordinal`` must be dense from zero within ``scope`` (see :func:`ordinals.with_ordinal`). ``df`` is
    read more than once: hand in a written table (``session.written``).
    """
    if max_rows > block_rows:
        raise ValueError("a block must be able to hold a full shard")
    scope = [*scope]
    block = F.floor(F.col("_row") / block_rows).cast("bigint")
    slim = df.select(
        *scope,
        F.col(ordinal).cast("bigint").alias("_row"),
        F.col(size).cast("bigint").alias("_size"),
        *carry,
    ).withColumn("_block", block)
    long, longs = T.LongType(), T.ArrayType(T.LongType())

    def schema(*fields: tuple[str, T.DataType]) -> T.StructType:
        rest = [T.StructField(n, t) for n, t in fields]
        return T.StructType([slim.schema[c] for c in scope] + rest)

    # 1. one map per block but the last; it is also shown the first rows of the next block
    blocks = slim.select(*scope, "_block").distinct()
    followed = blocks.where(F.col("_block") > 0).withColumn("_block", F.col("_block") - 1)
    ahead = (F.col("_row") % block_rows < max_rows) & (F.col("_block") > 0)
    here = F.col("_block")
    shown = (
        slim.select(*scope, "_row", "_size", "_block")
        .withColumn("_block", F.explode(F.when(ahead, F.array(here, here - 1)).otherwise(F.array(here))))
        .join(followed, [*scope, "_block"], "left_semi")
    )

    def block_map(key: tuple, rows: pa.Table) -> pa.Table:
        nxt = _next_starts(_sorted(rows, "_row", "_size"), max_rows, max_bytes)
        at, steps = _follow(nxt, np.arange(max_rows), block_rows)
        return _keyed(
            scope, key, 1, _block=[key[-1].as_py()], _exit=[at - block_rows], _steps=[steps]
        )

    maps = (
        shown.groupBy(*scope, "_block")
        .applyInArrow(block_map, schema(("_block", long), ("_exit", longs), ("_steps", longs)))
        .withColumn("_run", F.floor(F.col("_block") / run_blocks).cast("bigint"))
    )

    # 2. compose over runs, walk the runs, then walk the blocks of each run
    def run_map(key: tuple, rows: pa.Table) -> pa.Table:
        at, steps = np.arange(max_rows), np.zeros(max_rows, dtype=np.int64)
        for exits, made in _maps(rows, "_block"):
            steps += made[at]
            at = exits[at]
        return _keyed(scope, key, 1, _run=[key[-1].as_py()], _exit=[at], _steps=[steps])

    runs = maps.groupBy(*scope, "_run").applyInArrow(
        run_map, schema(("_run", long), ("_exit", longs), ("_steps", longs))
    )
    starts = (("_at", long), ("_number", long))
    run_starts = runs.groupBy(*scope).applyInArrow(
        _walk(scope, "_run"), schema(("_run", long), *starts)
    )
    # only the first run, and the first block, have no start: they begin at the first row
    block_starts = (
        maps.join(run_starts, [*scope, "_run"], "left")
        .groupBy(*scope, "_run")
        .applyInArrow(_walk(scope, "_block"), schema(("_block", long), *starts))
    )

    # 3. number the rows of each block
    def numbered(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_row")
        at, number = (rows[c][0].as_py() or 0 for c in ("_at", "_number"))
        nxt = _next_starts(rows["_size"].to_numpy(), max_rows, max_bytes)
        begins = np.zeros(len(nxt), dtype=np.int64)
        while at < len(nxt):
            begins[at] = 1
            at = nxt[at]
        out = rows.select([*scope, "_row", *carry])
        return out.append_column("shard_no", pa.array(number - 1 + np.cumsum(begins)))

    return (
        slim.join(block_starts, [*scope, "_block"], "left")
        .groupBy(*scope, "_block")
        .applyInArrow(
            numbered,
            schema(("_row", long), *[(c, df.schema[c].dataType) for c in carry], ("shard_no", long)),
        )
        .withColumnRenamed("_row", ordinal)
    )


def _sorted(rows: pa.Table, order: str, column: str) -> np.ndarray:
    return rows.sort_by(order)[column].to_numpy()


def _maps(rows: pa.Table, order: str) -> list[tuple[np.ndarray, np.ndarray]]:
    rows = rows.sort_by(order)
    return [
        (exits.values.to_numpy(), made.values.to_numpy())
        for exits, made in zip(rows["_exit"], rows["_steps"])
    ]


def _keyed(scope: list[str], key: tuple, n: int, **columns: list) -> pa.Table:
    """Columns of ``n`` rows behind the scope's values."""
    values = {c: pa.array([k.as_py()] * n, type=k.type) for c, k in zip(scope, key)}
    return pa.table({**values, **{c: pa.array(v) for c, v in columns.items()}})


def _walk(scope: list[str], part: str) -> Callable[[tuple, pa.Table], pa.Table]:
    """Follow maps in the order of ``part`` and give the start of each next one."""

    def walked(key: tuple, rows: pa.Table) -> pa.Table:
        at = number = 0
        if "_at" in rows.column_names:
            at, number = (rows[c][0].as_py() or 0 for c in ("_at", "_number"))
        parts, starts, numbers = [], [], []
        order = rows.sort_by(part)[part].to_pylist()
        for here, (exits, made) in zip(order, _maps(rows, part)):
            number += int(made[at])
            at = int(exits[at])
            parts.append(here + 1)
            starts.append(at)
            numbers.append(number)
        return _keyed(scope, key, len(parts), **{part: parts, "_at": starts, "_number": numbers})

    return walked


def file_shard_id(file_idx: Column, shard_no: Column) -> Column:
    return F.format_string("%04d_%02d", file_idx, shard_no)


def source_shard_id(shard_no: Column) -> Column:
    return F.format_string("%04d", shard_no)


def shard_stats(requests: DataFrame) -> DataFrame:
    return requests.groupBy("shard_id").agg(
        F.count(F.lit(1)).alias("n_requests"), F.sum("n_bytes").alias("n_bytes")
    )


def prepare_totals(requests: DataFrame) -> DataFrame:
    return requests.agg(
        F.count(F.lit(1)).alias("survivors"),
        F.coalesce(F.sum("prompt_chars"), F.lit(0)).alias("total_prompt_chars"),
        F.count_distinct("shard_id").alias("n_shards"),
    )
