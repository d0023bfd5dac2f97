"""Near-duplicate texts: SimHash fingerprints, linked by a pigeonring filter, joined to components.

Two 64-bit fingerprints that differ in at most ``BITS`` bits, cut into ``SEGMENTS`` segments on a ring,
have a segment from which on the differences of 1, 2, 3 … consecutive segments stay within 1, 2, 3 …
times ``BITS / SEGMENTS`` (the strong pigeonring principle, Qin and Xiao 2018). With four bits and five
segments the budgets of such a chain are 0, 1, 2, 3, 4. The first two steps are an exact key: a row is
filed under (start, segment, next segment), and under the next segment with one of its set bits cleared;
any two fingerprints whose chain starts there meet under one key. Steps three and four prune what
met, the fifth is the full distance.

Equal fingerprints are one node, so copies cost nothing. Keys with more than ``BLOCK`` rows are dealt
into blocks and every pair of blocks is a group of its own: no row is dropped and no task holds more than
two blocks. Inside a group links are grown as a spanning forest, never as all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .components import components

BITS, SEGMENTS, SHINGLE, SEED = 4, 5, 4, 42
BLOCK = 4096
#: First bit of each segment, and 64.
EDGES = tuple(round(64 * i / SEGMENTS) for i in range(SEGMENTS + 1))
_BUDGET = tuple(BITS * (i + 1) // SEGMENTS for i in range(SEGMENTS))
_KEY_BITS = 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text; 0 where it has no words. Counted in blocks of shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z, and ASCII white space
    if not words:
        return 0
    grams = (
        list(map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)))
        if len(words) >= shingle
        else [b" ".join(words)]
    )
    digest, ones = xxhash.xxh64_digest, np.zeros(64, dtype=np.int64)
    for i in range(0, len(grams), 1 << 16):
        block = b"".join([digest(g, SEED) for g in grams[i : i + (1 << 16)]])
        ones += np.unpackbits(np.frombuffer(block, dtype=np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(grams)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(id, fp)`` per row; null, empty and blank texts have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(fps, pa.int64())], names=["id", "fp"])

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, f"id {dict(slim.dtypes)['id']}, fp bigint")


def _segment(fp: np.ndarray, i: int) -> np.ndarray:
    low, high = EDGES[i], EDGES[i + 1]
    return (fp >> np.uint64(64 - high)) & np.uint64((1 << (high - low)) - 1)


def _keys(fp: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Own keys, one array for each start, and those with one set bit of the next segment cleared."""
    own, cleared = [], []
    for i in range(SEGMENTS):
        j = (i + 1) % SEGMENTS
        following = _segment(fp, j)
        head = (np.uint64(i) << np.uint64(2 * _KEY_BITS)) | (_segment(fp, i) << np.uint64(_KEY_BITS))
        own.append(head | following)
        for b in range(EDGES[j + 1] - EDGES[j]):
            bit = np.uint64(1 << b)
            has = (following & bit) != 0
            cleared.append(np.where(has, head | (following & ~bit), np.uint64(1 << 63)))
    return own, cleared


def _filed(nodes: DataFrame, probes: bool = True) -> DataFrame:
    """``(key, fp)``: each fingerprint under its own keys and, with ``probes``, its cleared ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 8192):
                fp = batch.column(0).slice(part, 8192).to_numpy(zero_copy_only=False).view(np.uint64)
                own, cleared = _keys(fp)
                lists = own + (cleared if probes else [])
                key = np.concatenate(lists).view(np.int64)
                keep = key >= 0
                yield pa.record_batch(
                    [pa.array(key[keep]), pa.array(np.tile(fp, len(lists)).view(np.int64)[keep])], names=["key", "fp"]
                )

    return nodes.select("fp").mapInArrow(run, "key bigint, fp bigint")


def _hot(nodes: DataFrame, block: int) -> DataFrame:
    """``(key, blocks)`` of keys that may hold more than ``block`` rows.

    Rows of a key are those filed there as their own and those of its neighbours with one more bit. Only
    neighbours with a share of the block count, so few keys are looked at; a key under it stays whole.
    """
    width = EDGES[1] - EDGES[0]
    own = _filed(nodes, probes=False).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block // (2 * width))
    bits = F.array(*[F.lit(1 << b) for b in range(width)])
    near = own.select(F.explode(bits).alias("bit"), "key", "n").where(F.col("key").bitwiseAND(F.col("bit")) != 0)
    near = near.select(F.col("key").bitwiseXOR(F.col("bit")).cast("bigint").alias("key"), "n")
    total = own.select("key", "n").union(near).groupBy("key").agg(F.sum("n").alias("n"))
    return total.where(F.col("n") > block).select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))


def _masks() -> np.ndarray:
    """For each start, the bits of its first 3, 4, … segments."""
    out = np.zeros((SEGMENTS, SEGMENTS), dtype=np.uint64)
    for i in range(SEGMENTS):
        bits = 0
        for step in range(SEGMENTS):
            j = (i + step) % SEGMENTS
            bits |= ((1 << (EDGES[j + 1] - EDGES[j])) - 1) << (64 - EDGES[j + 1])
            out[i, step] = bits
    return out


def _chained(a: np.ndarray, b: np.ndarray, start: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Indices of the pairs whose chains stay within every budget; the last budget is the distance."""
    at = np.arange(len(a))
    for step in range(1, SEGMENTS):
        d = np.bitwise_count((a[at] ^ b[at]) & masks[start[at], step])
        at = at[d <= _BUDGET[step]]
        if not len(at):
            break
    return at


def _forest(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join whatever is linked inside one group: each row looks once at those not yet reached."""
    rest, ends = np.unique(fp), []
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = np.bitwise_count(rest ^ x) <= BITS
            if near.any():
                found = rest[near]
                ends.append((np.full(len(found), x), found))
                queue.extend(found)
                rest = rest[~near]
    if not ends:
        return fp[:0], fp[:0]
    return np.concatenate([e[0] for e in ends]), np.concatenate([e[1] for e in ends])


#: Groups up to this size are compared side by side in whole arrays, larger ones one by one.
_SMALL = 24


def _link(key: np.ndarray, group: np.ndarray, fp: np.ndarray, masks: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links within groups of consecutive rows."""
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, dtype=np.int64)
    size = np.diff(np.r_[first, len(group)])
    out = [_forest(fp[f : f + n]) for f, n in zip(first[size > _SMALL], size[size > _SMALL], strict=True)]
    left = np.repeat(np.where(size <= _SMALL, first + size, 0), size)  # end of the row's group
    at = np.flatnonzero(left)
    for d in range(1, _SMALL):
        at = at[at + d < left[at]]
        if not len(at):
            break
        a, b = fp[at], fp[at + d]
        ok = _chained(a, b, (key[at] >> (2 * _KEY_BITS)).astype(np.int64), masks)
        out.append((a[ok], b[ok]))
    return out


def links(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(a, b)``: links between distinct fingerprints of ``nodes``, enough to join all that are linked."""
    filed = _filed(nodes).join(_hot(nodes, block), "key", "left")
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda x: F.least(x, mine.cast("int")) * F.lit(1 << 20) + F.greatest(x, mine.cast("int")),
    )
    cells = filed.select(
        "key", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(pairs)).alias("cell"), "fp"
    )
    rows = cells.repartition("key", "cell").sortWithinPartitions("key", "cell")
    masks = _masks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None
        for batch in _with_end(batches):
            if batch is not None:
                now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
                kept = now if kept is None else [np.concatenate(x) for x in zip(kept, now, strict=True)]
            if kept is None or not len(kept[0]):
                continue
            key, cell, fp = kept
            cut = len(key)
            if batch is not None:  # the last group may go on
                same = (key == key[-1]) & (cell == cell[-1])
                cut = int(np.argmax(same))
            group = np.cumsum(np.r_[True, (key[1:cut] != key[: cut - 1]) | (cell[1:cut] != cell[: cut - 1])]) if cut else key[:0]
            found = _link(key[:cut], group, fp[:cut].view(np.uint64), masks)
            kept = [x[cut:] for x in kept]
            for a, b in found:
                if len(a):
                    yield pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return rows.mapInArrow(run, "a bigint, b bigint")


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, block: int = BLOCK
) -> DataFrame:
    """``(id, fp, component)`` per row of ``docs``; the component is the smallest id reachable by links.

    Rows with a null id have a fingerprint and their component's smallest other id (null if there is
    none). Repeated rows stay repeated. Texts of any length are counted whole, in blocks of shingles. Other columns are
    left out, whatever their names; an empty table gives no rows.
    """
    prints = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links(nodes, block)).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.join(names, "root").select("fp", "component")
    return prints.join(named, "fp").select("id", "fp", "component")


def hex_of(fp: str = "fp"):
    """Sixteen lower-case hex digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))

