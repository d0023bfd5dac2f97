"""Exact centroid clustering with heap-ordered bounds (Hamerly and Drake, 2015).

A vector's gap is the distance to its second nearest centroid less that to its nearest. When centroids
move, the gap of a vector of cluster c shrinks by no more than the drift of c and the largest drift of any
other. Those sums are kept per cluster, and a vector enters its cluster's heap under its gap plus the sum
so far: it may change its cluster only once the sum has reached that key. In a round the expired tops of the
heaps are popped and exactly rescanned; no other vector is touched.

Vectors lie in blocks, each a row with its integers and its heaps. A block goes through a round by itself, so
tasks need no shuffle and hold one block of ``BLOCK`` vectors beside the centroids. What leaves a block is the
change of its clusters' sums and counts, added up in Spark to ``k`` rows of numbers for the driver. Every
round's blocks are written to the shared folder before the round before is removed.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import new_folder, written
from .common import remove

K, ROUNDS, DIMS, SCALE, SALT = 40, 5, 64, 256, "2:"
BLOCK = 16_384
#: Squared length, in integers, up to which every squared distance fits a BIGINT.
LONGEST = 2.0**60
#: Share by which bounds are drawn in, far above what rounding can take from them.
_MARGIN = 1e-9


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact, of every row of ``x`` to every centroid; through floating point only where that is exact."""
    x = x.astype(np.int64)
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if x.shape[1] * top * top < 1 << 52:
        dot = (x.astype(np.float64) @ centroids.T.astype(np.float64)).astype(np.int64)
    else:
        dot = x @ centroids.T
    return (x * x).sum(axis=1)[:, None] - 2 * dot + (centroids * centroids).sum(axis=1)


@dataclass
class Block:
    """Vectors with their clusters and, for each cluster, a heap of ``(key, row)``."""

    x: np.ndarray
    cluster: np.ndarray
    heaps: list[list[tuple[float, int]]]

    @classmethod
    def new(cls, x: np.ndarray, k: int) -> Block:
        """Every vector waits in the first heap under the smallest key, in no cluster yet."""
        first = [(-np.inf, i) for i in range(len(x))]
        return cls(x, np.full(len(x), -1, dtype=np.int32), [first, *([] for _ in range(k - 1))])

    def expired(self, drifted: np.ndarray) -> np.ndarray:
        rows = []
        for heap, limit in zip(self.heaps, drifted.tolist(), strict=True):
            while heap and heap[0][0] <= limit:
                rows.append(heapq.heappop(heap)[1])
        return np.array(sorted(rows), dtype=np.int64)

    def step(self, centroids: np.ndarray, drifted: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Assign the expired vectors: the change of the clusters' sums and counts, and how many were rescanned."""
        sums, counts = np.zeros(centroids.shape, dtype=np.int64), np.zeros(len(centroids), dtype=np.int64)
        rows = self.expired(drifted)
        if not len(rows):
            return sums, counts, 0
        x = self.x[rows].astype(np.int64)
        d = squared_distances(x, centroids)
        best, at = d.argmin(axis=1).astype(np.int32), np.arange(len(rows))
        upper = np.sqrt(d[at, best].astype(np.float64))
        d[at, best] = np.iinfo(np.int64).max
        lower = np.sqrt(d.min(axis=1).astype(np.float64)) if len(centroids) > 1 else np.full(len(rows), np.inf)
        gap = lower - upper - _MARGIN * (lower + upper + 1)
        gap[np.isnan(gap)] = np.inf  # one centroid only
        for c, key, row in zip(best.tolist(), (gap + drifted[best]).tolist(), rows.tolist(), strict=True):
            heapq.heappush(self.heaps[c], (key, row))
        old = self.cluster[rows]
        moved = old != best
        np.add.at(sums, best[moved], x[moved])
        np.add.at(counts, best[moved], 1)
        left = moved & (old >= 0)
        np.subtract.at(sums, old[left], x[left])
        np.subtract.at(counts, old[left], 1)
        self.cluster[rows] = best
        return sums, counts, len(rows)

    def distances(self, centroids: np.ndarray) -> np.ndarray:
        apart = self.x.astype(np.int64) - centroids[self.cluster]
        return (apart * apart).sum(axis=1)


def _kept(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """``(id, x)`` with ``x`` as whole numbers, of vectors that have ``dims`` finite components."""
    e = F.col(vector_col).cast("array<double>")
    finite = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    x = F.transform(e, lambda v: F.floor(v * F.lit(float(scale))))
    squares = F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    whole = vectors.where((F.size(e) == dims) & finite).select(F.col(id_col).alias("id"), x.alias("x"))
    return whole.where(squares < LONGEST)


def _first(kept: DataFrame, k: int, salt: str, dims: int) -> np.ndarray:
    """The vectors whose salted ids have the smallest digests, in that order."""
    digest = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    rows = kept.where("id IS NOT NULL").select(digest.alias("digest"), "x").orderBy("digest", "x").limit(k).collect()
    return np.array([r.x for r in rows], dtype=np.int64).reshape(len(rows), dims)


def _narrow(x: np.ndarray) -> np.ndarray:
    """In the smallest integers that hold all values."""
    return next(y for t in ("<i2", "<i4", "<i8") if np.array_equal(y := x.astype(t), x))


_STATE = "x binary, width int, cluster binary, key binary, row binary, heap array<int>"


def _row(ids: pa.Array, block: Block, *more: tuple[str, pa.Array]) -> pa.RecordBatch:
    entries = [e for heap in block.heaps for e in heap]
    columns = {
        "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
        "x": pa.array([block.x.tobytes()], pa.binary()),
        "width": pa.array([block.x.itemsize], pa.int32()),
        "cluster": pa.array([block.cluster.astype("<i4").tobytes()], pa.binary()),
        "key": pa.array([np.array([e[0] for e in entries], dtype="<f8").tobytes()], pa.binary()),
        "row": pa.array([np.array([e[1] for e in entries], dtype="<i4").tobytes()], pa.binary()),
        "heap": pa.array([[len(h) for h in block.heaps]], pa.list_(pa.int32())),
    } | dict(more)
    return pa.RecordBatch.from_pydict(columns)


def _blocks(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[pa.Array, Block]]:
    """Blocks of written rows; a list that was a heap when written is a heap when read."""
    at = {n: batch.column(n) for n in ("ids", "x", "width", "cluster", "key", "row", "heap")}
    for i in range(batch.num_rows):
        x = np.frombuffer(at["x"][i].as_buffer(), dtype=f"<i{at['width'][i].as_py()}").reshape(-1, dims)
        keys = np.frombuffer(at["key"][i].as_buffer(), dtype="<f8").tolist()
        rows = np.frombuffer(at["row"][i].as_buffer(), dtype="<i4").tolist()
        ends = np.cumsum([0, *at["heap"][i].as_py()])
        entries = list(zip(keys, rows, strict=True))
        heaps = [entries[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        yield at["ids"][i].values, Block(x, np.frombuffer(at["cluster"][i].as_buffer(), dtype="<i4").copy(), heaps)


def _filed(kept: DataFrame, k: int, dims: int, block: int) -> DataFrame:
    """One row for each block of a task's vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, n = [], [], 0

        def out() -> pa.RecordBatch:
            return _row(pa.concat_arrays(ids), Block.new(_narrow(np.concatenate(parts)), k))

        for batch in batches:
            for start in range(0, batch.num_rows, block):
                part = batch.slice(start, block)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.int64)
                at = 0
                while at < len(x):
                    take = min(block - n, len(x) - at)
                    ids.append(part.column(0).slice(at, take))
                    parts.append(x[at : at + take])
                    at, n = at + take, n + take
                    if n == block:
                        yield out()
                        ids, parts, n = [], [], 0
        if n:
            yield out()

    return kept.mapInArrow(run, f"ids array<{dict(kept.dtypes)['id']}>, {_STATE}")


def _stepped(state: DataFrame, centroids: np.ndarray, drifted: np.ndarray, dims: int) -> DataFrame:
    """Blocks after a round, with the changes of the sums and counts and the number of rescanned vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, block in _blocks(batch, dims):
                sums, counts, rescanned = block.step(centroids, drifted)
                change = pa.array([np.c_[sums, counts].ravel()], pa.list_(pa.int64()))
                yield _row(ids, block, ("change", change), ("rescanned", pa.array([rescanned], pa.int64())))

    columns = state.select("ids", *[c.split()[0] for c in _STATE.split(", ")])
    return columns.mapInArrow(run, f"ids {dict(state.dtypes)['ids']}, {_STATE}, change array<bigint>, rescanned bigint")


def _drift(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """For each cluster, the most that the gap of one of its vectors can have shrunk."""
    moved = np.sqrt(((new - old) ** 2).sum(axis=1).astype(np.float64)) * (1 + _MARGIN)
    others = np.array([np.delete(moved, c).max(initial=0.0) for c in range(len(moved))])
    return (moved + others) * (1 + _MARGIN)


def cluster(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    scale: int = SCALE,
    salt: str = SALT,
    block: int = BLOCK,
) -> DataFrame:
    """``(id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` for each vector that is kept.

    Components become ``floor(scale * x)``; all sums, means and distances are exact integers. Vectors that are null,
    have another number of components, or hold null or non-finite ones are left out, as are those longer than
    2^30 in integers, whose squared distances no BIGINT holds. The first centroids are the ``k`` vectors with
    the smallest digests of salt and id (equal digests: the smaller vector; null ids never), fewer if there
    are fewer; without any there are no rows. Ties of distances go to the smaller number, empty clusters keep
    their centroid. Repeated rows are vectors of their own; other columns may have any name.
    """
    spark = vectors.sparkSession
    kept = _kept(vectors, id_col, vector_col, dims, scale)
    centroids = _first(kept, k, salt, dims)
    n = len(centroids)
    out = f"id {dict(kept.dtypes)['id']}, cluster int, distance bigint"
    if not n:
        none = spark.createDataFrame([], out)
        return none.select("*", *[F.lit(0).cast("bigint").alias(c) for c in ("cluster_inertia", "inertia")], F.lit("").alias("centroid_sha256"))
    path = new_folder(spark, "blocks")
    state = written(_filed(kept, n, dims, block), "blocks", path)
    drifted, total = np.zeros(n), np.zeros((n, dims + 1), dtype=np.int64)
    for step in range(rounds + 1):
        old, path = path, new_folder(spark, "blocks")
        state = written(_stepped(state, centroids, drifted, dims), "blocks", path)
        remove(spark, old)
        if step == rounds:
            break
        change = state.select(F.posexplode("change").alias("at", "by")).groupBy("at").agg(F.sum("by").alias("by"))
        for r in change.collect():  # k * (dims + 1) numbers
            total[r.at // (dims + 1), r.at % (dims + 1)] += r.by
        counts, new = total[:, dims], centroids.copy()
        new[counts > 0] = total[counts > 0, :dims] // counts[counts > 0, None]
        drifted, centroids = drifted + _drift(centroids, new), new

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, b in _blocks(batch, dims):
                yield pa.record_batch(
                    [ids, pa.array(b.cluster), pa.array(b.distances(centroids))], names=["id", "cluster", "distance"]
                )

    rows = written(state.select("ids", *[c.split()[0] for c in _STATE.split(", ")]).mapInArrow(last, out), "clusters")
    remove(spark, path)
    inertia = dict(rows.groupBy("cluster").agg(F.sum("distance")).collect())  # k rows
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def of(values: list) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)

    return rows.select(
        "id",
        "cluster",
        "distance",
        of([inertia.get(c, 0) for c in range(n)]).cast("bigint").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("bigint").alias("inertia"),
        of(digests).alias("centroid_sha256"),
    )
