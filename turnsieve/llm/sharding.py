"""Shards of near-equal bytes by best-fit-decreasing packing; equal texts stay together.

Groups of equal texts are counted and summed; of all of them only a table of their sizes is brought to the
driver. Sizes are rounded up to ``SIGNIFICANT`` bits, so that table has at most ``2 ** SIGNIFICANT`` rows for sizes
below that and half as many for each doubling beyond, however many groups there are. Groups of one size
are alike, so packing places runs of them: by decreasing size, each run fills the bin with the
tightest remaining capacity that takes it, found in a balanced tree. Which group lands where follows from its
number within its size, which is given without gathering a size in one task.
"""

from __future__ import annotations

import random
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import numbered

SHARDS, SIGNIFICANT = 16, 16


class _Node:
    __slots__ = ("key", "priority", "left", "right")

    def __init__(self, key: tuple[int, int], priority: float):
        self.key, self.priority, self.left, self.right = key, priority, None, None


def _split(node: _Node | None, key: tuple[int, int]) -> tuple[_Node | None, _Node | None]:
    """Keys below ``key``, and the others."""
    if node is None:
        return None, None
    if node.key < key:
        node.right, rest = _split(node.right, key)
        return node, rest
    rest, node.left = _split(node.left, key)
    return rest, node


def _join(a: _Node | None, b: _Node | None) -> _Node | None:
    if a is None or b is None:
        return a or b
    if a.priority > b.priority:
        a.right = _join(a.right, b)
        return a
    b.left = _join(a, b.left)
    return b


class Bins:
    """Remaining capacities in a balanced tree (a treap with fixed seeds)."""

    def __init__(self) -> None:
        self.root, self.random = None, random.Random(7)

    def add(self, remaining: int, bin_: int) -> None:
        low, high = _split(self.root, (remaining, bin_))
        self.root = _join(_join(low, _Node((remaining, bin_), self.random.random())), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the least remaining capacity of at least ``size``, with its bin."""
        node, best = self.root, None
        while node:
            if node.key[0] >= size:
                node, best = node.left, node.key
            else:
                node = node.right
        if best:
            low, high = _split(self.root, best)
            _, high = _split(high, (best[0], best[1] + 1))
            self.root = _join(low, high)
        return best


def best_fit_decreasing(
    sizes: Iterable[tuple[int, int]], capacity: int, most: int | None = None
) -> list[tuple[int, int, int, int]] | None:
    """Runs ``(size, first, last, bin)``: the groups of ``size`` with numbers from ``first`` to ``last`` enter ``bin``.

    ``sizes`` holds pairs of a size and how many groups have it. A bin is opened when no open one takes the
    next group; None if that needs more than ``most`` bins, or a group exceeds ``capacity``.
    """
    tree, bins, runs = Bins(), 0, []
    for size, n in sorted(sizes, reverse=True):
        if size > capacity:
            return None
        done = 0
        while done < n:
            found = tree.take_tightest(size)
            if found is None:
                if most is not None and bins == most:
                    return None
                found, bins = (capacity, bins), bins + 1
            fit = min(n - done, found[0] // size) if size else n - done
            runs.append((size, done, done + fit - 1, found[1]))
            done += fit
            tree.add(found[0] - fit * size, found[1])
    return runs


def near_equal(sizes: list[tuple[int, int]], shards: int, precision: float = 1e-4) -> list[tuple[int, int, int, int]]:
    """Runs in ``shards`` bins of nearly equal sums.

    A group larger than an equal share of what is left gets a bin of its own. For the others the least
    capacity is sought, within ``precision`` of the share, with which best-fit-decreasing needs no more bins.
    """
    left = {s: n for s, n in sizes if n}
    runs, own = [], 0
    while left and own < shards - 1:
        largest = max(left)
        if largest * (shards - own) <= sum(s * n for s, n in left.items()):
            break
        alone = min(left[largest], shards - 1 - own)
        runs.append((largest, alone, own))
        left[largest] -= alone
        if not left[largest]:
            del left[largest]
        own += alone
    out = [(size, i, i, bin_ + i) for size, alone, bin_ in runs for i in range(alone)]
    taken = {size: alone for size, alone, _ in runs}
    if left:
        bins, total = shards - own, sum(s * n for s, n in left.items())
        low, high = max(-(-total // bins), max(left)), 2 * (-(-total // bins)) + max(left)
        best = best_fit_decreasing(left.items(), high, bins)
        while high - low > precision * low:
            middle = (low + high) // 2
            found = best_fit_decreasing(left.items(), middle, bins)
            low, high, best = (low, middle, found) if found else (middle + 1, high, best)
        out += [(s, a + taken.get(s, 0), b + taken.get(s, 0), own + bin_) for s, a, b, bin_ in best]
    return out


def _rounded(size: str, significant: int):
    """A size rounded up to so many leading bits."""
    shift = F.greatest(F.lit(0), F.length(F.bin(size)) - significant)
    step = F.pow(F.lit(2), shift).cast("bigint")
    return F.ceil(F.col(size) / step) * step


def shards(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHARDS, significant: int = SIGNIFICANT
) -> DataFrame:
    """Per row ``(id, size, text_crc32, shard, slot)``.

    A size is the text's UTF-8 bytes and one more. Null texts count as empty and form a group with the empty
    ones. ``slot`` numbers a shard's rows from 0; rows that are alike in all of id, size and text take
    whichever of their slots. Null and repeated ids and rows stay; a text longer than a shard's share has a shard as large
    as it is; other columns are left out, whatever their names; an empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    slim = written(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text).cast("bigint") + 1).alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.md5(text)).alias("group"),
        ),
        "sizes",
    )
    groups = slim.groupBy("group").agg(F.sum("size").alias("bytes")).select("group", _rounded("bytes", significant).alias("bytes"))
    groups = written(groups, "groups")
    sizes = groups.groupBy("bytes").agg(F.count(F.lit(1)).alias("n")).collect()
    runs = spark.createDataFrame(near_equal([(r.bytes, r.n) for r in sizes], n), "bytes bigint, first bigint, last bigint, shard int")
    placed = numbered(groups, ["bytes"], ["group"], "number")
    placed = placed.join(runs, "bytes").where((F.col("number") >= F.col("first")) & (F.col("number") <= F.col("last")))
    dealt = slim.join(placed.select("group", "shard"), "group")
    return numbered(dealt, ["shard"], ["id", "size", "group"], "slot").select("id", "size", "text_crc32", "shard", "slot")
