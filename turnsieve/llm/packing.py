"""Token sequences of one length with little padding, by Karmarkar-Karp multiway differencing.

A text's token ids and the end id are cut freely: whole sequences are cut off first and need no partner.
What is left is cut into powers of two from ``LEAST`` tokens up and one remainder, so that imbalances can
cancel, and gathered into pools of ``WINDOWS`` sequences. Each pool is spread over its windows by
differencing: the two partial partitions with the largest imbalance are merged so that large sums of
one meet small sums of the other. The sums end about a token apart; a pool leaves ``SLACK`` tokens free
for that. Where the largest sum still exceeds the capacity, the pool is partitioned again with one
window more. Measured padding is about a thousandth.

Every task packs what it reads, in the order in which it reads it, so nothing is shuffled, and a task run
again gives the same sequences. A task holds one Arrow batch and one pool.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY, WINDOWS, LEAST, SLACK, END = 1024, 64, 16, 64, 0
#: Sequence numbers of one task lie in a range of this width.
PER_TASK = 1 << 33
CACHED_WORDS = 300_000


class _Spaced(Exception):
    """A word with white space at its edge: the text can't be cut at single spaces."""


class Encoder(dict):
    """Ids of texts as little-endian 32-bit integers, equal to those of the vocabulary's tokenizer file.

    The pre-tokenizer always ends a token before a single space between two visible characters, so a
    text is cut there and each word encoded once and remembered. A text with other white space beside a
    space is encoded whole. One that holds the special token's string goes through the tokenizer file.
    The memory is emptied when it holds ``CACHED_WORDS`` words.
    """

    def __init__(self, vocabulary: str | None = None):
        import public_tokenizers
        import tiktoken

        self.file = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
        with open(self.file.removesuffix(".json") + ".tiktoken", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding(
            "bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self.exact = None

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace() or word[-1].isspace():
            raise _Spaced
        ids = np.array(self.encode(" " + word), dtype="<u4").tobytes()
        if len(self) >= CACHED_WORDS:
            self.clear()
        if len(word) < 40:
            self[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if "<|endoftext|>" in text:
            if self.exact is None:
                from tokenizers import Tokenizer

                self.exact = Tokenizer.from_file(self.file)
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        first, *words = text.split(" ")
        if words and first and not first[-1].isspace():
            try:
                return np.array(self.encode(first), dtype="<u4").tobytes() + b"".join(map(self.__getitem__, words))
            except _Spaced:
                pass
        return np.array(self.encode(text), dtype="<u4").tobytes()


def _merged(a: list, b: list, k: int) -> list:
    """Two partial partitions of at most ``k`` windows as one; both lists are sorted, largest sum first."""
    over = len(a) + len(b) - k
    if over <= 0:
        out = a + b
    else:
        keep_a, keep_b = len(a) - over, len(b) - over
        pairs = zip(a[keep_a:], reversed(b[keep_b:]), strict=True)
        out = a[:keep_a] + b[:keep_b] + [(x + y, (p, q)) for (x, p), (y, q) in pairs]
    out.sort(key=lambda w: -w[0])
    return out


def _flat(tree: object) -> list[int]:
    out, stack = [], [tree]
    while stack:
        x = stack.pop()
        if isinstance(x, tuple):
            stack.extend(x)
        else:
            out.append(x)
    return sorted(out)


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Indices of ``sizes`` in at most ``k`` windows with nearly equal sums."""
    heap = [(-s, i, [(s, i)]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    n = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heap[0]
        both = _merged(a, b, k)
        n += 1
        heapq.heapreplace(heap, ((both[-1][0] if len(both) == k else 0) - both[0][0], n, both))
    return [_flat(w[1]) for w in heap[0][2]] if heap else []


def windows_of(sizes: list[int], capacity: int) -> list[list[int]]:
    """As few near-equal windows as differencing fills without exceeding ``capacity``."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        found = differencing(sizes, k)
        if all(sum(sizes[i] for i in w) <= capacity for w in found):
            return found
        k += 1


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    windows: int = WINDOWS,
    least: int = LEAST,
    slack: int = SLACK,
) -> DataFrame:
    """Pieces: ``(id, start, length, ids, doc_tokens, sequence_id, offset)``.

    ``ids`` holds the piece's token ids, four little-endian bytes each. A null text counts as empty and
    has the end id alone; null and repeated ids are packed like others. A text of any length is cut into as many pieces
    as it needs. Other columns are left out, whatever their names; an empty table gives no rows.
    """
    room = windows * capacity - slack

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sequence = Encoder(vocabulary), TaskContext.get().partitionId() * PER_TASK
        end = np.array([END], dtype="<u4").tobytes()
        pool: list[tuple] = []
        held = 0
        out: list[tuple] = []

        def emit(members: list[tuple]) -> None:
            nonlocal sequence
            offset = 0
            for doc, start, ids, total in members:
                out.append((doc, start, len(ids) // 4, ids, total, sequence, offset))
                offset += len(ids) // 4
            sequence += 1

        def spread() -> None:
            nonlocal held
            for window in windows_of([len(p[2]) // 4 for p in pool], capacity):
                emit([pool[i] for i in window])
            pool.clear()
            held = 0

        def table() -> pa.RecordBatch:
            arrays = [pa.array(c) for c in zip(*out, strict=True)]
            arrays[0] = arrays[0].cast(kind)
            arrays[3] = arrays[3].cast(pa.binary())
            out.clear()
            return pa.record_batch(arrays, names=names)

        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.ids(text.as_py() or "") + end
                total, start = len(ids) // 4, 0
                while total - start >= capacity:
                    emit([(doc, start, ids[4 * start : 4 * (start + capacity)], total)])
                    start += capacity
                while start < total:
                    n = min(total - start, room - held)
                    n = 1 << (n.bit_length() - 1) if n >= least else n
                    pool.append((doc, start, ids[4 * start : 4 * (start + n)], total))
                    start, held = start + n, held + n
                    if held >= room:
                        spread()
                if len(out) >= 4096:
                    yield table()
        spread()
        if out:
            yield table()

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kinds = f"id {dict(slim.dtypes)['id']}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    names = [k.split()[0] for k in kinds.split(", ")]
    return slim.mapInArrow(run, kinds)


def digest(pieces: DataFrame, name: str = "doc_id") -> DataFrame:
    """Pieces with the CRC-32 of their ids in their place."""
    return pieces.select(
        F.col("id").alias(name), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
