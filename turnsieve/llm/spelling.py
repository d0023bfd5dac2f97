"""Groups of spelling variants: words one code point apart, found by probing edits against Bloom filters.

A word's deletions and replacements are made as hashes, not as strings: the hash of a word is a sum of
its code points times a factor for each place, so every edit is one addition. The hashes are tried on
blocked Bloom filters of the vocabulary (blocks of 512 bits), one filter for each length of word. Only edits
that a filter lets through become strings; they are shuffled to an exact join with the vocabulary, which
takes out what the filters let through by chance. An insertion is the other word's deletion, and a
replacement is made from the smaller code point only, so every pair is probed once and then mirrored.

Filters are built in pages of 16 KB, in tasks, and are broadcast in rounds of at most ``ROUND_PAGES`` pages
(32 MB): a larger vocabulary takes more rounds, each with the words of the lengths it needs.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_folder, written
from .common import remove

MIN_LENGTH, MIN_COUNT, TIMES, SLIP = 6, 5, 5, 199

#: For ``bytes.translate`` of Latin-1: lower-cases A-Z, keeps a-z and U+00C0 to U+00FF, makes a space of the rest.
_RUNS = bytes(b if 97 <= b <= 122 or b >= 0xC0 else b + 32 if 65 <= b <= 90 else 0x20 for b in range(256))
_LETTERS = np.array([*range(97, 123), *range(0xC0, 0x100)], dtype=np.uint8)
#: Bytes of a text that are split at a time, words that a task sums up before it passes them on.
_SLICE, _HELD = 1 << 20, 1 << 18

BITS_PER_WORD, PROBES = 16, 7
PAGE_BLOCKS, ROUND_PAGES = 256, 2048
#: Words this long or longer share a filter.
LAST_SHARD = 64
#: Words a probing task takes, and hashes it holds at a time.
TASK_WORDS, _CHUNK = 20_000, 1 << 20


def _slices(low: bytes) -> Iterator[list[bytes]]:
    at = 0
    while at < len(low):
        end = low.find(b" ", at + _SLICE)
        end = len(low) if end < 0 else end
        yield low[at:end].split()
        at = end


def word_counts(key: str | None, text: str | None, min_length: int = MIN_LENGTH, slip: int | None = SLIP) -> Counter[bytes]:
    """Runs of letters of a text in Latin-1, A-Z lower-cased, that keep ``min_length`` code points.

    With ``slip``, a run whose crc32 (of ``key:run``) it divides loses the code point at crc32 % length; not
    where the key is null.
    """
    runs: Counter[bytes] = Counter()
    for part in _slices((text or "").encode("latin-1", "replace").translate(_RUNS)):
        runs.update(part)
    out: Counter[bytes] = Counter()
    head = zlib.crc32(f"{key}:".encode())
    for run, n in runs.items():
        if len(run) < min_length:
            continue
        if slip and key is not None:
            h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), head)
            if h % slip == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
                if len(run) < min_length:
                    continue
        out[run] += n
    return out


def vocabulary(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    slip: int | None = SLIP,
) -> DataFrame:
    """``(word, n)`` of words with at least ``min_count`` occurrences; sums are made in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in total], pa.string())
            batch = pa.record_batch([words, pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return batch

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                total.update(word_counts(key.as_py(), text.as_py(), min_length, slip))
                if len(total) > _HELD:
                    yield out()
        if total:
            yield out()

    slim = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    counts = slim.mapInArrow(run, "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _factors(n: int) -> np.ndarray:
    """An odd factor for each place of a word."""
    return _mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _letters(words: list[bytes], length: int) -> np.ndarray:
    return np.frombuffer(b"".join(words), dtype=np.uint8).reshape(len(words), length)


def _sums(letters: np.ndarray) -> np.ndarray:
    return (letters.astype(np.uint64) * _factors(letters.shape[1])).sum(axis=1, dtype=np.uint64)


def _blocks(sums: np.ndarray, length: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each hash in a filter of so many blocks, and the bits that choose places in it."""
    h = _mixed(sums + np.uint64(length))
    return ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32), _mixed(h)


def _places(block: np.ndarray, bits: np.ndarray, probe: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of a 64-bit cell of the filter and the bit in it."""
    place = (bits >> np.uint64(9 * probe)) & np.uint64(511)
    return (block * np.uint64(8) + (place >> np.uint64(6))).astype(np.int64), np.uint64(1) << (place & np.uint64(63))


def _shard(length: int) -> int:
    return min(length, LAST_SHARD)


def _by_length(words: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths):
        yield int(length), np.flatnonzero(lengths == length)


class Filters:
    """Some pages of the filters: by shard, the blocks of the whole filter, the first page here and the cells from there."""

    def __init__(self, shards: dict[int, tuple[int, int, np.ndarray]]) -> None:
        self.shards = shards

    def passed(self, sums: np.ndarray, length: int) -> np.ndarray:
        """Indices of the hashes that the pages at hand let through."""
        if _shard(length) not in self.shards:
            return np.zeros(0, dtype=np.int64)
        blocks, first, cells = self.shards[_shard(length)]
        block, bits = _blocks(sums, length, blocks)
        low = first * PAGE_BLOCKS
        at = np.flatnonzero((block >= low) & (block < low + len(cells) // 8))
        block, bits = block[at] - np.uint64(low), bits[at]
        for probe in range(PROBES):
            cell, mask = _places(block, bits, probe)
            hit = (cells[cell] & mask) != 0
            at, block, bits = at[hit], block[hit], bits[hit]
            if not len(at):
                break
        return at


def _edits(words: list[bytes], filters: Filters) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """For words of one length: row numbers and edited words that passed."""
    length = len(words[0])
    if not {_shard(length), _shard(length - 1)} & filters.shards.keys():
        return
    for start in range(0, len(words), rows := max(1, _CHUNK // (length * len(_LETTERS)))):
        part = words[start : start + rows]
        letters = _letters(part, length)
        wide, by = letters.astype(np.uint64), _factors(length)
        whole = _sums(letters)
        # places in chunks, so that a very long word holds no more than others
        for low in range(0, length, step := max(1, _CHUNK // (len(part) * len(_LETTERS)))):
            here = letters[:, low : low + step]
            change = (_LETTERS.astype(np.uint64) - here[:, :, None].astype(np.uint64)) * by[low : low + step, None]
            w, p, x = np.nonzero(_LETTERS > here[:, :, None])
            ok = filters.passed(whole[w] + change[w, p, x], length)
            w, p, x = w[ok], p[ok] + low, x[ok]
            made = [part[i][:q] + bytes((c,)) + part[i][q + 1 :] for i, q, c in zip(w, p, _LETTERS[x].tolist(), strict=True)]
            yield start + w, made
        if length > 1:
            before = np.cumsum(wide * by, axis=1, dtype=np.uint64) - wide * by
            moved = wide[:, 1:] * by[:-1]
            after = np.zeros_like(wide)
            after[:, :-1] = moved[:, ::-1].cumsum(axis=1, dtype=np.uint64)[:, ::-1]
            # of equal neighbours the first one's deletion stands for all
            w, p = np.nonzero(np.c_[np.ones(len(part), dtype=bool), letters[:, 1:] != letters[:, :-1]])
            ok = filters.passed((before + after)[w, p], length - 1)
            yield start + w[ok], [part[i][:q] + part[i][q + 1 :] for i, q in zip(w[ok], p[ok], strict=True)]


def _pages(words: DataFrame, blocks: dict[int, int]) -> DataFrame:
    """``(shard, page, bits)``: every page of every filter that holds a word, built by a task from its own words."""

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [w.encode("latin-1") for w in batch.column(0).to_pylist()]
            for length, at in _by_length(texts):
                shard = _shard(length)
                block, bits = _blocks(_sums(_letters([texts[i] for i in at], length)), length, blocks[shard])
                columns = [
                    pa.array(np.full(len(at), shard, dtype=np.int32)),
                    pa.array((block // np.uint64(PAGE_BLOCKS)).astype(np.int32)),
                    pa.array((block % np.uint64(PAGE_BLOCKS)).astype(np.int32)),
                    pa.array(bits.view(np.int64)),
                ]
                yield pa.record_batch(columns, names=["shard", "page", "block", "bits"])

    def build(group: pd.DataFrame) -> pd.DataFrame:
        cells = np.zeros(PAGE_BLOCKS * 8, dtype=np.uint64)
        block, bits = group["block"].to_numpy().astype(np.uint64), group["bits"].to_numpy().view(np.uint64)
        for probe in range(PROBES):
            cell, mask = _places(block, bits, probe)
            np.bitwise_or.at(cells, cell, mask)
        return pd.DataFrame({"shard": [group["shard"].iloc[0]], "page": [group["page"].iloc[0]], "bits": [cells.tobytes()]})

    filed = words.select("word").mapInArrow(file, "shard int, page int, block int, bits bigint")
    return filed.groupBy("shard", "page").applyInPandas(build, "shard int, page int, bits binary")


def _rounds(pages: dict[int, int], size: int) -> Iterator[list[tuple[int, int, int]]]:
    """Ranges ``(shard, first page, end)`` that have at most ``size`` pages together, in order of the shards."""
    now, left = [], size
    for shard, n in sorted(pages.items()):
        at = 0
        while at < n:
            take = min(left, n - at)
            now.append((shard, at, at + take))
            at, left = at + take, left - take
            if not left:
                yield now
                now, left = [], size
    if now:
        yield now


def near_pairs(words: DataFrame, round_pages: int = ROUND_PAGES) -> DataFrame:
    """``(a, n_a, b, n_b)``, once for each two words of ``words`` (written ``word, n``, distinct) one code point apart."""
    spark = words.sparkSession
    length = F.length("word")
    sizes = dict(words.groupBy(F.least(length, F.lit(LAST_SHARD))).agg(F.count(F.lit(1))).collect())  # 64 rows at most
    pages = {s: -(-n * BITS_PER_WORD // (PAGE_BLOCKS * 512)) for s, n in sizes.items()}
    blocks = {s: n * PAGE_BLOCKS for s, n in pages.items()}
    built = written(_pages(words, blocks), "filters")
    tasks = max(spark.sparkContext.defaultParallelism, -(-sum(sizes.values()) // TASK_WORDS))
    other = words.select(F.col("word").alias("b"), F.col("n").alias("n_b"))
    found = None
    for part in _rounds(pages, round_pages):
        shards = {}
        for shard, low, high in part:
            cells = np.zeros((high - low) * PAGE_BLOCKS * 8, dtype=np.uint64)
            for r in built.where((F.col("shard") == shard) & (F.col("page") >= low) & (F.col("page") < high)).toLocalIterator():
                at = (r.page - low) * PAGE_BLOCKS * 8
                cells[at : at + PAGE_BLOCKS * 8] = np.frombuffer(r.bits, dtype=np.uint64)
            shards[shard] = (blocks[shard], low, cells)
        sent = spark.sparkContext.broadcast(shards)

        def probe(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            filters = Filters(sent.value)
            for batch in batches:
                texts = [w.encode("latin-1") for w in batch.column(0).to_pylist()]
                for _, of in _by_length(texts):
                    for at, made in _edits([texts[i] for i in of], filters):
                        if len(at):
                            rows = pa.array(of[at])
                            edited = pa.array([m.decode("latin-1") for m in made], pa.string())
                            columns = [batch.column(0).take(rows), batch.column(1).take(rows), edited]
                            yield pa.record_batch(columns, names=["a", "n_a", "b"])

        first, last = part[0][0], part[-1][0]
        wanted = words.where((length >= first) & ((length <= last + 1) | F.lit(last == LAST_SHARD)))
        edits = wanted.select("word", "n").repartition(tasks, "word").mapInArrow(probe, "a string, n_a bigint, b string")
        exact = written(edits.join(other, "b").select("a", "n_a", "b", "n_b"), "pairs")
        sent.destroy()
        found = exact if found is None else found.union(exact)
    empty = "a string, n_a bigint, b string, n_b bigint"
    return spark.createDataFrame([], empty) if found is None else found


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``(word, form)``: the last form that following forms leads to, by doubling the steps.

    Forms must not run in a circle; here each is ``TIMES`` as frequent as its word, so chains are short.
    """
    path = new_folder(forms.sparkSession, "roots")
    now = written(forms.select("word", F.col("form").alias("root")), "roots", path)
    while now.select(F.col("root").alias("word")).join(now, "word", "left_semi").limit(1).count():
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        old, path = path, new_folder(forms.sparkSession, "roots")
        now = written(step, "roots", path)
        remove(forms.sparkSession, old)
    return now


def variants(words: DataFrame, times: int = TIMES, round_pages: int = ROUND_PAGES) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for each row of a vocabulary ``(word, n)``.

    Words are made of a-z and U+00C0 to U+00FF, as :func:`vocabulary` gives them. Near words differ by one
    inserted, deleted or replaced code point. The form is the most frequent near word (ties: the smallest)
    if it has ``times`` the occurrences of the word, else null; the root is where forms lead to. Words of
    any length are whole; an empty vocabulary gives no rows.
    """
    words = written(words.select("word", "n"), "vocabulary")
    pairs = near_pairs(words, round_pages)
    both = pairs.select(F.col("a").alias("word"), F.col("n_b").alias("m"), F.col("b").alias("near")).union(
        pairs.select(F.col("b").alias("word"), F.col("n_a").alias("m"), F.col("a").alias("near"))
    )
    best = F.min(F.struct((-F.col("m")).alias("less"), F.col("near"))).alias("best")
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    m = -F.col("best.less")
    known = written(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(m >= times * F.col("n"), F.col("best.near")).alias("form"),
            F.when(m >= times * F.col("n"), m).alias("form_n"),
        ),
        "variants",
    )
    last = roots(known.where("form IS NOT NULL"))
    named = known.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return named.select("word", "form", "root", "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **rules) -> DataFrame:
    """:func:`variants` of the :func:`vocabulary` of ``docs``; ``rules`` go to the latter.

    Null and empty texts have no words, repeated rows count again, a null id is no reason to leave a text
    out, and other columns may have any name. No words give no rows.
    """
    return variants(vocabulary(docs, id_col, text_col, **rules))
