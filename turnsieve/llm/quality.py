"""Quality of texts by a factorisation machine.

Inputs are hashed words (their share of the text), statistics of its structure, and its length as the one
piece of metadata that belongs to the text itself. Besides a weight each input has a vector of ``RANK`` numbers; every pair of inputs
interacts by the product of theirs. The sum over all pairs is had in linear time: half of the square of the
sum less the sum of the squares, for each of the ``RANK`` dimensions.

The machine is trained on at most ``SAMPLE`` labelled texts (those with the smallest hash of their id), by
gradient steps on the driver: the bound and the number of inputs, not the corpus, set what it holds. Every
text is scored whole, where it is read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructType

from .toxicity import labelled

SAMPLE, BUCKETS, RANK = 12_000, 1 << 14, 8
EPOCHS, BATCH, RATE, DECAY, SEED = 12, 128, 0.05, 1e-5, 11

STATISTICS = (
    "one", "length", "words", "word_length", "letters", "upper", "digits", "signs", "spaces", "lines", "line_length",
    "short_lines", "distinct", "longest_run", "pairs_repeated", "lines_repeated", "sign_words", "sentence_ends", "upper_words",
    "entropy",
)
_TOKEN = re.compile(r"\S+")
_END = re.compile(r"[.!?]")
_LETTERS = re.compile(r"[^\W\d_]+")


def statistics(text: str, words: list[str], counts: Counter) -> list[float]:
    """Structure of a text, in the order of ``STATISTICS``; shares lie between 0 and 1."""
    n, w = max(1, len(text)), max(1, len(words))
    raw = text.encode("utf-8", "surrogatepass")
    by_byte = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    digits, spaces = int(by_byte[48:58].sum()), int(by_byte[[9, 10, 11, 12, 13, 32]].sum())
    upper = int(by_byte[65:91].sum())
    letters = int(by_byte[65:91].sum() + by_byte[97:123].sum() + by_byte[192:256].sum())
    signs = int(by_byte[33:127].sum()) - digits - int(by_byte[65:91].sum() + by_byte[97:123].sum())
    lines = text.split("\n")
    run = longest = 1
    for a, b in zip(words, words[1:], strict=False):
        run = run + 1 if a == b else 1
        longest = max(longest, run)
    pairs = Counter(zip(words, words[1:], strict=False))
    share = np.fromiter(counts.values(), dtype=float, count=len(counts)) / w
    return [
        1.0,
        np.log1p(len(text)) / 10,
        np.log1p(len(words)) / 8,
        min(1.0, sum(map(len, words)) / w / 15),
        letters / n,
        upper / n,
        digits / n,
        signs / n,
        spaces / n,
        np.log1p(len(lines)) / 5,
        min(1.0, len(text) / len(lines) / 1000),
        sum(len(x) < 20 for x in lines) / len(lines),
        len(counts) / w,
        longest / w,
        1 - len(pairs) / max(1, len(words) - 1),
        1 - len(set(lines)) / len(lines),
        sum(not x[-1].isalnum() for x in words) / w,
        min(1.0, len(_END.findall(text)) / w),
        sum(x.isupper() and len(x) > 1 for x in words) / w,
        float(-(share * np.log(share)).sum() / 10) if len(share) else 0.0,
    ]


def inputs(text: str | None, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and values of a text's inputs: the statistics first, then its hashed words in equal length."""
    text = text or ""
    words = _TOKEN.findall(text)
    counts = Counter(words)
    stats = statistics(text, words, counts)
    low = Counter(_LETTERS.findall(text.lower()))
    at = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) % buckets for w in low), dtype=np.int64, count=len(low))
    value = np.bincount(at, np.sqrt(np.fromiter(low.values(), dtype=float, count=len(low))), minlength=0) if len(at) else np.zeros(0)
    used = np.flatnonzero(value)
    value = value[used]
    norm = np.linalg.norm(value) or 1.0
    return np.r_[np.arange(len(stats)), used + len(stats)], np.r_[stats, value / norm].astype(np.float32)


def raw_score(at: np.ndarray, value: np.ndarray, w: np.ndarray, v: np.ndarray) -> float:
    """Weights, and all pairs by half of (square of the sum less sum of the squares)."""
    x = v[at] * value[:, None]
    s = x.sum(axis=0)
    return float(w[at] @ value + 0.5 * (s @ s - (x * x).sum()))


def train(texts: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and factors by AdaGrad on the logistic loss, in small batches of a fixed order."""
    random = np.random.default_rng(SEED)
    w, v = np.zeros(size), random.normal(0, 0.02, (size, RANK))
    gw, gv = np.full(size, 1e-4), np.full((size, RANK), 1e-4)
    for _ in range(EPOCHS):
        order = random.permutation(len(texts))
        for b in range(0, len(order), BATCH):
            part = [texts[i] for i in order[b : b + BATCH]]
            n = np.array([len(a) for a, _ in part])
            row = np.repeat(np.arange(len(part)), n)
            first = np.cumsum(n) - n
            at, value = np.concatenate([a for a, _ in part]), np.concatenate([x for _, x in part])
            x = v[at] * value[:, None]
            s = np.add.reduceat(x, first)
            z = np.add.reduceat(w[at] * value, first) + 0.5 * ((s * s).sum(axis=1) - np.add.reduceat((x * x).sum(axis=1), first))
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[order[b : b + BATCH]]) / len(part)
            slope = (error[row] * value)[:, None]
            used, inverse = np.unique(at, return_inverse=True)
            dw = np.bincount(inverse, slope[:, 0]) + DECAY * w[used]
            dv = np.zeros((len(used), RANK))
            np.add.at(dv, inverse, slope * (s[row] - x))
            dv += DECAY * v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            w[used] -= RATE * dw / np.sqrt(gw[used])
            v[used] -= RATE * dv / np.sqrt(gv[used])
    return w, v


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality", sample: int = SAMPLE
) -> tuple[np.ndarray, np.ndarray]:
    """``(weights, factors)``. Without labels the weights are 0 and every score is one half; with labels of one
    kind only, scores lean to that kind."""
    known = labelled(docs, labels, label, sample, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, value = zip(*(inputs(t.as_py()) for t in batch.column(1)), strict=True) if batch.num_rows else ((), ())
            columns = [pa.array([a.astype("<i4").tobytes() for a in at], pa.binary()), pa.array([x.tobytes() for x in value], pa.binary())]
            yield pa.record_batch([batch.column(0), *columns], names=["y", "at", "value"])

    size = len(STATISTICS) + BUCKETS
    rows = known.mapInArrow(run, "y int, at binary, value binary").collect()  # at most `sample` rows
    rows.sort(key=lambda r: (r.at, r.value, r.y))  # the same order whatever the tasks were
    texts = [(np.frombuffer(r.at, dtype="<i4").astype(np.int64), np.frombuffer(r.value, dtype=np.float32)) for r in rows]
    y = np.array([r.y > 0 for r in rows], dtype=float)
    if not len(y):
        return np.zeros(size), np.zeros((size, RANK))
    return train(texts, y, size)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in a column ``name``, in place of one of that name.

    Null texts count as empty, and empty ones are scored like any other. Null ids and repeated rows stay, texts of any
    length are read whole, an empty table gives no rows.
    """
    docs = docs.drop(name)
    at = docs.columns.index(text_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, v = sent.value
        for batch in batches:
            z = np.array([raw_score(*inputs(t.as_py()), w, v) for t in batch.column(at)], dtype=float)
            scores = pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))), pa.float64())
            yield pa.record_batch([*batch.columns, scores], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add(name, DoubleType()))
