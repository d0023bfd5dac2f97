"""Toxic texts, also when disguised: noisy-channel restoration before scoring.

A character language model (trigrams, interpolated) is counted over all texts. Words that look disguised
(look-alike signs before a letter or one or two at the word's end, letters spaced out, signs repeated three times or
more) become a lattice: every sign may stand for the letters it resembles, a sign at the end also for itself,
separators and repetitions may be nothing, masks any letter (up to ``MASKS`` in a row, in words with up to
``MASKED_ROWS`` such rows; more are no censored word, and masks are separators there). The best path
under channel costs and the language model is the restored word. Scores use the words of the text and the
restored ones.

Viterbi's states are the last two letters of a path. Where all paths agree on those, what lies before is decided
and written out, so a token of any length takes linear time and little memory. A stretch of ``LATTICE`` signs
without such a place is decided at its end.

What is toxic is learnt from labelled texts: words and word beginnings that occur far more often under
label 1. A text's evidence (its strongest feature, how many different words carry one) goes through a
logistic fit. All labelled rows are learnt from: their words are counted, and the fit's sums made, where they lie.
At most ``FEATURES`` features are used, a bound on the classifier only; every text is restored and scored whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from ..session import new_folder, remove, written

FEATURES, SUPPORT, EVIDENCE = 20_000, 5, 2.0
BEGINNINGS = (4, 5, 6)
#: Features that a task counts before it hands them on.
COUNTED = 100_000
#: Logarithms of how many bits tell labelled ids apart: of a chunk of them, and of all at most (8 MB).
CHUNK, MARKS = 15, 26

#: Letters the language model tells apart; others share the last code, 0 is a word's edge.
LETTERS = "abcdefghijklmnopqrstuvwxyzàâäáãåæçèéêëìíîïñòóôöõøœùúûüýÿß"
CODES = len(LETTERS) + 2
_CODE = {c: i + 1 for i, c in enumerate(LETTERS)}

#: Signs and the letters they are used for.
LOOKS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
SEPARATORS = " .-_*'"
SIGN_COST, SEPARATOR_COST, MASK_COST, REPEAT_COST, KEPT_COST = 0.7, 0.2, 2.5, 0.4, 4.0
MASKS, MASKED_ROWS, LATTICE = 3, 8, 4096
#: Signs that stand for a letter at a word's end and in series, where the others are punctuation.
ENDINGS = "0123456789@$€£"

_SPACED = re.compile(r"(?:[^\W_]|[@$€£])(?:[ .\-_*]{1,3}(?:[^\W_]|[@$€£])){2,}(?![\w@$€£])")
_WORD = re.compile(r"[^\W\d_]+")
_MASKS = re.compile(r"\*+")


def _table() -> np.ndarray:
    """Code of each character of the basic plane in the language model."""
    codes = np.zeros(1 << 16, dtype=np.int64)
    for i in range(1 << 16):
        if chr(i).isalpha():
            codes[i] = _CODE.get(chr(i).lower()[0], CODES - 1)
    return codes


def _kinds() -> np.ndarray:
    """Bits of each character of the basic plane: letter 1, look-alike sign 2, separator 4, mask 8, white space 16, digit
    or other sign for a letter in a series 32, sign that counts at a word's end 64."""
    kinds = np.zeros(1 << 16, dtype=np.uint8)
    for i in range(1 << 16):
        c = chr(i)
        kinds[i] = c.isalpha() | (c in LOOKS) << 1 | (c in " .-_*") << 2 | (c in "*-_.") << 3 | c.isspace() << 4 | (c.isdigit() or c in "@$€£") << 5 | (c in ENDINGS) << 6
    return kinds


def disguised(low: str, kinds: np.ndarray) -> set[str]:
    """The words of a lower-cased text that may be disguised.

    Words up to white space with a sign before a letter, one or two signs between a letter and the next other
    character, one letter three times, or a mask between two letters; and series of three or more single letters,
    digits or signs with one to three separators between each two.
    """
    raw = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kind = kinds[np.minimum(raw, 0xFFFF)]
    n = len(kind)
    if n < 3:
        return set()
    letter, sign, apart = kind & 1, (kind >> 1) & 1, (kind >> 2) & 1
    odd = np.zeros(n, dtype=bool)
    odd[:-1] |= (sign[:-1] & letter[1:]).astype(bool)
    odd[:-2] |= (raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2]) & (letter[:-2] > 0)
    odd[:-2] |= (letter[:-2] & (kind[1:-1] >> 3) & letter[2:]).astype(bool)
    ending = np.r_[(kind >> 6) & 1, 0, 0].astype(bool)
    odd[:-1] |= (letter[:-1] > 0) & ending[1:n] & ~(ending[2 : n + 1] & ending[3 : n + 2])
    out = set()
    at = np.flatnonzero(odd)
    if len(at):
        space = np.flatnonzero(kind & 16)
        edges = np.r_[-1, space, n]
        words = np.unique(np.searchsorted(space, at))
        out = {low[edges[w] + 1 : edges[w + 1]] for w in words.tolist()}
    if n >= 5:
        at = np.flatnonzero(~(apart & np.r_[0, apart[:-1]]).astype(bool))  # of separators in a row the first
        single, apart = (((kind & 1) | (kind >> 5)) & 1)[at], apart[at]
        if len(at) >= 5:
            before = np.r_[0, single[:-1]][: len(at) - 4]
            spaced = single[:-4] & apart[1:-3] & single[2:-2] & apart[3:-1] & single[4:] & (1 - before)
            end = 0
            for i in at[np.flatnonzero(spaced)].tolist():
                if i >= end and (m := _SPACED.match(low, i)):
                    out |= {m.group(), re.sub(r"[ .\-_*]", "", m.group())}  # apart, and as one word
                    end = m.end()
    return out


def character_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Trigrams of characters over all texts: an array of ``CODES`` x ``CODES`` x ``CODES`` counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = _table(), np.zeros(CODES**3, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                raw = np.frombuffer(f"  {text.as_py() or ''} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
                code = table[np.minimum(raw, 0xFFFF)]
                code = code[(code > 0) | np.r_[True, code[:-1] > 0] | np.r_[code[1:] > 0, True]]  # two edges at most
                total += np.bincount((code[:-2] * CODES + code[1:-1]) * CODES + code[2:], minlength=CODES**3)
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen), pa.array(total[seen])], names=["gram", "n"])

    grams = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "gram bigint, n bigint")
    counts = np.zeros(CODES**3, dtype=np.int64)
    for r in grams.groupBy("gram").agg(F.sum("n").alias("n")).collect():  # at most CODES ** 3 rows
        counts[r.gram] = r.n
    return counts.reshape(CODES, CODES, CODES)


def language_model(counts: np.ndarray) -> np.ndarray:
    """Log probability of a character after two others, smoothed by pairs and single characters."""
    one = counts.sum(axis=(0, 1)) + 1.0
    one /= one.sum()
    two = counts.sum(axis=0) + 20 * one
    two /= two.sum(axis=1, keepdims=True)
    three = counts + 20 * two[None]
    return np.log(three / three.sum(axis=2, keepdims=True)).astype(np.float32)


class Restorer(dict):
    """Restored words of disguised ones, remembered."""

    def __init__(self, model: np.ndarray):
        self.model, self.kinds = model.tolist(), _kinds()

    def __missing__(self, token: str) -> tuple[str, ...]:
        found = tuple(_WORD.findall(self.decode(token)))
        if len(self) > 100_000:
            self.clear()
        self[token] = found
        return found

    def choices(self, token: str, i: int, last: int, masked: bool) -> list[tuple[str, float]]:
        """What the sign at ``i`` may stand for, with the cost; an empty string is nothing. ``last`` is the place of the
        token's last letter; ``masked`` says that the sign is one of few masks inside the token."""
        c = token[i]
        out: list[tuple[str, float]] = []
        if c.isalpha():
            out.append((c, 0.0))
        elif c in LOOKS:
            out += [(x, SIGN_COST) for x in LOOKS[c]]
            if i > last and c in ENDINGS:
                out.append((" ", KEPT_COST))
        if c in SEPARATORS:
            out += [("", SEPARATOR_COST), (" ", 0.0)]
            if masked:
                out += [(x, MASK_COST) for x in LETTERS[:26]]
        elif not out:
            out.append((" ", 0.0))
        if i and c == token[i - 1] and c not in SEPARATORS and c in (token[i - 2 : i - 1], token[i + 1 : i + 2]):
            out.append(("", REPEAT_COST))
        return out

    def lattice(self, token: str) -> Iterator[list[tuple[str, float]]]:
        """The readings of each sign in turn."""
        last = max((i for i, c in enumerate(token) if c.isalpha()), default=-1)
        rows = [(m.start(), m.end()) for m in _MASKS.finditer(token) if 0 < m.start() and m.end() < len(token)]
        rows = [] if len(rows) > MASKED_ROWS else [r for r in rows if r[1] - r[0] <= MASKS]
        masked = {i for a, b in rows for i in range(a, b)}
        for i in range(len(token)):
            yield self.choices(token, i, last, i in masked)

    def decode(self, token: str) -> str:
        """The best path of the lattice. A path is a chain of letters back to where the last ones were written out."""
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        out: list[str] = []
        open_signs = 0
        for options in self.lattice(token):
            coded = [(x, cost, 0 if x == " " else _CODE.get(x, CODES - 1)) for x, cost in options]
            following: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (score, path) in states.items():
                row = self.model[a][b]
                for x, cost, code in coded:
                    if not x or (code == 0 and b == 0):
                        key, new = (a, b), (score - cost, path)
                    else:
                        key, new = (b, code), (score - cost + row[code], (path, x))
                    if key not in following or following[key][0] < new[0]:
                        following[key] = new
            states = following
            open_signs += 1
            if len(states) == 1 or open_signs == LATTICE:
                key, (_, path) = max(states.items(), key=lambda s: s[1][0])
                out.append(_spelt(path))
                states, open_signs = {key: (0.0, None)}, 0
        (_, _), (_, path) = max(states.items(), key=lambda s: s[1][0] + (self.model[s[0][0]][s[0][1]][0] if s[0][1] else 0))
        return "".join(out) + _spelt(path)


def _spelt(path: tuple | None) -> str:
    signs = []
    while path is not None:
        path, x = path
        signs.append(x)
    return "".join(reversed(signs))


def words_of(text: str, restorer: Restorer) -> set[str]:
    """The different words of a text, with the restored ones of those that look disguised."""
    low = text.lower()
    words = set(_WORD.findall(low))
    for token in disguised(low, restorer.kinds):
        words.update(restorer[token])
    return words


def features_of(word: str) -> list[str]:
    """A word and its beginnings (marked by a hyphen)."""
    return [word, *(word[:n] + "-" for n in BEGINNINGS if len(word) >= n)]


class Evidence(dict):
    """The strongest feature of a word, remembered."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights

    def __missing__(self, word: str) -> float:
        best = max((self.weights.get(f, 0.0) for f in features_of(word)), default=0.0)
        if len(self) > 300_000:
            self.clear()
        self[word] = best
        return best

    def of(self, words: Collection[str]) -> list[float]:
        """Of different words: constant, strongest feature, and how many words have one, in logarithms of the text's size too."""
        hits = [e for e in map(self.__getitem__, words) if e]
        return [1.0, max(hits, default=0.0), math.log1p(len(hits)), math.log1p(sum(hits)), math.log1p(len(words))]


def _logistic(rows: DataFrame, ridge: float = 1.0) -> np.ndarray:
    """Weights of ``(y, x)`` by Newton's method. Every step sums slopes and curvatures over all rows, one pair a task."""
    size = len(Evidence({}).of(set()))
    w = np.zeros(size)

    def sums(w: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grad, hess = np.zeros(size), np.zeros((size, size))
            for batch in batches:
                y = batch.column(0).to_numpy() > 0
                x = batch.column(1).flatten().to_numpy().reshape(-1, size)
                p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
                grad += x.T @ (p - y)
                hess += (x * (p * (1 - p))[:, None]).T @ x
            yield pa.record_batch([pa.array([grad]), pa.array([hess.ravel()])], names=["grad", "hess"])

        return rows.select("y", "x").mapInArrow(run, "grad array<double>, hess array<double>").collect()

    for _ in range(50):
        parts = sums(w)
        grad = np.sum([r.grad for r in parts], axis=0) + ridge * w
        hess = np.sum([r.hess for r in parts], axis=0).reshape(size, size) + ridge * np.eye(size)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


class Model:
    """What scoring needs: the language model, the features' weights and the logistic weights."""

    def __init__(self, language: np.ndarray, weights: dict[str, float], logistic: np.ndarray):
        self.language, self.weights, self.logistic = language, weights, logistic

    def scorer(self):
        restorer, evidence = Restorer(self.language), Evidence(self.weights)

        def score(text: str | None) -> float:
            z = float(np.dot(evidence.of(words_of(text or "", restorer)), self.logistic))
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

        return score


def _judged(labels: DataFrame, label: str, id_col: str) -> DataFrame:
    """``(_id, _y)``: one label for an id, the larger of several. Null ids and labels are left out."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull())
    return known.groupBy(F.col(id_col).alias("_id")).agg(F.max(label).cast("int").alias("_y"))


def labelled(docs: DataFrame, labels: DataFrame, label: str, sample: int, id_col: str, text_col: str) -> DataFrame:
    """``(y, text)`` of at most ``sample`` labelled rows: one label for an id, those with the smallest hash."""
    few = _judged(labels, label, id_col).orderBy(F.xxhash64("_id"), "_id").limit(sample)
    known = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    # at most `sample` pairs of numbers
    return written(known.join(F.broadcast(few), "_id").select(F.col("_y").alias("y"), "text"), "labelled")


def _marks(ids: DataFrame) -> tuple[np.ndarray, int]:
    """A bit at the hash of each of the ids in ``_id``, and the logarithm of how many bits there are."""
    log = min(max((16 * ids.count()).bit_length(), CHUNK), MARKS)
    place = ids.select(_place("_id", log).alias("place"))
    chunk, bit = F.shiftright("place", CHUNK).alias("chunk"), F.col("place") % (1 << CHUNK)
    marks = np.zeros((1 << (log - CHUNK), 1 << (CHUNK - 3)), dtype=np.uint8)
    for r in place.groupBy(chunk).agg(F.bitmap_construct_agg(bit).alias("bits")).collect():  # a row for each chunk at most
        marks[r.chunk] = np.frombuffer(r.bits, dtype=np.uint8)
    return marks.ravel(), log


def _place(id_col: str, log: int) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << log))


def labelled_words(docs: DataFrame, labels: DataFrame, label: str, language: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """``(y, words)`` of all labelled rows: the different words with the restored ones, as one string; one label for an id.

    No text is shuffled, words are, by a merge join at any size. Bits at the hashes of the labelled ids tell the tasks which texts to read: those of all labelled
    rows and of a few others (more of them above some millions of labels), which the join on the id leaves out.
    """
    ids = docs.select(F.col(id_col).alias("_id")).distinct()
    known = written(ids.join(_judged(labels, label, id_col), "_id").select("_id", F.col("_y").alias("y")), "labelled")
    marks, log = _marks(known)
    sent = docs.sparkSession.sparkContext.broadcast((language, marks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        language, marks = sent.value
        restorer = Restorer(language)
        for batch in batches:
            place = batch.column(1).to_numpy()
            some = batch.filter(pa.array((marks[place >> 3] >> (place & 7) & 1).astype(bool)))
            for part in range(0, some.num_rows, 256):
                rows = some.slice(part, 256)
                words = [" ".join(words_of(t.as_py() or "", restorer)) for t in rows.column(2)]
                yield pa.record_batch([rows.column(0), pa.array(words, pa.string())], names=["_id", "words"])

    slim = docs.select(F.col(id_col).alias("_id"), _place(id_col, log).alias("place"), F.col(text_col).cast("string").alias("text"))
    found = slim.mapInArrow(run, f"_id {dict(slim.dtypes)['_id']}, words string")
    return found.join(known.hint("merge"), "_id").select("y", "words")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic") -> Model:
    """Learn from all rows of ``labels`` that belong to ``docs``. Without labels of both kinds every score is 0.

    Null ids and labels are left out, of several labels for an id the larger counts. A repeated document is an example
    again. Empty tables are no labels.
    """
    language = language_model(character_counts(docs, text_col))
    path = new_folder(docs.sparkSession, "words")
    known = written(labelled_words(docs, labels, label, language, id_col, text_col), "words", path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())

        def tables() -> Iterator[pa.RecordBatch]:
            for kind, counter in enumerate(seen):
                counts, none = pa.array(counter.values(), pa.int64()), pa.array([0] * len(counter), pa.int64())
                columns = [none, counts] if kind == 0 else [counts, none]
                yield pa.record_batch([pa.array(counter, pa.string()), *columns], names=["feature", "pos", "neg"])
                counter.clear()

        for batch in batches:
            for y, words in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                seen[y > 0].update({f for w in words.as_py().split() for f in features_of(w)})
                if sum(map(len, seen)) >= COUNTED:
                    yield from tables()
        yield from tables()

    n = known.agg(F.count_if(F.col("y") > 0).alias("pos"), F.count_if(F.col("y") <= 0).alias("neg")).first()
    odds = F.log((F.col("pos") + 0.5) / (n.pos + 1.0)) - F.log((F.col("neg") + 0.5) / (n.neg + 1.0))
    strong = (
        known.mapInArrow(count, "feature string, pos bigint, neg bigint")
        .groupBy("feature")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .where(F.col("pos") >= SUPPORT)
        .withColumn("odds", odds)
        .where(F.col("odds") > EVIDENCE)
        .orderBy(F.desc("odds"), "feature")
        .limit(FEATURES)
    )
    weights = {r.feature: r.odds for r in strong.collect()}
    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_words = Evidence(weights)
        for batch in batches:
            x = [known_words.of(words.as_py().split()) for words in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["y", "x"])

    logistic = np.array([-30.0, 0, 0, 0, 0])
    if n.pos and n.neg:
        logistic = _logistic(written(known.mapInArrow(evidence, "y int, x array<double>"), "evidence"))
    remove(docs.sparkSession, path)
    return Model(language, weights, logistic)


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in a column ``name``, in place of one of that name.

    Null texts count as empty, and empty ones are scored like any other. Every row has its score, repeated rows and
    null ids included; texts of any length are read whole, in time that grows with them. An empty table gives no rows.
    """
    docs = docs.drop(name)
    at = docs.columns.index(text_col)
    # plain data: a broadcast is unpickled before the code of this package has been sent
    sent = docs.sparkSession.sparkContext.broadcast((model.language, model.weights, model.logistic))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = Model(*sent.value).scorer()
        for batch in batches:
            scores = pa.array([one(t.as_py()) for t in batch.column(at)], pa.float64())
            yield pa.record_batch([*batch.columns, scores], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add(name, DoubleType()))
