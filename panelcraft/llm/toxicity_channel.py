"""Toxicity by a noisy channel: disguised words are restored, then scored.

A character trigram model is counted over all documents.  A word that may be disguised
(digits or signs that stand for letters beside letters, letters three times and more,
single letters with blanks or signs between them) becomes a lattice: each character with the
letters that it may stand for, each run with its shorter spellings, each gap kept or closed.
The most likely path (Viterbi over pairs of characters: language model times channel) is the
restored text; every other word is its own only path.

Words and word beginnings of restored text are weighed by the lower bound of their log odds among
labelled documents (a bounded sample of each class, in the order of a hash of the id; rows
held out are never used), and a logistic regression on a document's highest weights gives the
score.  Only texts are inputs of a score.

Defined cases: null and empty texts have no word and get the score of no evidence; rows are
scored one by one, repeated or not; without labels of both classes every score is 0; an
empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcraft.llm.common import hash_sample, unused
from panelcraft.llm.memo import begin
from panelcraft.session import written

#: fixed values: letters that a sign may stand for
STANDS_FOR = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
              "*": "aeiou", "#": "h"}
#: log probabilities of the channel: a sign for a letter, a digit among letters as itself, a
#: shorter run of a letter, a closed gap
SIGN, DIGIT, SHORTER, CLOSED = math.log(0.2), math.log(0.001), math.log(0.5), math.log(0.05)
#: labelled documents of each class that the classifier is fitted on, at most
TRAIN_ROWS = 5_000
THRESHOLD = 0.3
#: lower bound of log odds from which a word or beginning counts, and documents it needs
LEAST_WEIGHT, LEAST_DOCS = 1.0, 5
BEGINNINGS = 4, 5, 6
TOP = 3
#: remembered words of a worker
MEMORY = 150_000

# -- character model

_LETTERS = [chr(c) for c in (*range(97, 123), *range(0xDF, 0x100)) if chr(c).isalpha()]
OTHER, SIZE = len(_LETTERS) + 1, 64                  # 0: no letter; 1...: letters; any other letter
_LAST = 0x250


@cache
def _classes() -> np.ndarray:
    """Class of each code point below ``_LAST``; beyond them all count as other letters."""
    number = {c: k + 1 for k, c in enumerate(_LETTERS)}
    return np.array([number.get(chr(c).lower(), OTHER if chr(c).isalpha() else 0) for c in range(_LAST + 1)], dtype=np.int32)


def class_of(c: str) -> int:
    return int(_classes()[min(ord(c), _LAST)]) if c.isalpha() or ord(c) < _LAST else 0


def trigrams(docs: DataFrame) -> np.ndarray:
    """Counts of character trigrams over all texts, a table of ``SIZE`` cubed."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("toxicity")
        total = np.zeros(SIZE ** 3, dtype=np.int64)
        for batch in batches:
            for value in batch.column(0):
                text = value.as_py()
                if text:
                    k = _classes()[np.minimum(np.frombuffer(f" {text} ".encode("utf-32-le", "replace"), "<u4"), _LAST)]
                    total += np.bincount((k[:-2] * SIZE + k[1:-1]) * SIZE + k[2:], minlength=SIZE ** 3) if len(k) > 50_000 else 0
                    if len(k) <= 50_000:
                        i, n = np.unique((k[:-2] * SIZE + k[1:-1]) * SIZE + k[2:], return_counts=True)
                        total[i] += n
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["i", "n"])

    table = np.zeros(SIZE ** 3, dtype=np.int64)
    for r in docs.select("text").mapInArrow(count, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        table[r["i"]] = r["n"]                       # at most SIZE cubed rows
    return table.reshape(SIZE, SIZE, SIZE)


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """log P(c | a, b): trigrams, bigrams and single classes interpolated."""
    c3 = counts.astype(float)
    c2, c1 = c3.sum(axis=0), c3.sum(axis=(0, 1))
    p1 = (c1 + 1) / (c1.sum() + SIZE)
    p2 = (c2 + 10 * p1) / (c2.sum(axis=1, keepdims=True) + 10)
    p3 = (c3 + 10 * p2[None]) / (c3.sum(axis=2, keepdims=True) + 10)
    return np.log(p3).reshape(-1)


# -- lattice and decoder

_RUN = re.compile(r"(.)\1{2,}")
_SUSPECT = re.compile(r"[^\W\d_][0-9@$!|+(€£¡*#]+[^\W\d_]|[0-9@$!|+(€£¡][^\W\d_]|[^\W\d_][0-9]|([^\W\d_])\1\1"
                      r"|(?<![^\W_])[^\W_](?:[.\-_*·][^\W_]){2,}(?![^\W_])")
#: single characters with blanks between them
SPACED = re.compile(r"(?<!\S)[^\W_](?:[ \t][^\W_]){2,}(?!\S)")
_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„’‘…–—·"
_WORD = re.compile(r"[^\W\d_]+")


def lattice(text: str) -> list[list[tuple[str, float]]]:
    """For each place of the text the strings that may be meant, with the channel's cost."""
    out, i = [], 0
    while i < len(text):
        c = text[i]
        if c.isalpha():
            n = 1
            while i + n < len(text) and text[i + n] == c:
                n += 1
            if n < 3:
                out += [[(c, 0.0)]] * n
            else:
                out.append([(c * k, SHORTER if k < n else 0.0) for k in {1, 2, n if n < 5 else 2}])
            i += n
            continue
        options = [(" ", DIGIT if c.isdigit() else 0.0)]
        options += [(x, SIGN) for x in STANDS_FOR.get(c, "")]
        if not c.isalnum():
            options.append(("", CLOSED))
        out.append(options)
        i += 1
    return out


def decode(text: str, logp: list[float]) -> str:
    """The most likely text behind ``text``: Viterbi over the last two classes."""
    states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    for options in [*lattice(text), [(" ", 0.0)]]:
        new: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (score, path) in states.items():
            for meant, cost in options:
                x, y, s = a, b, score + cost
                for c in meant:
                    k = class_of(c)
                    if k or y:                       # gaps in a row are one
                        s += logp[(x * SIZE + y) * SIZE + k]
                        x, y = y, k
                if (x, y) not in new or new[x, y][0] < s:
                    new[x, y] = s, (path, meant) if meant else path
        states = new
    _, path = max(states.values(), key=lambda v: v[0])
    parts = []
    while path:
        path, meant = path
        parts.append(meant)
    return "".join(reversed(parts))


def restored_words(token: str, logp: list[float]) -> list[str]:
    """The words meant by a lower-case token."""
    core = token.strip(_EDGES)
    at = token.find(core) if core else 0
    if at and token[at - 1] in "@$" and core[0].isalpha():
        core = token[at - 1] + core                  # a sign for the first letter
    if core.isalpha() and not _RUN.search(core):
        return [core]
    if _SUSPECT.search(core):
        return decode(core, logp).split()
    return _WORD.findall(core)


def features(word: str) -> list[str]:
    return [word, *(f"{word[:k]}~" for k in BEGINNINGS if len(word) >= k)]


# -- classifier

@dataclass
class Model:
    logp: np.ndarray
    weights: dict[str, float] = field(default_factory=dict)
    coefficients: np.ndarray | None = None           # intercept, highest weight, sum of the highest
    known: dict[str, float] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        self.table = self.logp.tolist()

    def __reduce__(self):
        return Model, (self.logp, self.weights, self.coefficients)

    def words(self, text: str | None) -> Iterator[list[str]]:
        """Restored words of every different token and of every run of single characters."""
        if text:
            low = text.lower()
            for token in set(low.split()):
                yield restored_words(token, self.table)
            for run in set(SPACED.findall(low)):
                yield decode(run, self.table).split()

    def _weigh(self, words: list[str]) -> float:
        get = self.weights.get
        return max((get(f, 0.0) for w in words for f in features(w)), default=0.0)

    def evidence(self, text: str | None) -> tuple[float, float]:
        """The highest weight of a text's words, and the sum of the ``TOP`` highest."""
        if not text:
            return 0.0, 0.0
        low, known, found = text.lower(), self.known, []
        for token in set(low.split()):
            w = known.get(token)
            if w is None:
                w = self._weigh(restored_words(token, self.table))
                if len(known) > MEMORY:
                    known.clear()
                if len(token) <= 64:
                    known[token] = w
            if w:
                found.append(w)
        for run in set(SPACED.findall(low)):
            if w := self._weigh(decode(run, self.table).split()):
                found.append(w)
        found.sort(reverse=True)
        return (found[0], sum(found[:TOP])) if found else (0.0, 0.0)

    def score(self, text: str | None) -> float:
        if self.coefficients is None:
            return 0.0
        a, b = self.evidence(text)
        z = self.coefficients @ np.array([1.0, a, b])
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, toxic): at most ``rows`` labelled documents of each class, none held out."""
    own = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    one = own.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("_toxic"))
    part = lambda c: hash_sample(one.filter(F.col("_toxic") == c), "_id", rows)
    chosen = F.broadcast(part(0).unionAll(part(1)))   # 2 * rows small rows at most
    return docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("_id")).select("text", "_toxic")


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Character model of all documents, classifier of the bounded labelled sample."""
    spark = docs.sparkSession
    model = Model(log_probabilities(trigrams(docs)))
    sample = written(training_sample(docs, labels, rows), "toxicity-sample")   # read twice
    by_class = {r["_toxic"]: r["n"] for r in sample.groupBy("_toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = by_class.get(1, 0), by_class.get(0, 0)
    if not n1 or not n0:
        return model
    shared = spark.sparkContext.broadcast(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, seen = shared.value, {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, toxic in zip(*batch.columns, strict=True):
                seen[toxic.as_py()].update({f for ws in m.words(text.as_py()) for w in ws for f in features(w)})
        names = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([seen[1][f] for f in names], pa.int64()), pa.array([seen[0][f] for f in names], pa.int64())],
            names=["f", "a", "b"])

    counted = sample.mapInArrow(count, "f string, a long, b long").groupBy("f").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    odds = F.log((F.col("a") + 0.5) / (n1 + 1)) - F.log((F.col("b") + 0.5) / (n0 + 1))
    bound = odds - 1.64 * F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    chosen = counted.filter(F.col("a") >= LEAST_DOCS).select("f", bound.alias("w")).filter(F.col("w") >= LEAST_WEIGHT)
    model.weights = {r["f"]: r["w"] for r in chosen.collect()}   # of a bounded sample
    weighed = spark.sparkContext.broadcast(model)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [weighed.value.evidence(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.float64()), pa.array([b for _, b in found], pa.float64()),
                                              batch.column(1)], names=["a", "b", "_toxic"])

    rows_ = sample.mapInArrow(weigh, "a double, b double, _toxic int").collect()   # 2 * rows at most
    x = np.array(sorted((r["a"], r["b"], r["_toxic"]) for r in rows_), dtype=float)
    model.coefficients = _fit(x[:, :2], x[:, 2])
    return model


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with one more column: the score (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("toxicity")
        m = shared.value
        for batch in batches:
            scores = [m.score(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def judgements(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    s = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return s.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with their own columns."""
    s = unused(docs.columns, "_toxicity")
    return score(docs, model, s).filter(F.col(s) < threshold).drop(s)
