"""LM scoring by masked pseudo-likelihood.

The model predicts every word of a text from the ``SIDE`` words on either side of it, the
word itself masked; a document's score is the sum of these conditional log probabilities.

Word counts come from the whole corpus.  The probability of a word is that of its class given the
window times the share of the word in its class by its exact count: the ``TOP_CLASSES`` most
frequent words are classes of their own, the others go by a hash of their ending.  The network
(one hidden layer on word vectors) finds a class in two steps, a softmax over ``GROUPS`` groups and
one over the ``MEMBERS`` classes of the group; classes are dealt to groups by rank, so groups weigh
about the same and a window costs ``GROUPS + MEMBERS`` outputs instead of their product.  The counts
of the ``VOCABULARY`` most frequent words are broadcast, those of all others meet their texts by a
join on the word.  So all words of the corpus have a probability, and they sum to one.

The words of all texts are turned into numbers once, and that table is written: the rounds and the
scoring read it.

Training covers every window of every text once: in each of ``ROUNDS`` rounds every task takes
the current network through its documents by mini-batches in numpy (in round r the words at
place r mod ``ROUNDS``), and the tasks' networks are averaged by a Spark aggregation, weighted
by their windows.

Defined cases: null, empty and blank texts have no token, a log probability of 0 and a null mean;
windows end at the text's ends (a boundary mark stands for what is beyond); repeated rows are
scored one by one; words never counted get the share of one count; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcraft.session import dropped, written

SIDE, VECTOR, HIDDEN = 2, 16, 32
GROUPS, MEMBERS, ENDINGS = 64, 64, 256
CLASSES = GROUPS * MEMBERS
TOP_CLASSES, VOCABULARY, CONTEXT = CLASSES - ENDINGS, 131_072, 8_192
ROUNDS, BATCH, RATE = 2, 4096, 0.1
#: windows that are scored together; code points cut into words, words taken from the table, code points counted together,
#: words of counted runs added up together
TOGETHER, CHARACTERS, WORDS, COUNTED, ADDED = 4_096, 1 << 19, 1 << 17, 1 << 22, 1 << 20
SHAPES = {"vectors": (CONTEXT + ENDINGS + 1, VECTOR), "w1": (2 * SIDE * VECTOR, HIDDEN), "b1": (HIDDEN,),
          "w2": (HIDDEN, GROUPS), "b2": (GROUPS,), "w3": (GROUPS, HIDDEN + 1, MEMBERS)}      # the bias of w3 is its last row


def ending_class(word: bytes) -> int:
    """Class of a word that is none of its own: by a hash of its last two bytes."""
    return TOP_CLASSES + zlib.crc32(word[-2:]) % ENDINGS


# -- words of a text as numbers, by array operations over its bytes

_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LONGEST = 1 << 14
with np.errstate(over="ignore"):
    _POWERS = np.cumprod(np.full(_LONGEST, 0x9E3779B97F4A7C15, dtype=np.uint64))
_BYTES = np.arange(1, 257, dtype=np.uint64)
_ONE = np.array([ending_class(bytes([i])) for i in range(256)])
_TWO = np.array([[ending_class(bytes([i, j])) for j in range(256)] for i in range(256)])


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(64-bit polynomial hash, ending class, first byte) of each word among bytes."""
    inside = np.flatnonzero(~_SPACE[data]).astype(np.int32)
    if not len(inside):
        return np.empty(0, np.uint64), np.empty(0, np.int64), inside
    first = np.flatnonzero(np.diff(inside, prepend=np.int32(-2)) != 1).astype(np.int32)   # of each word, among ``inside``
    size = np.diff(first, append=np.int32(len(inside)))
    place = (np.arange(len(inside), dtype=np.int32) - np.repeat(first, size)) & np.int32(_LONGEST - 1)
    part = _POWERS[place] * _BYTES[data[inside]]
    ends = inside[first + size - 1]
    classes = np.where(size == 1, _ONE[data[ends]], _TWO[data[ends - 1], data[ends]])
    return np.add.reduceat(part, first), classes, inside[first]


class Numbers:
    """Numbers of words: rank in the vocabulary, or ``VOCABULARY`` + class.

    An open hash table of 64-bit word hashes, four times as large as the vocabulary; a lookup
    steps through it for all words of a text at once."""

    def __init__(self, vocabulary: list[str]):
        self.bits = max(4, (4 * len(vocabulary)).bit_length())
        self.keys = np.zeros(1 << self.bits, dtype=np.uint64)
        self.ranks = np.full(1 << self.bits, -1, dtype=np.int64)
        self.steps = 1
        h = word_hashes(np.frombuffer("\n".join(vocabulary).encode(), np.uint8))[0]
        at, left = self._slot(h), np.arange(len(h))
        while len(left):                                 # each word takes the next free slot
            free = np.flatnonzero(self.ranks[at] < 0)
            slots, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.keys[slots], self.ranks[slots] = h[left[won]], left[won]
            left, at = np.delete(left, won), (np.delete(at, won) + 1) % len(self.keys)
            self.steps += bool(len(left))

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - self.bits)).astype(np.int64)

    def of(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, first byte) of each word."""
        h, classes, at_byte = word_hashes(data)
        out, at, left = VOCABULARY + classes, self._slot(h), np.arange(len(h))
        for _ in range(self.steps):
            rank = self.ranks[at]
            hit = self.keys[at] == h[left]
            found = hit & (rank >= 0)
            out[left[found]] = rank[found]
            more = np.flatnonzero(~hit & (rank >= 0))
            if not len(more):
                break
            left, at = left[more], (at[more] + 1) % len(self.keys)
        return out, at_byte


@dataclass
class Lexicon:
    """Vocabulary and corpus counts: bounded by ``VOCABULARY`` and ``CLASSES``."""
    vocabulary: list[str]
    counts: np.ndarray              # of the vocabulary's words
    rest: np.ndarray                # for each class the count of its words beyond the vocabulary
    types: np.ndarray               # and how many such words there are
    numbers: Numbers = field(init=False, repr=False)

    def __post_init__(self) -> None:
        self.numbers = Numbers(self.vocabulary)
        n = len(self.vocabulary)
        own = np.array([i if i < TOP_CLASSES else ending_class(w.encode()) for i, w in enumerate(self.vocabulary)], dtype=np.int64)
        size = VOCABULARY + CLASSES
        self.class_of = np.zeros(size, dtype=np.int64)
        self.class_of[:n] = own
        self.class_of[VOCABULARY:] = np.arange(CLASSES)
        total = np.bincount(own, self.counts, CLASSES) + self.rest + 1   # one count for words not seen
        self.prior = total / total.sum()
        self.log_share = np.zeros(size)
        self.log_share[:n] = np.log(np.maximum(self.counts, 1) / total[own])
        self.log_share[VOCABULARY:] = np.log((self.rest + 1) / (self.types + 1) / total)
        #: the share of one count for all words beyond the vocabulary, whose own counts come by a join
        self.log_share_of_one = np.where(np.arange(size) < VOCABULARY, self.log_share, -np.log(total)[self.class_of])
        #: row of the vectors: frequent words, then endings, then the boundary
        self.context = np.where(np.arange(size) < CONTEXT, np.arange(size), CONTEXT + self.class_of - TOP_CLASSES).astype(np.int32)
        self.boundary = CONTEXT + ENDINGS

    def __reduce__(self):
        return Lexicon, (self.vocabulary, self.counts, self.rest, self.types)

    def ids(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the words of all texts in a row, how many each text has)."""
        return self.read(texts)[:2]

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What ``ids`` returns, the texts' bytes, and the first byte of each word."""
        parts = [(t or "").lower().encode(errors="replace") for t in texts]
        data = np.frombuffer(b"\n".join(parts), np.uint8)
        ids, at = self.numbers.of(data)
        ends = np.cumsum([len(p) + 1 for p in parts])
        return ids, np.diff(np.searchsorted(at, ends), prepend=0), data, at

    def line(self, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts' rows of the vectors, each text between boundaries, and the place of every word."""
        at = np.arange(len(ids)) + SIDE * (1 + np.repeat(np.arange(len(size)), size))
        line = np.full(len(ids) + SIDE * (len(size) + 1), self.boundary, dtype=np.int32)
        line[at] = self.context[ids]
        return line, at


def rare_words(ids: np.ndarray, size: np.ndarray, data: np.ndarray, at: np.ndarray) -> pa.ListArray:
    """For each text its words beyond the vocabulary, from what ``Lexicon.read`` returns."""
    rare = np.flatnonzero(ids >= VOCABULARY)
    first, gaps = at[rare].astype(np.int64), np.append(np.flatnonzero(_SPACE[data]), len(data))
    length = gaps[np.searchsorted(gaps, first)] - first
    edges = np.concatenate([[0], np.cumsum(length)])
    own = data[np.arange(edges[-1]) + np.repeat(first - edges[:-1], length)]
    found = pa.StringArray.from_buffers(len(rare), pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(own))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rare, np.concatenate([[0], np.cumsum(size)])), pa.int32()), found)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all documents, written (it is read several times).  Words are counted in
    runs of texts first and the runs' counts added up, so that few rows reach the aggregate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def added() -> list[pa.RecordBatch]:
            total = pa.Table.from_batches(held).group_by("word").aggregate([("n", "sum")])
            return total.select(["word", "n_sum"]).rename_columns(["word", "n"]).to_batches()

        for batch in batches:
            for _, texts in batches_of(batch.column(0), COUNTED):
                own = pa.array([(t or "").lower().encode(errors="replace") for t in texts], pa.string())
                found = pc.value_counts(pc.list_flatten(pc.ascii_split_whitespace(own)))
                held.append(pa.RecordBatch.from_arrays([found.field(0), found.field(1)], names=["word", "n"]))
                size += len(found)
                if size >= ADDED:
                    yield from added()
                    held, size = [], 0
        if held:
            yield from added()

    w = docs.select("text").mapInArrow(run, "word string, n long").filter(F.col("word") != "")
    return written(w.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


def least_count(counts: DataFrame, most: int, parts: int = 1024) -> int:
    """The least count that ``most`` words or fewer reach.  A histogram of at most ``parts`` cells is
    narrowed to the cell of the limit until a cell is one count; words tied at the limit stay out."""
    lo, hi, above = 1, counts.agg(F.max("n")).first()[0] or 0, 0
    while lo <= hi:
        width = -(-(hi - lo + 1) // parts)
        cell = ((F.col("n") - lo) / width).cast("long")
        rows = counts.filter(F.col("n").between(lo, hi)).groupBy(cell.alias("c")).agg(F.count("*").alias("k")).collect()
        held = {r["c"]: r["k"] for r in rows}
        limit = None
        for c in sorted(held, reverse=True):
            if above + held[c] > most:
                limit = c
                break
            above += held[c]
        if limit is None:
            return lo
        if width == 1:
            return lo + limit + 1
        lo, hi = lo + limit * width, min(hi, lo + (limit + 1) * width - 1)
    return lo


def lexicon(counts: DataFrame, least: int) -> Lexicon:
    """The words with at least ``least`` counts and, for all other words, sums by class."""
    top = sorted(counts.filter(F.col("n") >= least).collect(), key=lambda r: (-r["n"], r["word"]))
    k = F.lit(TOP_CLASSES) + F.pmod(F.crc32(F.substring(F.col("word").cast("binary"), -2, 2)), F.lit(ENDINGS))
    by_class = counts.groupBy(k.cast("int").alias("k")).agg(F.sum("n").alias("n"), F.count("*").alias("types")).collect()
    rest, types = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in by_class:
        rest[r["k"]], types[r["k"]] = r["n"], r["types"]
    for r in top:
        rest[c := ending_class(r["word"].encode())] -= r["n"]
        types[c] -= 1
    return Lexicon([r["word"] for r in top], np.array([r["n"] for r in top], dtype=float), rest, types)


# -- network

Network = dict[str, np.ndarray]


def initial(lex: Lexicon) -> Network:
    rng = np.random.default_rng(0)
    net = {k: rng.normal(0, 0.3 if k == "vectors" else 1 / np.sqrt(s[-2]), s) if k[0] != "b" else np.zeros(s) for k, s in SHAPES.items()}
    prior = lex.prior.reshape(MEMBERS, GROUPS).T
    net["b2"] = np.log(prior.sum(axis=1))
    net["w3"][:, HIDDEN] = np.log(prior / prior.sum(axis=1, keepdims=True))
    return {k: v.astype(np.float32) for k, v in net.items()}


#: places of a window beside the word
SIDES = np.array([*range(-SIDE, 0), *range(1, SIDE + 1)])


def batches_of(column: pa.Array, characters: int = CHARACTERS) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of texts of about ``characters`` code points, with their first row."""
    first, held, size = 0, [], 0
    for i, value in enumerate(column):
        held.append(value.as_py())
        size += len(held[-1] or "")
        if size >= characters:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def group_and_member(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (classes % GROUPS).astype(np.uint8), classes // GROUPS


def _runs(group: np.ndarray) -> list[tuple[int, slice]]:
    """(group, its rows) for sorted groups."""
    first = np.flatnonzero(np.diff(group.astype(np.int16), prepend=np.int16(-1)))
    return [(k, slice(a, b)) for k, a, b in zip(group[first].tolist(), first.tolist(), [*first[1:].tolist(), len(group)], strict=True)]


def _bounded(net: Network) -> bool:
    """Whether no logit can overflow: hidden values are within (-1, 1)."""
    return all(float(np.abs(w).sum(axis=-2).max() + np.abs(b).max()) < 60 for w, b in ((net["w2"], net["b2"]), (net["w3"], np.zeros(1))))


def _exponentials(z: np.ndarray, bounded: bool) -> np.ndarray:
    """exp(z) in place, rows shifted where a logit could overflow; returns the sums of the rows."""
    if not bounded:
        z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    return z @ np.ones(z.shape[1], dtype=z.dtype)


class Room:
    """Arrays that are kept from one mini-batch to the next: fresh ones of this size cost more than what is done with them."""

    def __init__(self, dtype: np.dtype):
        self.dtype, self.held = dtype, {}

    def __call__(self, name: str, *shape: int) -> np.ndarray:
        size = int(np.prod(shape))
        if name not in self.held or self.held[name].size < size:
            self.held[name] = np.empty(size, self.dtype)
        return self.held[name][:size].reshape(shape)


def _hidden(net: Network, context: np.ndarray, room: Room) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of the context in a row, hidden values and a one for the bias of ``w3``."""
    n = len(context)
    x, h, plain = room("x", *context.shape, VECTOR), room("h", n, HIDDEN + 1), room("plain", n, HIDDEN)
    net["vectors"].take(context, axis=0, out=x, mode="clip")            # in place only if no row is refused
    x = x.reshape(n, -1)
    np.matmul(x, net["w1"], out=plain)
    plain += net["b1"]
    np.tanh(plain, out=h[:, :HIDDEN])
    h[:, HIDDEN] = 1
    return x, h


def _logits(net: Network, h: np.ndarray, runs: list[tuple[int, slice]], room: Room) -> tuple[np.ndarray, np.ndarray]:
    """Of the groups, and of the members of each row's group."""
    p, q = room("p", len(h), GROUPS), room("q", len(h), MEMBERS)
    np.matmul(h[:, :HIDDEN], net["w2"], out=p)
    p += net["b2"]
    for k, rows in runs:
        np.matmul(h[rows], net["w3"][k], out=q[rows])
    return p, q


def step(net: Network, squares: Network, context: np.ndarray, target: np.ndarray, rate: float, room: Room | None = None) -> float:
    """One Adagrad step on a mini-batch; returns its mean loss."""
    n, room = len(target), room or Room(net["w1"].dtype)
    group, member = group_and_member(target)
    order = np.argsort(group, kind="stable")
    context, group, member = context.take(order, axis=0), group[order], member[order]
    runs, every = _runs(group), np.arange(n)
    x, h1 = _hidden(net, context, room)
    h = h1[:, :HIDDEN]
    p, q = _logits(net, h1, runs, room)
    loss, bounded = 0.0, _bounded(net)
    for z, own in ((p, group), (q, member)):
        z *= (1 / (n * _exponentials(z, bounded)))[:, None]
        chance = z[every, own]
        loss -= np.log(np.maximum(n * chance, 1e-12)).mean()
        z[every, own] = chance - z.dtype.type(1 / n)
    dh, more = np.matmul(p, net["w2"].T, out=room("dh", n, HIDDEN)), room("plain", n, HIDDEN)
    used = [k for k, _ in runs]
    d3 = room("d3", len(runs), HIDDEN + 1, MEMBERS)
    for j, (k, rows) in enumerate(runs):
        np.matmul(q[rows], net["w3"][k, :HIDDEN].T, out=more[rows])
        np.matmul(h1[rows].T, q[rows], out=d3[j])
    dh += more
    np.multiply(h, h, out=more)
    dh *= np.subtract(1, more, out=more)
    flat = context.reshape(-1).astype(np.uint16)                        # sorted by radix
    order = np.argsort(flat, kind="stable")
    rows = flat[order]
    starts = np.flatnonzero(np.diff(rows, prepend=-1))
    rows = rows[starts]
    gradients = (("w2", h.T @ p), ("b2", p.sum(axis=0)), ("w1", x.T @ dh), ("b1", dh.sum(axis=0)))
    dx = np.matmul(dh, net["w1"].T, out=x).reshape(-1, VECTOR)          # ``x`` isn't read any more
    dv = np.add.reduceat(dx.take(order, axis=0, out=room("sorted", len(order), VECTOR), mode="clip"), starts, axis=0)
    for k, g in gradients:
        squares[k] += g * g
        net[k] -= rate * g / np.sqrt(squares[k] + 1e-8)
    for k, g, at in (("w3", d3, used), ("vectors", dv, rows)):
        squares[k][at] += g * g
        net[k][at] -= rate * g / np.sqrt(squares[k][at] + 1e-8)
    return float(loss)


def windows(size: np.ndarray, number: int, rounds: int) -> np.ndarray:
    """Which words of the texts a round trains on: over all rounds every word of every text, once."""
    start = np.cumsum(size) - size
    inside = np.arange(size.sum()) - np.repeat(start, size)
    return np.flatnonzero(inside % rounds == number)


def numbered(docs: DataFrame, lex: Lexicon) -> DataFrame:
    """(row, doc_id, ids, rare) of every document, written: the numbers of its words as 32-bit
    integers in a row, and its words beyond the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(lex)              # bounded by ``VOCABULARY``

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for first, texts in batches_of(batch.column(1)):
                ids, size, data, at = shared.value.read(texts)
                n, ends = len(size), np.concatenate([[0], 4 * np.cumsum(size)]).astype(np.int32)
                found = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(ids.astype(np.int32))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + n)), batch.column(0).slice(first, n), found, rare_words(ids, size, data, at)],
                    names=["row", "doc_id", "ids", "rare"])
                row += n

    table = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "row long, doc_id long, ids binary, rare array<string>")
    table = written(table, "word-numbers")
    shared.destroy()
    return table


def numbers_of(column: pa.BinaryArray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``WORDS`` words: (rows, numbers of their words, how many each has)."""
    ends = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset) // 4
    values = column.buffers()[2]
    whole = np.frombuffer(values, np.int32, values.size // 4) if values is not None and values.size else np.empty(0, np.int32)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + WORDS)))
        last = min(last, len(column))
        yield slice(first, last), whole[ends[first]:ends[last]], np.diff(ends[first:last + 1])
        first = last


def train_round(table: DataFrame, lex: Lexicon, net: Network, number: int, rounds: int = ROUNDS) -> Network:
    """Every task trains on its rows of ``numbered``; the mean of their networks, weighted by windows."""
    shared = table.sparkSession.sparkContext.broadcast((lex, net))      # of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, net = shared.value
        net = {k: v.copy() for k, v in net.items()}
        squares = {k: np.zeros_like(v) for k, v in net.items()}
        held, size, seen, room = [], 0, 0, Room(net["w1"].dtype)

        def flush(least: int) -> None:
            nonlocal held, size, seen
            context, target = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.random.default_rng(seen).permutation(len(target))
            done = 0
            while len(target) - done >= least:
                b = order[done:done + BATCH]
                step(net, squares, context.take(b, axis=0), target[b], RATE, room)
                done += len(b)
            held, size, seen = [(context[order[done:]], target[order[done:]])], len(target) - done, seen + done

        for batch in batches:
            for _, ids, count in numbers_of(batch.column(0)):
                line, places = lex.line(ids, count)
                chosen = windows(count, number, rounds)
                if len(chosen):
                    held.append((line.take(places[chosen, None] + SIDES), lex.class_of[ids[chosen]]))
                    size += len(chosen)
                if size >= 16 * BATCH:
                    flush(BATCH)
        if size:
            flush(1)
        if seen:
            flat = np.concatenate([net[k].ravel() for k in SHAPES]).astype(float)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat * seen), pa.array(np.full(len(flat), float(seen)))],
                names=["i", "v", "n"])

    mean = (table.select("ids").mapInArrow(run, "i int, v double, n double").groupBy("i")
            .agg((F.sum("v") / F.sum("n")).alias("v")).collect())      # one row for each parameter
    shared.destroy()
    if not mean:
        return net
    flat = np.zeros(len(mean), dtype=np.float32)
    for r in mean:
        flat[r["i"]] = r["v"]
    out, a = {}, 0
    for k, shape in SHAPES.items():
        out[k] = flat[a:a + (n := int(np.prod(shape)))].reshape(shape)
        a += n
    return out


class Scorer:
    """Scores texts with a network."""

    def __init__(self, lex: Lexicon, net: Network, share: np.ndarray | None = None):
        self.lex, self.net, self.share = lex, net, lex.log_share if share is None else share
        self.bounded, self.room = _bounded(net), Room(net["w1"].dtype)

    def log_likelihoods(self, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        """For each text the sum over its words of log P(word | both sides)."""
        lex, net, out = self.lex, self.net, np.empty(len(ids))
        line, at = lex.line(ids, size)
        for a in range(0, len(ids), TOGETHER):
            group, member = group_and_member(lex.class_of[ids[a:a + TOGETHER]])
            order = np.argsort(group, kind="stable")
            group, member, every = group[order], member[order], np.arange(len(order))
            _, h = _hidden(net, line.take(at[a + order, None] + SIDES), self.room)
            p, q = _logits(net, h, _runs(group), self.room)
            log = np.zeros(len(order))
            for z, own in ((p, group), (q, member)):
                total = _exponentials(z, self.bounded)
                log += np.log(z[every, own] / total)
            out[a + order] = log
        out += self.share[ids]
        # each text by itself, so that a sum depends on no other text
        return np.array([x.sum() for x in np.split(out, np.cumsum(size)[:-1])]) if len(size) else np.empty(0)


@dataclass
class MaskedModel:
    lexicon: Lexicon
    network: Network
    rare: DataFrame                 # (word, n) of all words beyond the vocabulary


def counted(docs: DataFrame, vocabulary: int = VOCABULARY) -> tuple[Lexicon, DataFrame]:
    """The lexicon of all documents, and (word, n) of the words beyond its vocabulary."""
    counts = word_counts(docs)
    least = least_count(counts, vocabulary)
    return lexicon(counts, least), counts.filter(F.col("n") < least)


def fit(table: DataFrame, lex: Lexicon, rounds: int = ROUNDS) -> Network:
    """The network trained on the rows of ``numbered``."""
    net = initial(lex)
    for number in range(rounds):
        net = train_round(table, lex, net, number, rounds)
    return net


def train(docs: DataFrame, rounds: int = ROUNDS, vocabulary: int = VOCABULARY) -> MaskedModel:
    lex, rare = counted(docs, vocabulary)
    table = numbered(docs, lex)
    net = fit(table, lex, rounds)
    dropped(table)
    return MaskedModel(lex, net, rare)


def score(docs: DataFrame, model: MaskedModel) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_likelihood) of every document."""
    return score_numbers(numbered(docs, model.lexicon), model)


def score_numbers(table: DataFrame, model: MaskedModel) -> DataFrame:
    """What ``score`` returns, from the rows of ``numbered``."""
    shared = table.sparkSession.sparkContext.broadcast((model.lexicon, model.network))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, net = shared.value
        scorer = Scorer(lex, net, lex.log_share_of_one)
        for batch in batches:
            for rows, ids, size in numbers_of(batch.column(2)):
                row, doc_id = (batch.column(i).slice(rows.start, rows.stop - rows.start) for i in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [row, doc_id, pa.array(size, pa.int64()), pa.array(scorer.log_likelihoods(ids, size), pa.float64())],
                    names=["row", "doc_id", "n_tokens", "s"])

    found = table.select("row", "doc_id", "ids").mapInArrow(run, "row long, doc_id long, n_tokens long, s double")
    total = F.col("s")
    if model.lexicon.types.any():
        # words beyond the vocabulary are rare ones: none is hot, and one never counted has one count;
        # the logarithm of one count is nothing to add
        own = (table.select("row", F.explode("rare").alias("word")).join(model.rare.filter(F.col("n") > 1), "word")
               .groupBy("row").agg(F.sum(F.log("n")).alias("more")))
        found, total = found.join(own, "row", "left"), total + F.coalesce("more", F.lit(0.0))
    return found.select("doc_id", "n_tokens", total.alias("log_likelihood")).withColumn(
        "mean_log_likelihood", F.try_divide("log_likelihood", "n_tokens"))


def train_and_score(docs: DataFrame) -> DataFrame:
    lex, rare = counted(docs)
    table = numbered(docs, lex)
    return score_numbers(table, MaskedModel(lex, fit(table, lex), rare))
