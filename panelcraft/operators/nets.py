"""Perceptrons with L2 and early stopping, all folds of a model in shared passes.

Layers of rectified units and a logistic output, trained by Adam on mini-batches.  A tenth of a fit's rows
is held out; after each epoch its accuracy is taken, training ends when it hasn't improved for
``patience`` epochs, and the weights of the best epoch are kept.  Batches are fixed sets of rows (a hash of
the row's number), visited in another order each epoch: about ``batch`` rows each, or more where that
would make over ``MAX_STEPS`` of them.

Gradients are sums over rows, so they can be summed in any grouping.  Up to ``WHOLE_BYTES`` of rows a fit has
all rows in one task, as a broadcast table would be.  Up to ``FILED_BYTES`` a fit's task has its rows in a local file, batch after
batch, of which a step reads one; its memory is that of ``FILED_ROWS`` rows.  Beyond that the rows are written by batch, a step is a
job that reads its batch alone, tasks sum the gradients of their rows for all fits still in training, partial sums meet
in ``SLOTS`` groups a fit, and the driver adds these up and takes the step.

Defined cases: missing values count as 0 (the mean of standardised features); a fit without rows or with one
class gives a constant; without a held-out row the last epoch's weights are kept.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcraft.operators.trees import FINAL, in_fit, uniform
from panelcraft.session import work_dir

#: rows (8 bytes a feature, and ``ROW_BYTES``) up to which a fit has them all in one task
WHOLE_BYTES, ROW_BYTES = 256 << 20, 24
#: rows up to which a fit has them all in a file of its task, and rows of the file that are held at once
FILED_BYTES, FILED_ROWS = 8 << 30, 512
MAX_STEPS = 250
SLOTS = 16


@dataclass(frozen=True)
class Shape:
    hidden: tuple[int, ...] = (128, 64, 32)
    l2: float = 0.01
    batch: int = 200
    epochs: int = 1000
    rate: float = 1e-3
    held_out: float = 0.1
    patience: int = 10
    tolerance: float = 1e-4
    seed: int = 42


def _sizes(shape: Shape, d: int) -> list[tuple[int, int]]:
    layers = [d, *shape.hidden, 1]
    return list(zip(layers, layers[1:]))


def _unpacked(flat: np.ndarray, sizes: list[tuple[int, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for a, b in sizes:
        out.append((flat[at:at + a * b].reshape(a, b), flat[at + a * b:at + a * b + b]))
        at += a * b + b
    return out


def _first(shape: Shape, sizes: list[tuple[int, int]], fit: int) -> np.ndarray:
    rng, out = np.random.default_rng([shape.seed, fit + 1]), []
    for i, (a, b) in enumerate(sizes):
        bound = ((2.0 if i == len(sizes) - 1 else 6.0) / (a + b)) ** 0.5
        out += [rng.uniform(-bound, bound, a * b), rng.uniform(-bound, bound, b)]
    return np.concatenate(out)


def forward(flat: np.ndarray, sizes: list[tuple[int, int]], x: np.ndarray) -> list[np.ndarray]:
    """Inputs of every layer, and the probabilities."""
    out, layers = [x], _unpacked(flat, sizes)
    for i, (w, b) in enumerate(layers):
        z = out[-1] @ w + b
        out.append(np.maximum(z, 0) if i < len(layers) - 1 else 1 / (1 + np.exp(-np.clip(z, -500, 500))))
    return out


def gradient(flat: np.ndarray, sizes: list[tuple[int, int]], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sum over the rows of the logistic loss's gradient."""
    acts, layers = forward(flat, sizes, x), _unpacked(flat, sizes)
    delta, parts = acts[-1] - y[:, None], []
    for i in range(len(layers) - 1, -1, -1):
        parts.append(np.concatenate([(acts[i].T @ delta).ravel(), delta.sum(0)]))
        if i:
            delta = (delta @ layers[i][0].T) * (acts[i] > 0)
    return np.concatenate(parts[::-1])


def _decay(sizes: list[tuple[int, int]]) -> np.ndarray:
    """1 for weights, 0 for intercepts."""
    return np.concatenate([np.concatenate([np.ones(a * b), np.zeros(b)]) for a, b in sizes])


class Training:
    """One fit in progress: weights, moments, the best epoch so far."""

    def __init__(self, shape: Shape, d: int, fit: int):
        self.shape, self.sizes, self.fit = shape, _sizes(shape, d), fit
        self.flat = _first(shape, self.sizes, fit)
        self.m, self.v, self.t = np.zeros_like(self.flat), np.zeros_like(self.flat), 0
        self.mask = _decay(self.sizes)
        self.best, self.best_flat, self.stale, self.epoch, self.done = -np.inf, self.flat, 0, 0, False
        self.history: list[float] = []

    def step(self, total: np.ndarray, rows: float) -> None:
        if not rows:
            return
        s, g = self.shape, (total + self.shape.l2 * self.mask * self.flat) / rows
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * g
        self.v = 0.999 * self.v + 0.001 * g * g
        self.flat = self.flat - s.rate * (1 - 0.999 ** self.t) ** 0.5 / (1 - 0.9 ** self.t) * self.m / (self.v ** 0.5 + 1e-8)

    def close_epoch(self, right: float, rows: float) -> None:
        """Accuracy of the held-out rows: keeps the best weights and tells when to end."""
        self.epoch += 1
        if rows:
            accuracy = right / rows
            self.history.append(accuracy)
            self.stale = 0 if accuracy > self.best + self.shape.tolerance else self.stale + 1
            if accuracy > self.best:
                self.best, self.best_flat = accuracy, self.flat
        else:
            self.best_flat = self.flat
        self.done = self.stale >= self.shape.patience or self.epoch >= self.shape.epochs

    def order(self, steps: int) -> np.ndarray:
        return np.random.default_rng([self.shape.seed, self.epoch]).permutation(steps)


def held_out(shape: Shape, rid: np.ndarray, fit: int) -> np.ndarray:
    return uniform(rid, shape.seed, fit, 11) < shape.held_out


@dataclass
class Net:
    features: list[str]
    hidden: list[int]
    flat: np.ndarray
    history: list[float]

    def proba(self, x: np.ndarray) -> np.ndarray:
        layers = [len(self.features), *self.hidden, 1]
        return forward(self.flat, list(zip(layers, layers[1:])), np.nan_to_num(x))[-1][:, 0]


_STATE = "fit int, flat array<double>, history array<double>"


def _arrays(pdf: pd.DataFrame, d: int) -> tuple[np.ndarray, ...]:
    x = np.nan_to_num(np.stack(pdf["x"]).astype(np.float64)) if len(pdf) else np.zeros((0, d))
    return pdf["rid"].to_numpy(np.int64), pdf["y"].to_numpy(np.float64), pdf["fold"].to_numpy(np.int64), pdf["step"].to_numpy(np.int64), x


def _packed_rows(frames: Iterator[pd.DataFrame], d: int) -> Iterator[pd.DataFrame]:
    """A batch of rows as one, so that a fit's rows are few arrays."""
    for pdf in frames:
        if len(pdf):
            yield pd.DataFrame({c: [a.tobytes()] for c, a in zip(("rid", "y", "fold", "step", "x"), _arrays(pdf, d))})


def _unpacked_rows(pdf: pd.DataFrame, d: int) -> tuple[np.ndarray, ...]:
    """The rows in order of ``rid``."""
    rid, y, fold, step, x = (np.frombuffer(b"".join(pdf[c]), t) for c, t in (
        ("rid", np.int64), ("y", np.float64), ("fold", np.int64), ("step", np.int64), ("x", np.float64)))
    order = np.argsort(rid, kind="stable")
    return rid[order], y[order], fold[order], step[order], x.reshape(len(rid), d)[order]


def _fit_whole(rows: DataFrame, shape: Shape, fits: Sequence[int], d: int, steps: int) -> dict[int, tuple[np.ndarray, list[float]]]:
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        t = Training(shape, d, fits[key[0]])
        rid, y, fold, step, x = _unpacked_rows(pdf, d)
        use, out = in_fit(fold, t.fit), held_out(shape, rid, t.fit)
        batches = [np.flatnonzero(use & ~out & (step == s)) for s in range(steps)]
        valid = np.flatnonzero(use & out)
        while not t.done:
            for s in t.order(steps):
                b = batches[s]
                t.step(gradient(t.flat, t.sizes, x[b], y[b]), len(b))
            right = ((forward(t.flat, t.sizes, x[valid])[-1][:, 0] >= 0.5) == (y[valid] == 1)).sum()
            t.close_epoch(right, len(valid))
        return pd.DataFrame([(t.fit, t.best_flat.tolist(), t.history)], columns=["fit", "flat", "history"])

    packed = rows.mapInPandas(partial(_packed_rows, d=d), "rid binary, y binary, fold binary, step binary, x binary")
    spread = packed.withColumn("unit", F.explode(F.sequence(F.lit(0), F.lit(len(fits) - 1)))).repartition(8 * len(fits), "unit")
    return {r["fit"]: (np.array(r["flat"]), list(r["history"])) for r in spread.groupBy("unit").applyInPandas(run, _STATE).collect()}


class _Filed:
    """The rows of a fit in local files: those it trains on by batch, and those held out."""

    def __init__(self, shape: Shape, d: int, fit: int, steps: int):
        self.training, self.d, self.steps = Training(shape, d, fit), d, steps
        self.files, self.y, self.rows = [tempfile.TemporaryFile(dir=_local_dir()) for _ in range(2)], ([], []), np.zeros(steps, np.int64)

    def add(self, rid: np.ndarray, y: np.ndarray, step: np.ndarray, x: np.ndarray) -> None:
        """The next rows in order of their batch."""
        out = held_out(self.training.shape, rid, self.training.fit)
        for f, labels, some in zip(self.files, self.y, (~out, out)):
            f.write(x[some].tobytes())
            labels.append(y[some].astype(np.uint8))
        self.rows += np.bincount(step[~out], minlength=self.steps)

    def _read(self, which: int, a: int, b: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        f = self.files[which]
        f.seek(a * self.d * 8)
        for lo in range(a, b, FILED_ROWS):
            y = self.y[which][lo:min(lo + FILED_ROWS, b)]
            yield np.frombuffer(f.read(len(y) * self.d * 8)).reshape(-1, self.d), y.astype(np.float64)

    def trained(self) -> pd.DataFrame:
        t, ends = self.training, np.cumsum(self.rows)
        self.y = [np.concatenate([np.zeros(0, np.uint8), *parts]) for parts in self.y]
        while not t.done:
            for s in t.order(self.steps):
                total = np.zeros(len(t.flat))
                for x, y in self._read(0, ends[s] - self.rows[s], ends[s]):
                    total = total + gradient(t.flat, t.sizes, x, y)
                t.step(total, self.rows[s])
            right = sum(((forward(t.flat, t.sizes, x)[-1][:, 0] >= 0.5) == (y == 1)).sum() for x, y in self._read(1, 0, len(self.y[1])))
            t.close_epoch(right, len(self.y[1]))
        for f in self.files:
            f.close()
        return pd.DataFrame([(t.fit, t.best_flat.tolist(), t.history)], columns=["fit", "flat", "history"])


def _local_dir() -> str | None:
    """The executor's own scratch folder."""
    return os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None


def _fit_filed(rows: DataFrame, shape: Shape, fits: Sequence[int], d: int, steps: int) -> dict[int, tuple[np.ndarray, list[float]]]:
    def encoded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rid, y, fold, step, x = _arrays(pdf, d)
            yield pd.DataFrame({"rid": rid, "y": y, "fold": fold, "step": step, "x": [r.tobytes() for r in x]})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unit, filed = None, None
        for pdf in frames:
            for u, part in pdf.groupby("unit"):
                if u != unit:
                    if filed:
                        yield filed.trained()
                    unit, filed = u, _Filed(shape, d, fits[u], steps)
                filed.add(part["rid"].to_numpy(np.int64), part["y"].to_numpy(np.float64), part["step"].to_numpy(np.int64),
                          np.frombuffer(b"".join(part["x"])).reshape(-1, d))
        if filed:
            yield filed.trained()

    uses = lambda f: F.lit(True) if f == FINAL else (F.col("fold") >= 0) & (F.col("fold") != f)
    units = F.array_compact(F.array(*[F.when(uses(f), i) for i, f in enumerate(fits)]))
    spread = (rows.mapInPandas(encoded, "rid long, y double, fold int, step int, x binary")
              .select("rid", "y", "step", "x", F.explode(units).alias("unit")).repartition(8 * len(fits), "unit")
              .sortWithinPartitions("unit", "step", "rid"))
    found = {r["fit"]: (np.array(r["flat"]), list(r["history"])) for r in spread.mapInPandas(run, _STATE).collect()}
    return {f: found.get(f, (_first(shape, _sizes(shape, d), f), [])) for f in fits}          # a fit may have no rows


def _summed(frames: DataFrame, run: Callable, size: int) -> dict[int, np.ndarray]:
    """Vectors by fit, summed over tasks: in ``SLOTS`` groups each, then here."""
    def add(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for pdf in parts:
            for fit, slot, vec in pdf.itertuples(index=False):
                sums[fit, slot] = sums.get((fit, slot), 0) + np.frombuffer(vec)
        yield pd.DataFrame([(f, s, v.tobytes()) for (f, s), v in sums.items()], columns=["fit", "slot", "vec"])

    kind = "fit int, slot int, vec binary"
    out: dict[int, np.ndarray] = {}
    for r in frames.mapInPandas(run, kind).repartition("fit", "slot").mapInPandas(add, kind).collect():     # fits x SLOTS
        out[r["fit"]] = out.get(r["fit"], np.zeros(size)) + np.frombuffer(r["vec"])
    return out


def _fit_spread(rows: DataFrame, shape: Shape, fits: Sequence[int], d: int, steps: int) -> dict[int, tuple[np.ndarray, list[float]]]:
    spark, path = rows.sparkSession, work_dir(rows.sparkSession, "batches") + "/t"
    rows.write.partitionBy("step").parquet(path)
    every = spark.read.schema(rows.schema).parquet(path)
    training = {f: Training(shape, d, f) for f in fits}

    def sums_of(active: dict[int, np.ndarray], sizes, validate: bool) -> Callable:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            from pyspark import TaskContext
            sums: dict[int, np.ndarray] = {}
            for pdf in frames:
                rid, y, fold, _, x = _arrays(pdf, d)
                for f, flat in active.items():
                    use = np.flatnonzero(in_fit(fold, f) & (held_out(shape, rid, f) == validate))
                    if validate:
                        right = ((forward(flat, sizes, x[use])[-1][:, 0] >= 0.5) == (y[use] == 1)).sum()
                        new = np.array([right, len(use)], np.float64)
                    else:
                        new = np.append(gradient(flat, sizes, x[use], y[use]), len(use))
                    sums[f] = sums.get(f, 0) + new
            slot = TaskContext.get().partitionId() % SLOTS
            yield pd.DataFrame([(f, slot, v.tobytes()) for f, v in sums.items()], columns=["fit", "slot", "vec"])
        return run

    while active := [t for t in training.values() if not t.done]:
        for s in active[0].order(steps):
            batch = every.where(F.col("step") == int(s))
            got = _summed(batch, sums_of({t.fit: t.flat for t in active}, active[0].sizes, False), len(active[0].flat) + 1)
            for t in active:
                if t.fit in got:
                    t.step(got[t.fit][:-1], got[t.fit][-1])
        got = _summed(every, sums_of({t.fit: t.flat for t in active}, active[0].sizes, True), 2)
        for t in active:
            t.close_epoch(*got.get(t.fit, (0.0, 0.0)))
    return {t.fit: (t.best_flat, t.history) for t in training.values()}


def fit(train: DataFrame, features: Sequence[str], label: str, shape: Shape, fits: Sequence[int] = (FINAL,), fold: str | None = None,
        rid: str = "rid", whole_rows: int | None = None, filed_rows: int | None = None) -> dict[int, Net]:
    """A net for each fit (see ``trees.fit``) on standardised features.

    ``filed_rows``: rows that a task may have in a file (default: those that ``FILED_BYTES`` hold, or ``whole_rows`` if given)."""
    n, d = train.count(), len(features)
    if filed_rows is None:
        filed_rows = FILED_BYTES // (8 * d) if whole_rows is None else whole_rows
    if whole_rows is None:
        whole_rows = WHOLE_BYTES // (8 * d + ROW_BYTES)
    steps = max(1, min(MAX_STEPS, -(-n // shape.batch)))
    step = F.pmod(F.xxhash64(F.col(rid), F.lit(shape.seed)), F.lit(steps)).cast("int")
    rows = train.select(F.col(rid).cast("long").alias("rid"), F.col(label).cast("int").alias("y"),
                        (F.col(fold) if fold else F.lit(0)).cast("int").alias("fold"), step.alias("step"),
                        F.array(*[F.col(c).cast("double") for c in features]).alias("x"))
    if not n:
        return {f: Net(list(features), list(shape.hidden), np.zeros(len(_first(shape, _sizes(shape, d), f))), []) for f in fits}
    found = (_fit_whole if n <= whole_rows else _fit_filed if n <= filed_rows else _fit_spread)(rows, shape, list(fits), d, steps)
    return {f: Net(list(features), list(shape.hidden), *found[f]) for f in fits}


def save(net: Net, spark: SparkSession, path: str) -> None:
    spark.createDataFrame([(net.features, net.hidden, net.flat.tolist(), net.history)],
                          "features array<string>, hidden array<int>, flat array<double>, history array<double>").write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> Net:
    r = spark.read.parquet(path).first()
    return Net(list(r["features"]), list(r["hidden"]), np.array(r["flat"]), list(r["history"]))
