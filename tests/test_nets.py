"""The perceptron: gradients, early stopping, both ways of fitting, saving."""

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from panelcraft.operators import nets
from panelcraft.operators.trees import FINAL
from panelcraft.session import work_dir

FS = ["a", "b"]


def table(n=500):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(n, 2))
    return pd.DataFrame({"rid": np.arange(n), "y": ((x[:, 0] * x[:, 1]) > 0).astype(int), "fold": np.arange(n) % 2, "a": x[:, 0], "b": x[:, 1]})


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(table()).repartition(3).cache()


def test_gradient_by_differences():
    sizes, rng = [(2, 3), (3, 1)], np.random.default_rng(0)
    flat, x, y = rng.normal(size=13), rng.normal(size=(7, 2)), rng.integers(0, 2, 7).astype(float)
    def loss(v):
        p = nets.forward(v, sizes, x)[-1][:, 0]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()
    got = nets.gradient(flat, sizes, x, y)
    for i in range(13):
        e = np.eye(13)[i] * 1e-6
        assert got[i] == pytest.approx((loss(flat + e) - loss(flat - e)) / 2e-6, abs=1e-5)
    assert got == pytest.approx(nets.gradient(flat, sizes, x[:3], y[:3]) + nets.gradient(flat, sizes, x[3:], y[3:]))


def test_stops_early_with_the_best_epoch(data):
    shape = nets.Shape(hidden=(16,), batch=50, rate=0.01, epochs=500)
    net = nets.fit(data, FS, "y", shape, [FINAL])[FINAL]
    t = table()
    out = nets.held_out(shape, t["rid"].to_numpy(), FINAL)
    accuracy = ((net.proba(t[FS].to_numpy()) >= 0.5) == (t["y"] == 1))[out].mean()
    assert 10 < len(net.history) < 500
    assert accuracy == pytest.approx(max(net.history)) and accuracy > 0.85
    best = int(np.argmax(net.history))
    assert len(net.history) - 1 - best >= shape.patience


def test_best_epoch_is_kept_when_later_ones_are_worse():
    t = nets.Training(nets.Shape(hidden=(2,), patience=3), 2, FINAL)
    for right, value in ((5, 1.0), (9, 2.0), (9, 3.0), (4, 4.0), (9, 5.0)):
        t.flat = np.full_like(t.flat, value)
        t.close_epoch(right, 10)
    assert t.done and (t.best_flat == 2.0).all() and t.history == [0.5, 0.9, 0.9, 0.4, 0.9]


def test_l2_shrinks_weights_not_intercepts():
    t = nets.Training(nets.Shape(hidden=(2,), l2=10.0), 2, FINAL)
    before = np.abs(t.flat)
    for _ in range(50):
        t.step(np.zeros_like(t.flat), 1)
    assert (np.abs(t.flat[t.mask == 1]) <= before[t.mask == 1]).all() and (np.abs(t.flat) == before)[t.mask == 0].all()


def test_both_ways_train_the_same_net(data):
    shape = nets.Shape(hidden=(4,), batch=200, rate=0.01, epochs=2)
    a, b = (nets.fit(data, FS, "y", shape, [FINAL, 0], "fold", whole_rows=w) for w in (1000, 10))
    x = table()[FS].to_numpy()
    for f in (FINAL, 0):
        assert np.abs(a[f].proba(x) - b[f].proba(x)).max() < 1e-9 and a[f].history == pytest.approx(b[f].history)
    assert np.abs(a[FINAL].proba(x) - a[0].proba(x)).max() > 1e-6


def test_missing_values_no_rows_and_saving(spark, data):
    net = nets.fit(data, FS, "y", nets.Shape(hidden=(3,), epochs=2))[FINAL]
    path = work_dir(spark, "test-net")
    nets.save(net, spark, path)
    x = np.array([[np.nan, 1.0], [0.0, 1.0]])
    assert (nets.load(spark, path).proba(x) == net.proba(x)).all() and net.proba(x)[0] == net.proba(x)[1]
    assert (nets.fit(data.where("rid < 0"), FS, "y", nets.Shape(hidden=(3,)))[FINAL].proba(x) == 0.5).all()


def test_rows_in_a_file_train_the_net_of_rows_in_memory(data, monkeypatch):
    """A job a batch takes minutes an epoch on millions of rows."""
    monkeypatch.setattr(nets, "_fit_spread", lambda *a: pytest.fail("one job for each batch"))
    monkeypatch.setattr(nets, "FILED_BYTES", 8 * len(FS) * 1_000_000)
    shape = nets.Shape(hidden=(6, 4), epochs=4, batch=50)
    a = nets.fit(data, FS, "y", shape, [FINAL, 0, 1], "fold", whole_rows=10 ** 6)
    monkeypatch.setattr(nets, "WHOLE_BYTES", 0)
    b = nets.fit(data, FS, "y", shape, [FINAL, 0, 1], "fold")
    for f in (FINAL, 0, 1):
        assert a[f].history == b[f].history and len(a[f].history) > 1 and np.abs(a[f].flat - b[f].flat).max() < 1e-12
    synthetic = data.withColumn("fold", F.lit(-2))
    c = nets.fit(synthetic, FS, "y", shape, [FINAL, 0], "fold")
    assert len(c[FINAL].history) > 1 and c[0].history == []
