"""The tree engine: hand-computed splits, draws, best-first growth, both ways of fitting, saving."""

import numpy as np
import pandas as pd
import pytest

from panelcraft.operators import trees as tr
from panelcraft.session import work_dir

FS = ["f0", "f1", "f2", "f3"]


def table(n=600, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    y = ((x[:, 0] * x[:, 1] + 0.3 * x[:, 2] + 0.3 * rng.normal(size=n)) > 0.4).astype(int)
    return pd.DataFrame({"rid": np.arange(n), "y": y, "fold": np.arange(n) % 3, **{c: x[:, i] for i, c in enumerate(FS)}})


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(table()).repartition(4).cache()


def hist_of(x, stats, width):
    return tr.histogram(np.array(x, np.uint8)[:, None], np.zeros(len(x), int), np.array([[0]]), [np.array(s, float) for s in stats], width)


def test_second_order_gain_by_hand():
    # gradients -1 -1 | +2, hessians 1: G = 0, H = 3; left -2/2, right 2/1
    h = hist_of([0, 0, 1], [[-1, -1, 2], [1, 1, 1], [1, 1, 1]], 2)
    for l2, want in ((0.0, 4 / 2 + 4 / 1), (1.0, 4 / 3 + 4 / 2)):
        s = tr.best_splits(h, np.array([[0]]), tr.Growth("boost", 1, l2=l2))[0]
        assert s.gain == pytest.approx(want) and (s.column, s.cut) == (0, 0) and s.total == (0, 3, 3) and s.left == (-2, 2, 2)
    for g in (tr.Growth("boost", 1, min_hessian=1.5), tr.Growth("boost", 1, min_rows=2)):
        assert tr.best_splits(h, np.array([[0]]), g)[0].gain == 0


def test_gini_gain_by_hand():
    # labels 1 1 0 0 by bin 0 0 1 1, unit weights: g = -y; 4/2 + 0 - 4/4 = 1, half of n * (gini before - after) * 2
    s = tr.best_splits(hist_of([0, 0, 1, 1], [[-1, -1, 0, 0], [1] * 4, [1] * 4], 2), np.array([[0]]), tr.Growth("bag", 1))[0]
    assert s.gain == pytest.approx(1.0)
    p = lambda k, n: 2 * k / n * (1 - k / n)
    assert s.gain == pytest.approx(4 * (p(2, 4) - 0) / 2)


def test_first_feature_and_cut_win_ties_and_constants_stay():
    x = np.array([[0, 0], [0, 0], [1, 1], [1, 1]], np.uint8)
    h = tr.histogram(x, np.zeros(4, int), np.array([[0, 1]]), [np.array([-1., -1, 0, 0]), np.ones(4), np.ones(4)], 4)
    s = tr.best_splits(h, np.array([[0, 1]]), tr.Growth("bag", 1))[0]
    assert (s.column, s.cut) == (0, 0)
    assert tr.best_splits(hist_of([3, 3], [[-1, 0], [1, 1], [1, 1]], 5), np.array([[0]]), tr.Growth("bag", 1))[0].column == -1


def test_best_first_takes_the_greatest_gains():
    g = tr.Growth("boost", 1, max_leaves=3)
    t = tr.Tree(g)
    sp = lambda gain: tr.Split((0.0, 10.0, 10.0), gain, 0, 0, (-1.0, 5.0, 5.0))
    t.advance([sp(5)])
    assert t.frontier == [1, 2]
    t.advance([sp(1), sp(2)])                        # one split is left: the right child's
    assert t.children[1] is None and t.children[2] == (3, 4)
    t.advance([sp(9), sp(9)])
    assert t.frontier == [] and (t.arrays()["column"] >= 0).sum() == 2


def test_best_first_equals_growing_one_split_at_a_time():
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 20, (400, 3)).astype(np.uint8), rng.integers(0, 2, 400)
    g, info = tr.Growth("boost", 1, max_leaves=9, min_rows=5), tr.FitInfo(tr.FINAL, (1.0, 1.0), (1.0, 1.0), 0.0)
    stats = [0.5 - y, np.full(400, 0.25), np.ones(400)]
    got = tr._grow_whole(g, info, 0, x, stats, 20)
    leaves, cols = [np.arange(400)], np.array([[0, 1, 2]])
    for _ in range(8):
        best = [tr.best_splits(tr.histogram(x[r], np.zeros(len(r), int), cols, [s[r] for s in stats], 20), cols, g)[0] for r in leaves]
        i = max(range(len(leaves)), key=lambda k: best[k].gain)
        s, r = best[i], leaves.pop(i)
        goes = x[r, s.column] <= s.cut
        leaves += [r[goes], r[~goes]]
    ends = tr.leaves_of(x, got)
    assert {frozenset(np.flatnonzero(ends == e)) for e in np.unique(ends)} == {frozenset(r) for r in leaves}


def test_draws_have_their_shares_and_depend_on_the_row_alone():
    rid, y = np.arange(200_000), (np.arange(200_000) % 10 == 0).astype(int)
    info = tr.FitInfo(0, (1.0, 1.0), (1 / 9, 1.0), 0.0)
    boot = tr.row_weights(tr.Growth("bag", 1, sample="bootstrap"), info, 3, rid, y)
    assert boot.mean() == pytest.approx(1, abs=0.01) and boot.var() == pytest.approx(1, abs=0.02) and boot.max() > 4
    bal = tr.row_weights(tr.Growth("bag", 1, sample="balanced"), info, 3, rid, y)
    assert bal[y == 1].mean() == 1 and bal[y == 0].sum() == pytest.approx(20_000, rel=0.03)
    sub = tr.row_weights(tr.Growth("boost", 1, row_share=0.85), info, 3, rid, y)
    assert sub.mean() == pytest.approx(0.85, abs=0.005)
    assert (tr.row_weights(tr.Growth("bag", 1, sample="bootstrap"), info, 3, rid[::-7], y[::-7]) == boot[::-7]).all()
    assert (tr.row_weights(tr.Growth("bag", 1, sample="bootstrap"), info, 4, rid, y) != boot).any()
    cols = tr.columns_of(tr.Growth("bag", 1, split_columns=2), info, 0, range(500), 6)
    assert cols.shape == (500, 2) and (np.diff(cols) > 0).all() and set(np.bincount(cols.ravel())) and len(np.unique(cols)) == 6
    assert tr.columns_of(tr.Growth("boost", 1, column_share=0.5), info, 0, [0, 1], 6).shape == (2, 3)


GROWTHS = [tr.Growth("bag", 6, max_depth=5, min_rows=2, split_columns=2, sample="bootstrap", weights="balanced", cuts=31),
           tr.Growth("bag", 3, min_rows=2, split_columns=2, sample="balanced", random_cut=True, cuts=31),
           tr.Growth("boost", 3, max_leaves=6, rate=0.3, min_rows=5, weights="balanced", cuts=31),
           tr.Growth("boost", 5, max_depth=2, rate=0.3, l2=3, min_hessian=3, row_share=0.85, column_share=0.85, weights="positive", cuts=31)]


@pytest.mark.parametrize("g", GROWTHS, ids=["bootstrap", "random_cut", "best_first", "second_order"])
def test_both_ways_grow_the_same_trees(data, g, monkeypatch):
    monkeypatch.setattr(tr, "REWRITE", 2)
    monkeypatch.setattr(tr, "NODES_AT_ONCE", 20)
    fits = [tr.FINAL, 0]
    a, b = tr.fit(data, FS, "y", g, fits, "fold"), tr.fit(data, FS, "y", g, fits, "fold", whole_rows=10)
    x = table()[FS].to_numpy()
    for f in fits:
        assert len(a[f].root) == g.trees and np.abs(a[f].proba(x) - b[f].proba(x)).max() < 1e-12
        assert (a[f].column == b[f].column).all() and a[f].importances().sum() == pytest.approx(1)


def test_folds_leave_rows_out_and_synthetic_rows_stay_with_the_final_fit(spark):
    t = table(300)
    t["f0"] = t["y"] * 2.0 - 1                       # separates
    extra = t.head(60).assign(rid=-1 - np.arange(60), fold=tr.ONLY_FINAL, y=1 - t["y"].head(60))
    df = spark.createDataFrame(pd.concat([t, extra]))
    m = tr.fit(df, FS, "y", tr.Growth("bag", 5, max_depth=3), [tr.FINAL, 0, 1], "fold")
    x = t[FS].to_numpy()
    assert ((m[0].proba(x) >= 0.5) == (t["y"] == 1)).all() and (m[tr.FINAL].proba(x)[:60] > 0).all()
    infos, n = tr._infos(tr.binned(df, FS, [np.array([0.0])] * 4, "y", "fold", "rid"), tr.Growth("bag", 1), [tr.FINAL, 0])
    assert n == 360


def test_missing_values_constants_one_class_and_no_rows(spark):
    t = table(200)
    t["f1"], t["f2"] = 1.0, np.nan
    t.loc[::5, "f0"] = np.nan
    df = spark.createDataFrame(t)
    g = tr.Growth("boost", 3, max_depth=3, weights="positive")
    m = tr.fit(df, FS, "y", g)[tr.FINAL]
    assert not {1, 2} & set(m.column.tolist()) and np.isfinite(m.proba(t[FS].to_numpy())).all()
    one = tr.fit(df.where("y = 0"), FS, "y", tr.Growth("bag", 2))[tr.FINAL]
    assert (one.proba(t[FS].to_numpy()) == 0).all()
    none = tr.fit(df.where("rid < 0"), FS, "y", g)[tr.FINAL]
    assert len(np.unique(none.proba(t[FS].to_numpy()))) == 1


def test_saved_trees_score_alike(spark, data):
    m = tr.fit(data, FS, "y", GROWTHS[3])[tr.FINAL]
    path = work_dir(spark, "test-trees")
    tr.save(m, spark, path)
    x = table()[FS].to_numpy()
    assert (tr.load(spark, path).proba(x) == m.proba(x)).all()
    assert ((m.proba(x) >= 0.5) == table()["y"]).mean() > 0.7


def whole(g, pdf, bins, width):
    info = tr.FitInfo(tr.FINAL, (1.0, 2.0), (1.0, 1.0), -0.5)
    rid, y, fold = (pdf[c].to_numpy() for c in ("rid", "y", "fold"))
    return [a for _, a in tr._whole_unit(g, info, range(g.trees), rid, y, fold, bins, width)]


@pytest.mark.parametrize("g", [
    tr.Growth("boost", 6, max_leaves=12, rate=0.3, min_rows=5),
    tr.Growth("boost", 6, max_depth=4, rate=0.3, row_share=0.8, column_share=0.6, min_hessian=1, l2=1),
    tr.Growth("boost", 6, max_depth=3, rate=0.3, random_cut=True)])
def test_many_rows_boost_the_same_trees_from_half_the_rows(g, monkeypatch):
    pdf, rng = table(4000, seed=3), np.random.default_rng(5)
    fine = np.stack([np.searchsorted(np.sort(pdf[c])[::40], pdf[c]) for c in FS], 1)
    bins = np.concatenate([fine, rng.integers(0, 4, (4000, 3)), rng.integers(0, 9, (4000, 1)), np.zeros((4000, 1), int)], 1).astype(np.uint8)
    old = whole(g, pdf, bins, 101)
    seen = []
    sums = tr.Joint.sums
    monkeypatch.setattr(tr, "HALVES_FROM", 1)
    monkeypatch.setattr(tr, "JOINT_FROM", 700)              # both sizes of joint columns
    monkeypatch.setattr(tr.Joint, "sums", lambda self, rows, *a: (seen.append(4000 if rows is None else len(rows)), sums(self, rows, *a))[1])
    new = whole(g, pdf, bins, 101)
    for a, b in zip(old, new, strict=True):
        assert all(np.array_equal(a[p], b[p]) for p in ("column", "cut", "left", "right"))
        assert a["value"] == pytest.approx(b["value"], abs=1e-7)
    depth = 12 if g.max_leaves else g.max_depth
    assert len(seen) > 6 and sum(seen) <= 6 * 4000 * (1 + (depth - 1) / 2)


def test_exact_sums_do_not_depend_on_order():
    rng = np.random.default_rng(2)
    x = tr.exact(rng.normal(size=10_001) * 3)
    total = np.cumsum(x)[-1]
    assert all(np.cumsum(rng.permutation(x))[-1] == total for _ in range(20))
    assert total - np.cumsum(x[:4000])[-1] == np.cumsum(x[4000:])[-1]
    assert not tr.exact(np.zeros(3)).any() and len(tr.exact(np.zeros(0))) == 0 and tr.exact(np.array([1e-310])).shape == (1,)


def test_fits_of_a_boosted_model_meet_in_no_task(spark):
    from pyspark.sql import functions as F
    for n in (1, 6):
        unit = spark.range(n).select(F.pmod(F.hash(F.col("id").cast("int")), F.lit(tr.PARTITIONS_A_UNIT * n)).alias("p"))
        assert unit.distinct().count() == n


def test_histogram_of_either_layout_and_of_some_rows():
    rng = np.random.default_rng(4)
    bins, slot, s = rng.integers(0, 7, (200, 5)).astype(np.uint8), rng.integers(0, 3, 200), rng.normal(size=200)
    columns, rows = np.array([[0, 2], [1, 4], [3, 4]]), np.sort(rng.choice(200, 90, replace=False))
    for b in (bins, np.asfortranarray(bins)):
        for r in (None, rows):
            at = np.arange(200) if r is None else r
            want = np.zeros((3, 2, 7, 2))
            for i in at:
                for j in range(2):
                    want[slot[i], j, bins[i, columns[slot[i], j]]] += s[i], 1
            assert tr.histogram(b, slot[at], columns, [s[at], None], 7, r) == pytest.approx(want)
