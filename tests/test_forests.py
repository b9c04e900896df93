"""Forests as tables: scoring without bringing trees to the driver, levels held in parts, saving, the bound of the whole way."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcraft.operators import models as md
from panelcraft.operators import nets
from panelcraft.operators import trees as tr
from panelcraft.session import work_dir

FS = ["f0", "f1", "f2", "f3"]
DEEP = tr.Growth("bag", 7, min_rows=1, split_columns=2, sample="bootstrap", weights="balanced", cuts=31)


def table(n=400, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    y = ((x[:, 0] * x[:, 1] + 0.5 * rng.normal(size=n)) > 0.2).astype(int)
    return pd.DataFrame({"rid": np.arange(n), "y": y, "fold": np.arange(n) % 3, **{c: x[:, i] for i, c in enumerate(FS)}})


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(table()).repartition(4).cache()


@pytest.fixture
def apart(monkeypatch):
    """Every forest counts as large, in blocks of two trees and parts of 100 rows."""
    monkeypatch.setattr(md, "SENT_NODES", 0)
    monkeypatch.setattr(md, "ROWS_A_BLOCK", 100)
    monkeypatch.setattr(tr, "BLOCK", 2)
    monkeypatch.setattr(tr.Forest, "model", property(lambda self: pytest.fail("the trees came to the driver")))


def test_large_forests_score_and_weigh_features_without_the_driver(spark, data, request):
    fits = [tr.FINAL, 0, 1, 2]
    forests = tr.fit(data, FS, "y", DEEP, fits, "fold")
    boosted = tr.fit(data, FS, "y", tr.Growth("boost", 3, max_depth=2), fits, "fold")
    t = table()
    x = t[FS].to_numpy()
    proba = {f: m.model.proba(x) for f, m in forests.items()}
    weights = forests[0].model.importances()
    request.getfixturevalue("apart")
    scored = md.score_fitted({f: [m] for f, m in forests.items()}, data, FS, ["rid", "fold"], "fold").toPandas().set_index("rid")
    assert len(scored) == 400 and list(scored.columns) == ["fold", "score"]
    want = np.array([proba[f][i] for i, f in enumerate(t["fold"])])
    assert np.abs(scored.loc[t["rid"], "score"].to_numpy() - want).max() < 1e-12
    both = md.score_fitted({f: [forests[f], boosted[f]] for f in fits}, data, FS, ["rid"]).toPandas().set_index("rid")
    want = (proba[tr.FINAL] + boosted[tr.FINAL].proba(x)) / 2
    assert np.abs(both.loc[t["rid"], "score"].to_numpy() - want).max() < 1e-12
    assert (forests[0].importances() == weights).all()


def test_rows_without_or_with_equal_keys_keep_their_own_scores(spark, data, apart):
    forest = tr.fit(data, FS, "y", DEEP)[tr.FINAL]
    rows = data.withColumn("rid", F.when(F.col("rid") % 2 == 0, 7)).withColumn("f0", F.when(F.col("y") == 1, F.col("f0")))
    got = md.score_fitted({tr.FINAL: [forest]}, rows, FS, ["rid", "y"])
    assert got.count() == 400 and got.where("score is null or rid is null").count() == 200
    assert md.score_fitted({tr.FINAL: [forest]}, rows.where("y > 1"), FS, ["rid"]).count() == 0


def test_rows_of_one_file_are_scored_by_many_tasks(spark, data, monkeypatch):
    monkeypatch.setattr(md, "ROWS_TO_SCORE", 100)
    forest = tr.fit(data, FS, "y", DEEP)[tr.FINAL]
    scored = md.score_fitted({tr.FINAL: [forest]}, data.coalesce(1), FS, ["rid"]).withColumn("task", F.spark_partition_id()).toPandas()
    assert sorted(scored["rid"]) == list(range(400)) and scored["task"].value_counts().tolist() == [100] * 4
    assert (scored.set_index("rid").loc[range(400), "score"].to_numpy() == forest.proba(table()[FS].to_numpy())).all()


def test_saved_forest_scores_alike(spark, data):
    forest = tr.fit(data, FS, "y", DEEP, [tr.FINAL, 1], "fold")[1]
    path = work_dir(spark, "test-forest")
    tr.save(forest, spark, path)
    loaded, x = tr.load(spark, path), table()[FS].to_numpy()
    assert (loaded.proba(x) == forest.proba(x)).all() and (loaded.fit, loaded.trees, loaded.nodes) == (1, 7, forest.nodes)


@pytest.mark.parametrize("random_cut", [False, True])
def test_levels_held_in_parts_grow_what_a_tree_grows(monkeypatch, random_cut):
    rng = np.random.default_rng(8)
    x, y = rng.integers(0, 20, (500, 4)).astype(np.uint8), rng.integers(0, 2, 500)
    g, info = tr.Growth("bag", 1, min_rows=2, split_columns=2, random_cut=random_cut), tr.FitInfo(tr.FINAL, (1.0, 1.0), (1.0, 1.0), 0.0)
    stats = [-0.7 * y, np.full(500, 0.7), None]
    monkeypatch.setattr(tr, "NODES_IN_TASK", 3)
    got, want = tr._grow_levels(g, info, 0, x, stats, 20), tr._grow_best_first(g, info, 0, x, stats, 20)
    assert len(got["column"]) > 50 and all((got[p] == want[p]).all() for p in want)


def test_tables_of_more_than_50000_rows_are_grown_in_tasks(spark, monkeypatch):
    """The rows of the six-fold tables and their synthetic ones, and of the sixty-fold ones, fit the bounds."""
    for m in (tr, nets):
        monkeypatch.setattr(m, "_fit_spread", lambda *a: pytest.fail("one pass for each level or batch"))
    assert tr.WHOLE_BYTES // (28 + tr.ROW_BYTES) > 2_016_000 and nets.WHOLE_BYTES // (8 * 28 + nets.ROW_BYTES) > 700_000
    df = spark.range(51_000).select(F.col("id").alias("rid"), (F.col("id") % 7 > 2).cast("int").alias("y"),
                                    *[F.pmod(F.col("id"), F.lit(7 + i)).cast("double").alias(c) for i, c in enumerate(FS)])
    assert tr.fit(df, FS, "y", tr.Growth("boost", 2, max_depth=2))[tr.FINAL].proba(np.zeros((1, 4))).shape == (1,)
    assert len(nets.fit(df, FS, "y", nets.Shape(hidden=(2,), epochs=1))[tr.FINAL].history) == 1


@pytest.mark.parametrize("sample", ["all", "bootstrap", "balanced"])
@pytest.mark.parametrize("random_cut", [False, True])
@pytest.mark.parametrize("dense_from, at_once", [(0, 60), (8, 1 << 16), (10 ** 9, 60)])
def test_many_rows_grow_the_same_trees_without_a_bin_for_every_node(monkeypatch, sample, random_cut, dense_from, at_once):
    """Weights are powers of two, so the plain way's sums are exact as well."""
    from panelcraft.operators import counted
    n, rng = 2500, np.random.default_rng(3)
    x = rng.integers(0, 30, (n, 5)).astype(np.uint8)
    x[:, 3] %= 3
    y = ((x[:, 0] > 12) ^ (rng.random(n) < 0.3)).astype(np.int64)
    info, rows = tr.FitInfo(tr.FINAL, (0.5, 2.0), (0.7, 1.0), 0.0), (np.arange(n), y, np.zeros(n, int), x, 31)
    for depth, least in ((None, 1), (None, 2), (6, 2)):
        g = tr.Growth("bag", 2, max_depth=depth, min_rows=least, split_columns=2, sample=sample, random_cut=random_cut)
        plain = [t for _, t in tr._whole_unit(g, info, range(2), *rows)]
        with monkeypatch.context() as many:
            many.setattr(tr, "HALVES_FROM", 1000)
            many.setattr(counted, "DENSE_FROM", dense_from)
            many.setattr(counted, "ROWS_AT_ONCE", at_once)
            many.setattr(tr, "histogram", lambda *a: pytest.fail("a bin for every node"))
            found = [t for _, t in tr._whole_unit(g, info, range(2), *rows)]
        for a, b in zip(found, plain, strict=True):
            assert len(b["column"]) > 50 and all(a[p].dtype == b[p].dtype and (a[p] == b[p]).all() for p in b)


def test_many_rows_of_one_class_or_none_give_one_leaf():
    from panelcraft.operators import counted
    for one in (np.ones(9, bool), np.zeros(9, bool)):
        t = counted.grow((1.0, 1.0), 1, None, np.arange(9, dtype=np.uint8)[:, None], one, None, 9, lambda nodes: np.zeros((len(nodes), 1), int), lambda *a: None)
        assert t["column"].tolist() == [-1] and t["value"].tolist() == [float(one[0])]


def test_rows_and_synthetic_rows_of_6_gb_fit_the_bound_of_one_task():
    """2,016,000 training rows, 411,000 of them of the smaller class: 3,210,000 with synthetic ones."""
    assert tr.WHOLE_BYTES // (28 + tr.ROW_BYTES) > 3_210_000


def test_trees_in_parts_come_one_at_a_time_and_score_alike(spark, data, monkeypatch):
    x, fits = table()[FS].to_numpy(), [tr.FINAL, 1]
    one = tr.fit(data, FS, "y", DEEP, fits, "fold")
    plain = {f: (m.proba(x), m.importances()) for f, m in one.items()}
    monkeypatch.setattr(tr, "PART_NODES", 8)
    forests = tr.fit(data, FS, "y", DEEP, fits, "fold")
    assert forests[1].table.groupBy("fit", "tree").count().agg(F.min("count")).first()[0] > 3
    for f, m in forests.items():
        assert (m.trees, m.nodes) == (one[f].trees, one[f].nodes) and (m.proba(x) == plain[f][0]).all()
        assert np.abs(m.importances() - plain[f][1]).max() < 1e-12
    held, kept = [], tr.arrays_of
    monkeypatch.setattr(tr, "arrays_of", lambda parts: (held.append(len({r["tree"] for r in parts})), kept(parts))[1])
    assert len(tr._trees_of(forests[1].rows().collect())) == 7 and set(held) == {1}


def test_rows_go_to_the_units_of_their_own_fits_alone(spark, data, monkeypatch):
    """Synthetic rows to the final fit's, a fold's rows to those of the others; a fit without rows gives a constant."""
    seen = spark.sparkContext.accumulator(0)
    kept = tr._gathered

    def counted(batches, d):
        out = kept(batches, d)
        seen.add(len(out[0]))
        return out

    monkeypatch.setattr(tr, "_gathered", counted)
    g = tr.Growth("boost", 1, max_depth=1)
    tr.fit(data.withColumn("fold", F.when(F.col("rid") < 100, tr.ONLY_FINAL).otherwise(F.col("fold").cast("int"))), FS, "y", g, [tr.FINAL, 0, 1, 2], "fold")
    assert seen.value == 400 + 2 * 300
    assert (tr.fit(data.withColumn("fold", F.lit(0)), FS, "y", DEEP, [0], "fold")[0].proba(np.zeros((3, 4))) == 0).all()
