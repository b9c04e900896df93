"""Fitted models of every kind, on small separable data and with few trees."""

import pytest
from pyspark.sql import functions as F

from panelcraft.operators import evaluate as ev
from panelcraft.operators import models as md
from panelcraft.operators import nets
from panelcraft.operators import sampling as sm
from panelcraft.operators import trees as tr
from panelcraft.session import work_dir, written

X = ["a", "b"]
SMALL = {"rf": {"numTrees": 10, "maxDepth": 4}, "gbt": {"maxIter": 5}, "gbt_sub": {"maxIter": 5}, "mlp": {"maxIter": 60, "hidden": (4,)}}


@pytest.fixture(scope="module")
def data(spark):
    df = spark.range(300).select(
        F.col("id").alias("rid"), (F.col("id") % 5 == 0).cast("int").alias("flag"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0).alias("a"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 1000.0).alias("b"))
    df = df.withColumn("a", F.col("a") + 2 * F.col("flag"))
    return written(sm.stratified_folds(df, "flag", ["rid"], 5, 1), "test-models")


@pytest.mark.parametrize("kind", list(SMALL))
def test_every_kind_separates(data, kind):
    m = md.fit(data, X, md.estimator(kind, 2, "flag", **SMALL[kind]))
    s = md.score(m, data, ["rid", "flag"])
    assert ev.roc_auc(s, "flag", "score").first()["auc"] > 0.95
    assert s.where(~F.col("score").between(0, 1)).count() == 0


def test_sizes_default_to_the_published_ones():
    assert md.estimator("rf", 2).getNumTrees() == 500 and md.estimator("rf", 2).getMaxDepth() == 12
    assert md.estimator("gbt", 2).getMaxIter() == md.estimator("gbt_sub", 2).getMaxIter() == 400
    assert md.estimator("mlp", 2).getMaxIter() == 1000


def test_weights_are_attached_without_a_join(data):
    for mode in ("balanced", "positive"):
        w = sm.with_class_weight(data, "flag", "w", mode)
        assert {r["flag"]: r["w"] for r in w.select("flag", "w").distinct().collect()} == (
            {0: 0.625, 1: 2.5} if mode == "balanced" else {0: 1.0, 1: 4.0})
    assert "Join" not in w._jdf.queryExecution().optimizedPlan().toString()


def test_bags_are_balanced_and_members_are_averaged(data):
    bags = sm.balanced_bags(data.select("rid", "flag", *X), "flag", ["rid"], 7, 3, 1)
    per = bags.groupBy("bag", "flag").count().collect()
    assert len(per) == 14 and {r["count"] for r in per} == {60}
    models = [md.fit(bags.where(F.col("bag") == b), X, md.estimator("rf", 2, "flag", numTrees=1, maxDepth=3)) for b in range(2)]
    vote = md.score_vote(models, data, ["rid", "flag"], "rid")
    singles = [{r["rid"]: r["score"] for r in md.score(m, data, ["rid"]).collect()} for m in models]
    for r in vote.collect():
        assert r["score"] == pytest.approx(sum(s[r["rid"]] for s in singles) / 2)


def test_vote_in_several_passes(data, monkeypatch):
    models = [md.fit(data, X, md.estimator("rf", 2, "flag", numTrees=2, maxDepth=2, seed=i)) for i in range(5)]
    once = {r["rid"]: r["score"] for r in md.score_vote(models, data, ["rid", "flag"], "rid").collect()}
    monkeypatch.setattr(md, "MEMBERS_AT_ONCE", 2)
    for r in md.score_vote(models, data, ["rid", "flag"], "rid").collect():
        assert r["score"] == pytest.approx(once[r["rid"]])


def test_folds_cover_all_rows_and_give_f1(data):
    models = {f: [m] for f, m in tr.fit(data, X, "flag", tr.Growth("bag", 10, max_depth=4), range(5), "fold").items()}
    s = written(md.score_fitted(models, data, X, ["rid", "flag", "fold"], "fold"), "test-folds")
    assert s.count() == s.select("rid").distinct().count() == 300
    assert md.cv_f1(s, "flag").first()["cv_f1"] > 0.9


def test_members_of_any_kind_are_averaged_saved_and_loaded(spark, data):
    scaled = sm.apply_standardizer(data, sm.fit_standardizer(data, X))
    members = [tr.fit(scaled, X, "flag", tr.Growth("boost", 5, max_depth=2))[tr.FINAL],
               nets.fit(scaled, X, "flag", nets.Shape(hidden=(4,), epochs=5))[tr.FINAL]]
    each = [{r["rid"]: r["score"] for r in md.score_fitted({tr.FINAL: [m]}, scaled, X, ["rid"]).collect()} for m in members]
    path = work_dir(spark, "test-members")
    md.save_model(members, md.scaler_model(sm.fit_standardizer(data, X)), spark.createDataFrame([("vote",)], "model string"), path)
    loaded, scaler, meta = md.load_model(spark, path)
    assert meta.first()["members"] == ["trees", "net"]
    for r in md.score_fitted({tr.FINAL: loaded}, scaler.transform(data), X, ["rid"]).collect():
        assert r["score"] == pytest.approx((each[0][r["rid"]] + each[1][r["rid"]]) / 2)


def test_importance_prefers_the_feature_that_separates(spark, data):
    m = md.fit(data, X, md.estimator("rf", 2, "flag", **SMALL["rf"]))
    assert md.feature_importance([m], X, spark, 2).first()["feature"] == "a"
    grown = tr.fit(data, X, "flag", tr.Growth("bag", 5, max_depth=3))[tr.FINAL]
    assert md.feature_importance([grown], X, spark, 2).first()["feature"] == "a"


def test_saved_model_scores_raw_rows_alike(spark, data):
    raw = data.withColumn("a", F.col("a") * 1000 + 7)
    stats = sm.fit_standardizer(raw, X)
    scaled = sm.apply_standardizer(raw, stats)
    models = [md.fit(scaled, X, md.estimator(k, 2, "flag", **SMALL[k])) for k in ("rf", "gbt")]
    path = work_dir(spark, "test-save")
    md.save_model(models, md.scaler_model(stats), spark.createDataFrame([("vote", 0.4)], "model string, threshold double"), path)
    loaded, scaler, meta = md.load_model(spark, path)
    a = {r["rid"]: r["score"] for r in md.score_vote(models, scaled, ["rid", "flag"], "rid").collect()}
    b = {r["rid"]: r["score"] for r in md.score_vote(loaded, scaler.transform(raw), ["rid", "flag"], "rid").collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k]) for k in a)
    assert meta.first()["threshold"] == 0.4


def test_scaler_of_a_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    rows = md.scaler_model(sm.fit_standardizer(df, X)).transform(df).collect()
    assert [(r["a"], r["b"]) for r in rows] == [(-1.0, 0.0), (1.0, 0.0)]


def test_threshold_is_tuned_on_other_rows(spark):
    test = spark.createDataFrame([(1, 0.8), (0, 0.6), (0, 0.1)], "y int, score double")
    tune = spark.createDataFrame([(1, 0.3), (0, 0.2)], "y int, score double")
    assert md.evaluate("m", test, "y", tune).first()["threshold"] < 0.31 < 0.6 < md.evaluate("m", test, "y", None).first()["threshold"]


def test_one_rule_for_rows_without_a_score(spark):
    rows = [(1, 0.9), (0, 0.1), (0, float("nan")), (1, float("nan")), (1, None)]
    df = spark.createDataFrame(rows, "y int, score double")
    want = {"tp": 1, "fp": 0, "fn": 0, "tn": 1}
    assert {k: ev.confusion_at(df, "y", "score", 0.5).first()[k] for k in want} == want
    at = ev.threshold_sweep(df, "y", "score", 50, 51).first()
    assert {k: at[k] for k in want} == want
    assert ev.roc_auc(df, "y", "score").first()["auc"] == 1.0
    top = ev.roc_curve(df, "y", "score", origin=True).orderBy("threshold").collect()
    assert [(r["tp"], r["fp"]) for r in top] == [(1, 1), (1, 0), (0, 0)]
    assert ev.unscored(df, "score").first()["n_unscored"] == 3


def test_lsh_neighbours_have_good_recall(spark):
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding")
    exact = {(r["vec_id"], r["nn_id"]) for r in sm.knn_within(e, "vec_id", "embedding", 5).collect()}
    found = {(r["vec_id"], r["nn_id"]) for r in sm.knn_within(e, "vec_id", "embedding", 5, method="lsh", tables=12).collect()}
    assert len(exact & found) >= 0.9 * len(exact)


def test_smote_by_lsh_and_its_errors(spark):
    rows = [(i, [float(i % 7), float(i)], int(i < 12)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, v array<double>, y int")
    assert sm.smote(df, "id", "v", "y", method="lsh").count() == 36
    with pytest.raises(ValueError):
        sm.smote(df.where("y = 0 or id = 3"), "id", "v", "y")
    assert sm.smote(df.where("id < 24"), "id", "v", "y").count() == 0      # balanced: nothing to add


@pytest.mark.parametrize("query", ["smoothed_prior_group", "period_pressure", "seasonal_weight", "literal_lookup_table"])
def test_no_exchange_on_few_values(spark, query):
    import __spark_entry__ as e
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1" if query != "literal_lookup_table" else before)
    try:
        plan = e.queries()[query](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
