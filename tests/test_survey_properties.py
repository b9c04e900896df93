"""Remaining checks of the survey's test strategy (section 5)."""

import pytest
from pyspark.sql import functions as F

from panelcraft.operators import aggregate as agg
from panelcraft.operators import evaluate as ev
from panelcraft.operators import features as feat
from panelcraft.operators import models as md

SF = "/root/testdata/sf0.001"

# fixed values: the published hold-out rows (TP, FP, FN, TN, accuracy, balanced accuracy,
# precision, recall, F1), in the order of the published table
PUBLISHED = [
    (52, 4, 24, 329, 0.932, 0.836, 0.929, 0.684, 0.788),
    (54, 8, 22, 325, 0.927, 0.843, 0.871, 0.711, 0.783),
    (53, 8, 23, 325, 0.924, 0.837, 0.869, 0.697, 0.774),
    (56, 13, 20, 320, 0.919, 0.849, 0.812, 0.737, 0.772),
    (53, 11, 23, 322, 0.917, 0.832, 0.828, 0.697, 0.757),
    (51, 8, 25, 325, 0.919, 0.824, 0.864, 0.671, 0.756),
    (55, 15, 21, 318, 0.912, 0.839, 0.786, 0.724, 0.753),
    (53, 12, 23, 321, 0.914, 0.831, 0.815, 0.697, 0.752),
    (56, 22, 20, 311, 0.897, 0.835, 0.718, 0.737, 0.727),
    (55, 30, 21, 303, 0.875, 0.817, 0.647, 0.724, 0.683),
]


@pytest.mark.parametrize("row", PUBLISHED)
def test_metrics_reproduce_published_rows(spark, row):
    tp, fp, fn, tn, *want = row
    conf = spark.createDataFrame([(tp, fp, fn, tn)], "tp long, fp long, fn long, tn long")
    m = ev.binary_metrics(conf).first()
    got = [round(m[c], 3) for c in ("accuracy", "balanced_accuracy", "precision", "recall", "f1")]
    assert got == want


def test_all_null_group(spark):
    df = spark.createDataFrame([("a", "2010-07-01", None), ("a", "2010-07-02", None)],
                               "e string, d string, v double").withColumn("d", F.to_date("d"))
    r = agg.season_features(df, "e", "d", "v").first()
    assert r["annual_total"] == 0.0 and r["annual_max"] is None and r["season_avg"] is None


def _panel(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    return li.select(F.col("l_suppkey").alias("e"), F.col("l_shipdate").alias("d"),
                     F.col("l_quantity").alias("v"),
                     (F.col("l_returnflag") == "R").cast("int").alias("y"))


def test_season_sum_not_above_annual(spark):
    s = agg.season_features(_panel(spark), "e", "d", "v", wet_cut=25.0)
    bad = s.where(F.coalesce("season_total", F.lit(0.0)) > F.col("annual_total")).count()
    assert bad == 0


def test_prior_between_group_rate_and_global_rate(spark):
    p = _panel(spark)
    out = feat.smoothed_prior(p, "e", "y", 4, "prior")
    g = p.agg(F.avg("y")).first()[0]
    rates = p.groupBy("e").agg(F.avg("y").alias("r"))
    j = out.select("e", "prior").distinct().join(rates, "e")
    lo, hi = F.least(F.col("r"), F.lit(g)), F.greatest(F.col("r"), F.lit(g))
    assert j.where((F.col("prior") < lo - 1e-12) | (F.col("prior") > hi + 1e-12)).count() == 0


def test_forest_separates_a_separable_fixture(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    med = o.agg(F.percentile("o_totalprice", 0.5)).first()[0]
    df = o.select("o_orderkey", (F.col("o_totalprice") > med).cast("int").alias("y"),
                  (F.col("o_totalprice") / 1000.0).alias("x1"),
                  (F.col("o_custkey") % 7).cast("double").alias("x2"))
    tr, te = df.where(F.col("o_orderkey") % 5 != 0), df.where(F.col("o_orderkey") % 5 == 0)
    model = md.fit(tr, ["x1", "x2"], md.estimator("rf", 2, "y", numTrees=20, maxDepth=5))
    scored = md.score(model, te, ["o_orderkey", "y"])
    auc = ev.roc_auc(scored, "y", "score").first()["auc"]
    assert auc > 0.95
    m = md.evaluate("rf", scored, "y", None).first()
    assert m["tp"] + m["fp"] + m["fn"] + m["tn"] == te.count()


def test_grouped_roc_curve_matches_brute_force(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet").select(
        F.col("o_orderpriority").alias("g"), (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        (F.col("o_totalprice") / 500000.0).alias("s"))
    cur = ev.roc_curve(o, "y", "s", ["g"]).collect()
    rows = o.collect()
    for r in cur[:40]:
        tp = sum(1 for x in rows if x["g"] == r["g"] and x["s"] >= r["threshold"] and x["y"] == 1)
        fp = sum(1 for x in rows if x["g"] == r["g"] and x["s"] >= r["threshold"] and x["y"] != 1)
        assert (r["tp"], r["fp"]) == (tp, fp)


def test_roc_corners_match_brute_force_across_slices(spark):
    """Points that a straight line joins go, also where a slice of the order ends between them."""
    rows = [(g, i, int(i % 7 == 0 or 30 < i < 60)) for g in ("a", "b") for i in range(100) for _ in range(1 + (g == "b"))]
    df = spark.createDataFrame([(g, float(i), y) for g, i, y in rows], "g string, s double, y int")
    got = {(r["g"], r["threshold"], r["tp"], r["fp"]) for r in ev.roc_curve(df, "y", "s", ["g"], corners=True).collect()}
    want = set()
    for g in ("a", "b"):
        pts, tp, fp = [], 0, 0
        for s in range(99, -1, -1):
            here = [y for h, i, y in rows if h == g and i == s]
            tp, fp = tp + sum(here), fp + len(here) - sum(here)
            pts.append((g, float(s), tp, fp))
        turns = [b for a, b, c in zip(pts, pts[1:], pts[2:])
                 if (b[2] - a[2], b[3] - a[3]) != (c[2] - b[2], c[3] - b[3])]
        want |= {pts[0], pts[-1], *turns}
    assert got == want and len(got) < 120
    one = ev.roc_curve(df.where("s = 3"), "y", "s", ["g"], origin=True, corners=True)
    assert one.count() == 4 and ev.roc_curve(df.limit(0), "y", "s", ["g"], corners=True).count() == 0


def test_evaluate_with_separate_tuning_frame(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet").select(
        "o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        (F.col("o_totalprice") / 500000.0).alias("score"))
    tune, test = o.where(F.col("o_orderkey") % 2 == 0), o.where(F.col("o_orderkey") % 2 == 1)
    m = md.evaluate("m", test, "y", tune=tune).first()
    best = ev.best_threshold(ev.threshold_sweep(tune, "y", "score")).first()["threshold"]
    assert m["threshold"] == best
    conf = ev.confusion_at(test, "y", "score", best).first()
    assert (m["tp"], m["fp"], m["fn"], m["tn"]) == (conf["tp"], conf["fp"], conf["fn"], conf["tn"])


def test_sweep_and_auc_tolerate_nan_and_extreme_scores(spark):
    df = spark.createDataFrame([(1, 0.9), (1, float("nan")), (0, 1e300), (0, -5.0), (0, 0.2)],
                               "y int, s double")
    sw = {round(r["threshold"], 2): r for r in ev.threshold_sweep(df, "y", "s").collect()}
    assert (sw[0.5]["tp"], sw[0.5]["fp"], sw[0.5]["fn"], sw[0.5]["tn"]) == (1, 1, 0, 2)
    assert ev.roc_auc(df, "y", "s").first()["auc"] == 2 / 3


def test_profile_exact_and_approximate(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    exact = agg.dataset_profile(li, ["l_orderkey"], ["l_quantity"]).first()
    approx = agg.dataset_profile(li, ["l_orderkey"], ["l_quantity"], approx=True).first()
    assert exact["n_distinct_l_orderkey"] == li.select("l_orderkey").distinct().count()
    assert abs(approx["n_distinct_l_orderkey"] - exact["n_distinct_l_orderkey"]) \
        <= 0.05 * exact["n_distinct_l_orderkey"]
    assert approx["n_rows"] == exact["n_rows"] and approx["max_l_quantity"] == exact["max_l_quantity"]
