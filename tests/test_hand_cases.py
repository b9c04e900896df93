"""Hand-computed cases (FIXTURES.md) for rules, cleaning, priors, weights, metrics."""

import math

import pytest
from pyspark.sql import functions as F

from panelcraft.functions import fixed_values as fv
from panelcraft.functions.expressions import (bucketize, composite_intensity, dictionary_encode,
                                              geo_rule, parse_yyyymmdd, sentinel_clamp)
from panelcraft.operators import aggregate as agg
from panelcraft.operators import evaluate as ev
from panelcraft.operators import features as feat
from panelcraft.operators import sampling as smp


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_composite_score_and_bucket(spark):
    df = spark.createDataFrame([(300.0, 50.0, 20, 1, 3, 99.0)], "s double, m double, r long, riv long, g int, e double")
    out = df.select(composite_intensity("s", "m", "r", "riv", "g", "e").alias("x"))
    out = out.select("x", bucketize("x", fv.INTENSITY_CUTS, fv.INTENSITY_LABELS).alias("c"))
    out = out.select("x", "c", dictionary_encode("c", fv.INTENSITY_CODES).alias("code"))
    assert rows(out, "x", "c", "code") == [(186.0, "high", 4)]


@pytest.mark.parametrize("v,label", [(14.9999, "very_low"), (15.0, "low"), (50.0, "moderate"),
                                     (100.0, "high"), (250.0, "very_high"), (500.0, "extreme"),
                                     (None, "very_low")])
def test_bucket_edges(spark, v, label):
    df = spark.createDataFrame([(v,)], "x double")
    assert df.select(bucketize("x", fv.INTENSITY_CUTS, fv.INTENSITY_LABELS)).first()[0] == label


def test_round_then_bucket(spark):
    df = spark.createDataFrame([(14.99996,)], "x double")
    r = feat.fill_and_round(df, 0.0, 4)
    assert r.select("x", bucketize("x", fv.INTENSITY_CUTS, fv.INTENSITY_LABELS)).first() == (15.0, "low")


def test_null_fill_and_unmapped_code(spark):
    df = spark.createDataFrame([(None, "ICT")], "x double, p string")
    r = feat.fill_and_round(df, 0.0, 4).select("x", dictionary_encode("p", fv.PROVINCE_CODES).alias("c"))
    assert r.first() == (0.0, 0)


def test_sentinel_clamp(spark):
    df = spark.createDataFrame([(-999.0,), (-0.2,), (1.23456,), (float("nan"),)], "x double")
    got = [r[0] for r in df.select(sentinel_clamp("x", -999.0, 0.0, 0.0, 3)).collect()]
    assert got == [0.0, 0.0, 1.235, 0.0]


def test_invalid_date_leaves_aggregates(spark):
    df = spark.createDataFrame([("a", "20101340", 9.0), ("a", "20100701", 6.0)], "e string, k string, v double")
    df = df.withColumn("d", parse_yyyymmdd("k"))
    assert df.where(F.col("d").isNull()).count() == 1
    s = agg.season_features(df, "e", "d", "v", fv.MONSOON_MONTHS, fv.PREMONSOON_MONTHS, 5.0)
    r = s.first()
    assert (r["year"], r["annual_total"], r["season_wet_days"]) == (2010, 6.0, 1)


def test_conditional_count_is_strict(spark):
    df = spark.createDataFrame([("a", "20100701", 5.0), ("a", "20100702", 5.01), ("a", "20100703", None)],
                               "e string, k string, v double").withColumn("d", parse_yyyymmdd("k"))
    s = agg.season_features(df, "e", "d", "v", wet_cut=5.0)
    assert s.first()["season_wet_days"] == 1


def test_smoothed_prior(spark):
    # key a: 2 positives of 6 rows; global p fixed at 0.2 by 4 extra rows with 0 positives
    data = [("a", 1)] * 2 + [("a", 0)] * 4 + [("b", 0)] * 4
    df = spark.createDataFrame(data, "k string, y int")
    out = feat.smoothed_prior(df, "k", "y", 4, "prior").where("k = 'a'").first()["prior"]
    assert math.isclose(out, (2 + 0.2 * 4) / (6 + 4))


def test_entity_anomaly(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0)], "k string, x double")
    got = sorted(r[0] for r in feat.entity_anomaly(df, "k", "x", "an").select("an").collect())
    assert got == [-1.0, 1.0]


def test_class_weights(spark):
    df = spark.createDataFrame([(1,)] * 2 + [(0,)] * 8, "y int")
    w = {r["y"]: (r["balanced_weight"], r["pos_weight"]) for r in smp.class_weights(df, "y").collect()}
    assert w[1] == (2.5, 4.0) and w[0] == (0.625, 4.0)


def _conf(spark, tp, fp, fn, tn):
    return spark.createDataFrame([(tp, fp, fn, tn)], "tp long, fp long, fn long, tn long")


def test_metrics_published_row(spark):
    m = ev.binary_metrics(_conf(spark, 52, 4, 24, 329)).first()
    got = [round(m[c], 3) for c in ("accuracy", "balanced_accuracy", "precision", "recall", "f1")]
    assert got == [0.932, 0.836, 0.929, 0.684, 0.788]


def test_metrics_no_predicted_positive(spark):
    m = ev.binary_metrics(_conf(spark, 0, 0, 5, 5)).first()
    assert m["precision"] == 0.0 and m["f1"] == 0.0


def test_best_threshold_ties_and_zero(spark):
    sw = spark.createDataFrame([(0.3, 0.5), (0.4, 0.5), (0.5, 0.2)], "threshold double, f1 double")
    assert ev.best_threshold(sw).first()["threshold"] == 0.3
    z = spark.createDataFrame([(0.3, 0.0), (0.4, 0.0)], "threshold double, f1 double")
    assert ev.best_threshold(z).first()["threshold"] == 0.5


def test_zero_variance_standardize(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], "c double, x double")
    got = smp.standardize(df, ["c", "x"]).collect()
    assert [r["c"] for r in got] == [0.0, 0.0]
    assert sorted(r["x"] for r in got) == [-1.0, 1.0]          # population std


def test_champion_tuple(spark):
    df = spark.createDataFrame([("a", 0.8, 0.6, 0.9), ("b", 0.8, 0.7, 0.8), ("c", 0.7, 0.9, 0.99)],
                               "name string, f1 double, recall double, auc double")
    assert ev.argmax_tuple(df, "name", ["f1", "recall", "auc"]).first()[0] == "b"


def test_keep_first_dedupe(spark):
    df = spark.createDataFrame([("x", "P", 212, 1), ("x", "P", 213, 2)], "d string, p string, elev int, seq int")
    assert agg.dedupe_keep_first(df, ["d", "p"], "seq").first()["elev"] == 212


@pytest.mark.parametrize("grp,elev,river,terrain,label", [
    ("Sindh", 65, 1, "plains", "high"), ("Punjab", 122, 1, "plains", "high"),
    ("Balochistan", 133, 1, "plains", "medium"), ("KPK", 980, 1, "mountains", "medium"),
    ("Sindh", 8, 0, "coastal", "high"), ("KPK", 100, 1, "plains", "high"),
    ("Punjab", 217, 1, "plains", "medium"), ("Punjab", 186, 0, "plains", "medium"),
    ("ICT", 540, 0, "hills", "low")])
def test_rule_cascade_branches(spark, grp, elev, river, terrain, label):
    df = spark.createDataFrame([(grp, elev, river, terrain)], "g string, e int, r int, t string")
    got = df.select(geo_rule("g", "e", "r", "t", fv.GEO_RISK_RULES, fv.GEO_RISK_DEFAULT)).first()[0]
    assert got == label
