"""Bound queries: each takes (spark, sf_dir) and returns a DataFrame.

Column names and types match the SQL in ``panelcraft.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcraft.functions.expressions import (bucketize, composite_intensity, date_key,
                                              dictionary_encode, parse_yyyymmdd)
from panelcraft.functions import fixed_values as fv
from panelcraft.functions.fixed_values import INTENSITY_CODES, INTENSITY_CUTS, INTENSITY_LABELS
from panelcraft.operators import aggregate as agg
from panelcraft.operators import features as feat
from panelcraft.operators import panel as pnl
from panelcraft.plans import bindings as b
from panelcraft.session import work_dir, written

_RISK_CODES = {"high": 3, "medium": 2, "low": 1}
_TERRAIN_CODES = {"coastal": 1, "plains": 2, "hills": 3, "mountains": 4}


# ---------------------------------------------------------------- step 1: season features
def season_features(spark: SparkSession, sf: str) -> DataFrame:
    m = b.measures(spark, sf)
    return agg.season_features(m, "entity", "day", "amount", b.SEASON_MONTHS, b.PRE_MONTHS,
                               b.WET_CUT)


def _season_and_label(spark: SparkSession, sf: str) -> DataFrame:
    """Season statistics and the label of each (entity, year), from one scan."""
    m = b.measures(spark, sf)
    s = agg.season_features(
        m, "entity", "day", "amount", b.SEASON_MONTHS, b.PRE_MONTHS, b.WET_CUT,
        extra_aggs=[F.count_if(F.col("l_returnflag") == "R").alias("_n_r"),
                    F.count(F.lit(1)).alias("_n")])
    return (s.withColumn("label_raw", (F.col("_n_r") * 8 > F.col("_n") * 3).cast("int"))
             .drop("_n_r", "_n"))


# ---------------------------------------------------------------- step 2: panel
def _scaffold_from(spark: SparkSession, sf: str, season: DataFrame) -> DataFrame:
    """Supplier x every year between the first and last year of the aggregated series.

    The bounds are one scalar subquery over the (entity, year) aggregate, which
    reuses its exchange, instead of another scan of the raw series.
    """
    bounds = season.select(F.struct(F.min("year").alias("lo"), F.max("year").alias("hi"))).scalar()
    keys = b.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("entity"))
    return pnl.panel_scaffold(keys, "entity", unique=True, bounds=bounds)


def panel_scaffold(spark: SparkSession, sf: str) -> DataFrame:
    return _scaffold_from(spark, sf, _season_and_label(spark, sf))


def membership_panel(spark: SparkSession, sf: str) -> DataFrame:
    o = b.table(spark, sf, "orders")
    c = b.table(spark, sf, "customer").select(F.col("c_custkey").alias("entity"))
    yb = o.select(F.struct(F.min(F.year("o_orderdate")).alias("lo"),
                           F.max(F.year("o_orderdate")).alias("hi"))).scalar()   # one scan
    events = (o.where(F.col("o_orderpriority") == b.URGENT)
               .select(F.col("o_custkey").alias("entity"), F.year("o_orderdate").alias("year")))
    return pnl.membership_flag(pnl.panel_scaffold(c, "entity", bounds=yb), events,
                               ["entity", "year"], "flag")


def panel_left_join(spark: SparkSession, sf: str) -> DataFrame:
    # the (entity, year) aggregate is read twice (year bounds, join): it is
    # materialised once so the raw series is scanned and shuffled only once
    s = written(_season_and_label(spark, sf), "season")
    return (pnl.panel_left_join(_scaffold_from(spark, sf, s), [s], ["entity", "year"])
            .withColumn("flag", F.coalesce(F.col("label_raw"), F.lit(0))).drop("label_raw"))


def panel_dim_join(spark: SparkSession, sf: str) -> DataFrame:
    return pnl.dim_join(panel_left_join(spark, sf), b.entity_dim(spark, sf), "entity",
                        ["grp", "elevation", "river", "terrain", "geo_risk"])


def feature_panel(spark: SparkSession, sf: str) -> DataFrame:
    """The full labelled feature panel (the flagship)."""
    p = panel_dim_join(spark, sf)
    p = pnl.encode_columns(p, {"terrain_code": ("terrain", _TERRAIN_CODES),
                               "geo_risk_code": ("geo_risk", _RISK_CODES),
                               "group_code": ("grp", b.GROUP_CODES)})
    p = p.withColumn("intensity_score", composite_intensity(
        "season_total", "annual_max", "season_wet_days", "river", "geo_risk_code", "elevation"))
    p = feat.fill_and_round(p, 0.0, 4)
    cat = bucketize("intensity_score", INTENSITY_CUTS, INTENSITY_LABELS)
    return (p.withColumn("intensity_category", cat)
             .withColumn("intensity_code", dictionary_encode("intensity_category", INTENSITY_CODES)))


def dedupe_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    """First line (lowest line number) of every (order, supplier) pair."""
    li = b.table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber",
                                                "l_partkey", "l_quantity")
    return agg.dedupe_keep_first(li, ["l_orderkey", "l_suppkey"],
                                 ["l_linenumber", "l_partkey", "l_quantity"])


def date_key_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Format ship dates to yyyyMMdd, corrupt line 7's month to 13, parse back."""
    li = b.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    k = date_key("l_shipdate")
    k = F.when(F.col("l_linenumber") == 7,
               F.concat(F.substring(k, 1, 4), F.lit("13"), F.substring(k, 7, 2))).otherwise(k)
    d = parse_yyyymmdd(F.col("date_key"))
    return (li.withColumn("date_key", k)
              .select("l_orderkey", "l_linenumber", "date_key",
                      F.substring("date_key", 1, 4).cast("int").alias("key_year"),
                      F.substring("date_key", 5, 2).cast("int").alias("key_month"),
                      F.substring("date_key", 7, 2).cast("int").alias("key_day"),
                      # null for the invalid keys; DOUBLE so both engines' frames agree on type
                      F.year(d).cast("double").alias("year"),
                      F.month(d).cast("double").alias("month"),
                      F.dayofmonth(F.last_day(d)).cast("double").alias("days_in_month")))


def json_series_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """events.props JSON object -> one (event, key, value) row per entry."""
    from panelcraft.sources.payload import flatten_json_map
    ev = b.table(spark, sf, "events").select("event_id", "props")
    return flatten_json_map(ev, "props", ["event_id"], value_type="int")


def sentinel_clamp(spark: SparkSession, sf: str) -> DataFrame:
    """Payload cleaning on events.value: a sentinel, a negative shift, rounding to 3."""
    from panelcraft.functions.expressions import sentinel_clamp as clamp
    ev = b.table(spark, sf, "events").select("event_id", "value", "user_id")
    raw = F.when(F.col("user_id") % 10 == 0, F.lit(-999.0)).otherwise(F.col("value") - 5.0)
    return ev.select("event_id", clamp(raw, -999.0, 0.0, 0.0, 3).alias("clean_value"))


# ---------------------------------------------------------------- step 3: rules, encodings
def rule_cascade_risk(spark: SparkSession, sf: str) -> DataFrame:
    return b.entity_dim(spark, sf).select("entity", "grp", "elevation", "river", "terrain", "geo_risk")


def intensity_bucket(spark: SparkSession, sf: str) -> DataFrame:
    p = feature_panel(spark, sf)
    return p.groupBy("intensity_category", "intensity_code").agg(F.count(F.lit(1)).alias("n"))


def dictionary_encode_q(spark: SparkSession, sf: str) -> DataFrame:
    d = b.entity_dim(spark, sf)
    return d.select("entity",
                    dictionary_encode("grp", b.GROUP_CODES).alias("group_code"),
                    dictionary_encode("terrain", _TERRAIN_CODES).alias("terrain_code"),
                    dictionary_encode("geo_risk", _RISK_CODES).alias("geo_risk_code"))


def composite_score(spark: SparkSession, sf: str) -> DataFrame:
    return feature_panel(spark, sf).select("entity", "year", "intensity_score")


def literal_lookup_table(spark: SparkSession, sf: str) -> DataFrame:
    """A literal code table (spark.createDataFrame) joined onto the entity dimension."""
    from panelcraft.sources.tables import literal_table
    codes = literal_table(spark, list(b.GROUP_CODES.items()), "grp string, group_code int")
    d = b.entity_dim(spark, sf).select("entity", "grp")
    return (d.join(codes, "grp", "left")
             .select("entity", "grp", F.coalesce("group_code", F.lit(0)).alias("group_code")))


# ---------------------------------------------------------------- step 4: statistical features
def _model_panel(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Columns of the feature panel, written: the statistics read them and the rows do."""
    return written(feature_panel(spark, sf).select("entity", "year", *columns), "panel")


def interaction_features(spark: SparkSession, sf: str) -> DataFrame:
    p = feature_panel(spark, sf)
    out = feat.interaction_features(p, "season_total", "season_avg", "season_max",
                                    "season_wet_days", "pre_season_total", "annual_total",
                                    "intensity_score", "river", "geo_risk_code", "elevation",
                                    low_elev_cut=1000.0)
    cols = ["rain_x_river", "rain_x_geo_risk", "intensity_x_river", "elev_inverse",
            "low_elev_high_rain", "season_intensity", "rain_concentration", "saturation_index",
            "pre_season_ratio"]
    return out.select("entity", "year", *[F.round(c, 6).alias(c) for c in cols])


def fill_and_round(spark: SparkSession, sf: str) -> DataFrame:
    p = panel_dim_join(spark, sf)
    return feat.fill_and_round(p.select("entity", "year", "season_total", "season_avg",
                                        "season_max", "season_wet_days", "pre_season_total"),
                               0.0, 4)


def smoothed_prior(spark: SparkSession, sf: str) -> DataFrame:
    p = _model_panel(spark, sf, "flag")
    out = feat.smoothed_prior(p, "entity", "flag", fv.ENTITY_PRIOR_M, "entity_prior")
    return out.select("entity", "year", F.round("entity_prior", 9).alias("entity_prior"))


def smoothed_prior_group(spark: SparkSession, sf: str) -> DataFrame:
    p = _model_panel(spark, sf, "grp", "flag")
    out = feat.smoothed_prior(p, "grp", "flag", fv.GROUP_PRIOR_M, "group_prior", few_keys=True)
    return out.select("entity", "year", F.round("group_prior", 9).alias("group_prior"))


def entity_anomaly(spark: SparkSession, sf: str) -> DataFrame:
    p = _model_panel(spark, sf, "season_total")
    out = feat.entity_anomaly(p, "entity", "season_total", "season_anomaly")
    return out.select("entity", "year", F.round("season_anomaly", 6).alias("season_anomaly"))


def period_pressure(spark: SparkSession, sf: str) -> DataFrame:
    p = _model_panel(spark, sf, "season_total")
    out = feat.period_pressure(p, "year", "season_total", "year_pressure")
    return out.select("entity", "year", F.round("year_pressure", 6).alias("year_pressure"))


def select_available(spark: SparkSession, sf: str) -> DataFrame:
    p = feature_panel(spark, sf)
    return feat.select_available(p, ["entity", "year", "season_total", "no_such_column",
                                     "elevation", "flag"])


# ---------------------------------------------------------------- step 5: profile and reporting
def dataset_profile(spark: SparkSession, sf: str) -> DataFrame:
    li = b.table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_quantity")
    return agg.dataset_profile(li, ["l_suppkey", "l_orderkey"], ["l_quantity"])


def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return agg.value_counts(b.entity_dim(spark, sf), "geo_risk")


def positives_per_year(spark: SparkSession, sf: str) -> DataFrame:
    return agg.group_sizes(panel_left_join(spark, sf), ["year"], F.col("flag") == 1, "n_pos")


def class_balance(spark: SparkSession, sf: str) -> DataFrame:
    out = agg.class_balance(panel_left_join(spark, sf), "flag")
    return out.select("n_rows", "n_pos", "n_neg", F.round("pct_pos", 6).alias("pct_pos"),
                      F.round("neg_pos_ratio", 6).alias("neg_pos_ratio"), "imbalanced")


def group_risk_rank(spark: SparkSession, sf: str) -> DataFrame:
    s = b.scored_orders(spark, sf)
    out = agg.group_mean_rank(s, "grp", "score", fv.RISK_BAND_HIGH, fv.RISK_BAND_MEDIUM)
    return out.select("grp", F.round("mean_score", 9).alias("mean_score"), "band")


# ---------------------------------------------------------------- step 6: evaluation
def _r(c: str, d: int = 9):
    return F.round(c, d).alias(c)


_METRICS = ["accuracy", "balanced_accuracy", "precision", "recall", "f1"]


def confusion_at(spark: SparkSession, sf: str) -> DataFrame:
    from panelcraft.operators.evaluate import confusion_at as conf
    return conf(b.scored_orders(spark, sf), "y", "score", 0.5, ["grp"])


def binary_metrics(spark: SparkSession, sf: str) -> DataFrame:
    from panelcraft.operators import evaluate as ev
    m = ev.binary_metrics(ev.confusion_at(b.scored_orders(spark, sf), "y", "score", 0.5, ["grp"]))
    return m.select("grp", "tp", "fp", "fn", "tn", *[_r(c) for c in _METRICS])


def roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    from panelcraft.operators.evaluate import roc_auc as auc
    return auc(b.scored_orders(spark, sf), "y", "score", ["grp"]).select("grp", _r("auc", 12))


def roc_auc_overall(spark: SparkSession, sf: str) -> DataFrame:
    from panelcraft.operators.evaluate import roc_auc as auc
    return auc(b.scored_orders(spark, sf), "y", "score").select(_r("auc", 12))


def threshold_sweep(spark: SparkSession, sf: str) -> DataFrame:
    from panelcraft.operators.evaluate import threshold_sweep as sweep
    s = sweep(b.scored_orders(spark, sf), "y", "score", *fv.TUNE_GRID)
    return s.select("threshold", "tp", "fp", "fn", "tn", *[_r(c) for c in _METRICS])


def report_sweep(spark: SparkSession, sf: str) -> DataFrame:
    from panelcraft.operators.evaluate import threshold_sweep as sweep
    s = sweep(b.scored_orders(spark, sf), "y", "score", *fv.REPORT_GRID, group_cols=["grp"])
    return s.select("grp", "threshold", "tp", "fp", "fn", "tn", _r("precision"), _r("recall"),
                    _r("f1"))


def best_threshold(spark: SparkSession, sf: str) -> DataFrame:
    from panelcraft.operators import evaluate as ev
    s = ev.threshold_sweep(b.scored_orders(spark, sf), "y", "score", *fv.TUNE_GRID, group_cols=["grp"])
    return ev.best_threshold(s, "f1", fv.DEFAULT_THRESHOLD, ["grp"]).select("grp", "threshold", _r("best_f1"))


def roc_curve(spark: SparkSession, sf: str) -> DataFrame:
    from panelcraft.operators.evaluate import roc_curve as curve
    c = curve(b.scored_orders(spark, sf), "y", "score")
    return c.select("threshold", "tp", "fp", _r("fpr", 12), _r("tpr", 12))


def roc_corners(spark: SparkSession, sf: str) -> DataFrame:
    """ROC points without collinear ones, of each nation's orders scored in steps of a hundredth (many ties)."""
    from panelcraft.operators.evaluate import roc_curve as curve
    s = _nation_scores(spark, sf).withColumn("score", F.floor(F.col("score") * 100) / 100)
    c = curve(s, "y", "score", ["name"], origin=True, corners=True)
    return c.select("name", "threshold", "tp", "fp", _r("fpr", 12), _r("tpr", 12))


def _nation_scores(spark: SparkSession, sf: str) -> DataFrame:
    """(name, y, score): orders by customer nation, a stand-in for scores of several models."""
    o = b.table(spark, sf, "orders").select(
        "o_custkey", (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        (F.col("o_totalprice") / F.lit(b.SCORE_SCALE)).alias("score"))
    cust = b.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nat = b.table(spark, sf, "nation").select("n_nationkey", "n_name")
    return (o.join(cust, F.col("o_custkey") == F.col("c_custkey"))
             .join(nat, F.col("c_nationkey") == F.col("n_nationkey"))
             .select(F.col("n_name").alias("name"), "y", "score"))


def _nation_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Per customer nation: metrics at 0.5 and AUC, a stand-in for a per-model table."""
    from panelcraft.operators import evaluate as ev
    # the joined rows feed both the confusion counts and the AUC: joined once
    s = written(_nation_scores(spark, sf), "nation-scores")
    m = ev.binary_metrics(ev.confusion_at(s, "y", "score", 0.5, ["name"]))
    a = ev.roc_auc(s, "y", "score", ["name"])
    return m.join(a, "name")


def roc_curves_top8(spark: SparkSession, sf: str) -> DataFrame:
    """ROC curves, each from its origin, of the eight nations of the largest AUC."""
    from panelcraft.operators.evaluate import top_roc_curves
    s = written(_nation_scores(spark, sf), "nation-scores")
    return top_roc_curves(s, "y", "score", "name", 8).select(
        "name", "threshold", "tp", "fp", _r("fpr", 12), _r("tpr", 12), _r("auc", 12))


def argmax_tuple(spark: SparkSession, sf: str) -> DataFrame:
    from panelcraft.operators.evaluate import argmax_tuple as am
    return am(_nation_metrics(spark, sf), "name", ["f1", "recall", "auc"])


def topk_by_metric(spark: SparkSession, sf: str) -> DataFrame:
    from panelcraft.operators.evaluate import top_k
    m = _nation_metrics(spark, sf)
    return top_k(m, [F.col("f1").desc(), F.col("name")], 8).select(
        "name", _r("f1"), _r("recall"), _r("auc", 12))


def soft_vote(spark: SparkSession, sf: str) -> DataFrame:
    """Three per-order scores in long form, averaged per order."""
    from panelcraft.functions.expressions import hash_uniform
    from panelcraft.operators.evaluate import soft_vote as vote
    o = b.table(spark, sf, "orders")
    long = o.select(F.col("o_orderkey").alias("row_id"), F.explode(F.array(
        F.col("o_totalprice") / F.lit(b.SCORE_SCALE),
        (F.col("o_custkey") % 100).cast("double") / 100.0,
        hash_uniform(F.col("o_orderkey"), F.lit(b.SEED)))).alias("score"))
    return vote(long, "row_id", "score").select("row_id", _r("score", 12))


def quantile_bands(spark: SparkSession, sf: str) -> DataFrame:
    """Per region: exact q75 / q40 of account balance, then strict > bands."""
    from panelcraft.operators.ordered import exact_quantiles
    from panelcraft.sources.tables import lookup_map
    d = b.entity_dim(spark, sf, "s_acctbal").select("entity", "grp", "s_acctbal")
    q = exact_quantiles(d, "s_acctbal", fv.IMPORTANCE_QUANTILES, ["grp"], tiebreak=["entity"])
    out = (d.withColumn("_m", lookup_map(q, "grp", F.struct("q_0", "q_1")))
            .withColumn("_q", F.try_element_at("_m", F.col("grp"))).select("*", "_q.q_0", "_q.q_1"))
    out = out.withColumn("band", F.when(F.col("s_acctbal") > F.col("q_0"), "high")
                         .when(F.col("s_acctbal") > F.col("q_1"), "medium").otherwise("low"))
    return out.select("entity", "grp", "s_acctbal", _r("q_0"), _r("q_1"), "band")


# ---------------------------------------------------------------- step 7: model matrix, sampling
BASE_FEATURES = ["annual_total", "annual_max", "season_total", "season_avg", "season_max",
                 "season_wet_days", "pre_season_total", "elevation", "river", "terrain_code",
                 "geo_risk_code", "group_code", "intensity_score", "intensity_code"]
EXTRA_FEATURES = ["rain_x_river", "rain_x_geo_risk", "intensity_x_river", "elev_inverse",
                  "low_elev_high_rain", "season_intensity", "rain_concentration",
                  "saturation_index", "pre_season_ratio", "entity_prior", "group_prior",
                  "season_anomaly", "year_pressure", "year_feature"]
FEATURES = BASE_FEATURES + EXTRA_FEATURES


def model_matrix(p: DataFrame, fit: DataFrame | None = None) -> DataFrame:
    """entity, grp, year, flag and the 28 numeric features (all double) of a feature panel.

    ``fit``: the rows that priors, anomaly and pressure are estimated on (default: all,
    as the reference does)."""
    x = feat.interaction_features(p, "season_total", "season_avg", "season_max",
                                  "season_wet_days", "pre_season_total", "annual_total",
                                  "intensity_score", "river", "geo_risk_code", "elevation",
                                  low_elev_cut=1000.0)
    x = feat.smoothed_prior(x, "entity", "flag", fv.ENTITY_PRIOR_M, "entity_prior", p if fit is None else fit)
    x = feat.smoothed_prior(x, "grp", "flag", fv.GROUP_PRIOR_M, "group_prior", p if fit is None else fit, few_keys=True)
    x = feat.entity_anomaly(x, "entity", "season_total", "season_anomaly", fit)
    x = feat.period_pressure(x, "year", "season_total", "year_pressure", fit)
    x = x.withColumn("year_feature", F.col("year"))
    return x.select("entity", "grp", "year", "flag",
                    *[F.col(c).cast("double").alias(c) for c in FEATURES])


def _split(spark: SparkSession, sf: str) -> DataFrame:
    """(entity, year, flag, split): the split needs keys and classes alone."""
    from panelcraft.operators.sampling import stratified_split as split
    keys = written(panel_left_join(spark, sf).select("entity", "year", "flag"), "panel-keys")
    return split(keys, "flag", ["entity", "year"], fv.TEST_FRACTION, fv.SEED)


def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return _split(spark, sf).select("entity", "year", "flag", "split")


def _train_keys(spark: SparkSession, sf: str) -> DataFrame:
    return _split(spark, sf).where(F.col("split") == "train").select("entity", "year", "flag")


def stratified_folds(spark: SparkSession, sf: str) -> DataFrame:
    from panelcraft.operators.sampling import stratified_folds as folds
    tr = written(_train_keys(spark, sf), "train-keys")       # ranked, and joined back
    return folds(tr, "flag", ["entity", "year"], fv.N_FOLDS, fv.SEED).select("entity", "year", "flag", "fold")


def split_year_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return _split(spark, sf).groupBy("split", "year", "flag").agg(F.count(F.lit(1)).alias("n"))


def split_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """The model matrix with its split; the feature panel is written once and the split made
    from its keys."""
    from panelcraft.operators.sampling import stratified_split as split
    p = written(feature_panel(spark, sf), "feature-panel")
    keys = split(p.select("entity", "year", "flag"), "flag", ["entity", "year"], fv.TEST_FRACTION, fv.SEED)
    return model_matrix(p).join(keys.select("entity", "year", "split"), ["entity", "year"])


def standardize(spark: SparkSession, sf: str) -> DataFrame:
    from panelcraft.operators.sampling import standardize as std
    s = split_matrix(spark, sf)
    out = std(s, FEATURES, fit=s.where(F.col("split") == "train"))
    return out.select("entity", "year", *[F.round(c, 6).alias(c) for c in FEATURES])


def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    from panelcraft.operators.sampling import class_weights as cw
    return cw(_train_keys(spark, sf), "flag").select("flag", "n_class", _r("balanced_weight"), _r("pos_weight"))


def balanced_bags(spark: SparkSession, sf: str) -> DataFrame:
    from panelcraft.operators.sampling import balanced_bags as bags
    tr = written(_train_keys(spark, sf), "train-keys")       # counted, hashed and joined back
    return bags(tr, "flag", ["entity", "year"], 10, b.SEED, 1).select("bag", "entity", "year", "flag")


def _embedding_rows(spark: SparkSession, sf: str) -> DataFrame:
    e = b.table(spark, sf, "embeddings")
    return e.select("vec_id", "embedding", (F.col("label") == 0).cast("int").alias("minority"))


def knn_topk(spark: SparkSession, sf: str) -> DataFrame:
    from panelcraft.operators.sampling import knn_within
    m = _embedding_rows(spark, sf).where(F.col("minority") == 1)
    return knn_within(m, "vec_id", "embedding", 5).select("vec_id", "nn_rank", "nn_id",
                                                          F.round("dist", 6).alias("dist"))


def smote_oversample(spark: SparkSession, sf: str) -> DataFrame:
    from panelcraft.operators.sampling import smote
    s = smote(_embedding_rows(spark, sf), "vec_id", "embedding", "minority", 1, 5, b.SEED)
    return s.select("syn_id", "base_id", "nn_id", F.round("gap", 9).alias("gap"),
                    F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x), 6)
                    .alias("vec_sum"))


# ---------------------------------------------------------------- step 9: sources, sinks, streams
def csv_roundtrip_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Write an orders projection as CSV (header) to the shared folder, scan it back typed."""
    from panelcraft.sources.tables import read_table, write_table
    o = b.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                            "o_totalprice", "o_orderpriority")
    path = write_table(o, work_dir(spark, "csv"), "csv")
    schema = ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderpriority string")
    return read_table(spark, path, schema, "csv")


def resume_pending_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Dimension keys not yet present in the sink (customers without a 1998 order)."""
    from panelcraft.sources.tables import pending_keys
    dim = b.table(spark, sf, "customer").select(F.col("c_custkey").alias("key"))
    done = (b.table(spark, sf, "orders").where(F.year("o_orderdate") == 1998)
             .select(F.col("o_custkey").alias("key")))
    return pending_keys(dim, done, ["key"])


def append_union(spark: SparkSession, sf: str) -> DataFrame:
    """Existing rows (before 1998) + new rows (1998 on): bag union counted per key."""
    from panelcraft.sources.tables import union_counts
    m = b.measures(spark, sf).select("entity", F.year("day").alias("year"))
    old, new = m.where(F.col("year") < 1998), m.where(F.col("year") >= 1998)
    return union_counts(old, new, ["entity", "year"])


def event_map_explode(spark: SparkSession, sf: str) -> DataFrame:
    """Per customer a map<year, array<priority>> (sizes bounded by the value domains),
    exploded back to one (customer, year, priority) row per list element."""
    from panelcraft.sources.tables import explode_keyed_lists
    o = b.table(spark, sf, "orders").select(F.col("o_custkey").alias("entity"),
                                            F.year("o_orderdate").alias("year"),
                                            F.col("o_orderpriority").alias("priority"))
    per_year = o.groupBy("entity", "year").agg(F.collect_set("priority").alias("prios"))
    maps = per_year.groupBy("entity").agg(
        F.map_from_entries(F.collect_list(F.struct("year", "prios"))).alias("events"))
    return explode_keyed_lists(maps, "events", ["entity"], "year", "priority")


def date_spine(spark: SparkSession, sf: str) -> DataFrame:
    """Supplier x every calendar day between the first and last ship date."""
    li = b.table(spark, sf, "lineitem")
    db = li.select(F.struct(F.min(F.to_date("l_shipdate")).alias("lo"),
                            F.max(F.to_date("l_shipdate")).alias("hi"))).scalar()   # one scan
    s = b.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("entity"))
    return (pnl.date_spine(s, "entity", bounds=db)
              .select("entity", date_key("day").alias("day_key"), "year", "month",
                      "day_of_month", "days_in_month"))


def seasonal_weight(spark: SparkSession, sf: str) -> DataFrame:
    """Per line: fixed month weight x year multiplier (yearly mean quantity / overall mean)."""
    from panelcraft.functions.fixed_values import MONTH_WEIGHTS
    li = b.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                                "l_shipdate", "l_quantity")
    # the per-year sums and counts also give the overall mean; the aggregate has
    # one row per year, so it is materialised once and read by both uses
    yearly = written(li.groupBy(F.year("l_shipdate").alias("year"))
                     .agg(F.sum("l_quantity").alias("_s"), F.count("l_quantity").alias("_c")), "yearly")
    base = yearly.select(F.sum("_s") / F.sum("_c")).scalar()
    ym = yearly.select("year", F.try_divide(F.col("_s") / F.col("_c"), base).alias("mult"))
    out = pnl.seasonal_weight(li, F.month("l_shipdate"), F.year("l_shipdate"), MONTH_WEIGHTS, ym)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.round("weight", 9).alias("weight"))


def stream_incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """events.parquet as a file stream: flatten props, clean values, dedupe, append."""
    from panelcraft.functions.expressions import sentinel_clamp as clamp
    from panelcraft.sources.payload import flatten_json_map
    from panelcraft.streaming.ingest import run_ingest
    schema = b.table(spark, sf, "events").schema
    base = work_dir(spark, "stream")

    def transform(df: DataFrame) -> DataFrame:
        src = df.withColumnRenamed("value", "amount")
        flat = flatten_json_map(src, "props", ["event_id", "ts", "user_id", "event_type", "amount"],
                                value_type="int")
        return flat.withColumn("clean_amount", clamp("amount", -999.0, 0.0, 0.0, 3))

    return run_ingest(spark, sf, schema, f"{base}/sink", f"{base}/checkpoint", transform,
                      ["event_id", "key"], source_glob="events.parquet").select(
        "event_id", "user_id", "event_type", "amount", "key", "value", "clean_amount")


def payload_daily_series(spark: SparkSession, sf: str) -> DataFrame:
    """One nested JSON payload per (supplier, year) shaped like the remote daily-series
    response ({"properties":{"parameter":{"X":{"yyyyMMdd": v}}}}), built from lineitem,
    then flattened back to daily rows with the sentinel / clamp / round-3 cleaning.
    Each payload holds at most 366 entries (one per day), so the collect is bounded."""
    from panelcraft.sources.payload import daily_series_rows
    return daily_series_rows(_payload_docs(spark, sf), "payload", ["entity"],
                             ("properties", "parameter", "X"))


def _payload_docs(spark: SparkSession, sf: str) -> DataFrame:
    """(entity, payload): one nested JSON document per (supplier, year)."""
    li = b.table(spark, sf, "lineitem")
    daily = (li.groupBy(F.col("l_suppkey").alias("entity"), F.year("l_shipdate").alias("year"),
                        date_key("l_shipdate").alias("day_key"))
               .agg(F.sum("l_quantity").alias("_q"), F.count(F.lit(1)).alias("_n"))
               .withColumn("value", F.when(F.col("_n") == 3, F.lit(-999.0))
                                     .otherwise(F.col("_q") - 20.0)))
    payload = (daily.groupBy("entity", "year")
                    .agg(F.to_json(F.struct(F.struct(F.struct(
                        F.map_from_entries(F.collect_list(F.struct("day_key", "value")))
                        .alias("X")).alias("parameter")).alias("properties"))).alias("payload")))
    return payload.select("entity", "payload")


def optional_source_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """An optional series that is not there, built from the raw table instead; a second one that is."""
    from pyspark.sql.types import StructType
    from panelcraft.sources.tables import read_with_fallback
    schema = StructType.fromDDL("entity long, year int, total double")
    yearly = lambda: (b.measures(spark, sf).groupBy("entity", F.year("day").alias("year"))
                      .agg(F.sum("amount").alias("total")))
    missing = read_with_fallback(spark, f"{sf}/no_such_series.parquet", schema, yearly)
    there = StructType.fromDDL("n_nationkey long, n_name string")
    names = read_with_fallback(spark, f"{sf}/nation.parquet", there, yearly)
    sup = b.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("entity"), "s_nationkey")
    return (missing.join(sup, "entity").join(names, F.col("s_nationkey") == F.col("n_nationkey"))
            .select("entity", "n_name", "year", _r("total", 4)))


def stream_payload_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Payload documents (one JSON line per supplier and year, built from lineitem)
    land as text files; a file stream parses, flattens and cleans them and appends
    idempotently to a year-partitioned sink.  Equals ``payload_daily_series``."""
    from panelcraft.sources.payload import daily_series_rows
    from panelcraft.streaming.ingest import read_sink, start_payload_ingest
    base = work_dir(spark, "payload-stream")
    docs = _payload_docs(spark, sf)
    docs.select(F.to_json(F.struct("entity", "payload")).alias("value")).write.text(f"{base}/landing")

    def transform(lines: DataFrame) -> DataFrame:
        d = lines.select(F.from_json("value", "entity long, payload string").alias("d")).select("d.*")
        return daily_series_rows(d, "payload", ["entity"], ("properties", "parameter", "X"))

    q = start_payload_ingest(spark, f"{base}/landing", f"{base}/sink", f"{base}/checkpoint",
                             transform, ["entity", "date"])
    q.awaitTermination()
    return read_sink(spark, f"{base}/sink").select("entity", "date", "year", "month", "day", "value")
