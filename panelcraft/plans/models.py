"""Bound model queries: every model of the reference but its kernel machine, at its own size.

Each query builds the split, standardised matrix once (written to the shared folder for its
fits), and nothing outlives the call.  A model's final fit and those that leave one fold out
are fitted in shared passes.  Thresholds are tuned on validation rows: out-of-fold
scores of the training rows, all folds.  What SQL can state of a model's result is a query, and
the result itself (``*_values``: scores, metrics, cross-validated F1) is another.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcraft.functions import fixed_values as fv
from panelcraft.operators import aggregate as agg
from panelcraft.operators import evaluate as ev
from panelcraft.operators import models as md
from panelcraft.operators import sampling as sm
from panelcraft.operators.nets import Shape
from panelcraft.operators.nets import fit as fit_net
from panelcraft.operators.trees import FINAL, ONLY_FINAL, Growth
from panelcraft.operators.trees import fit as fit_trees
from panelcraft.plans import catalog as c
from panelcraft.session import work_dir, written
from panelcraft.sources import published
from panelcraft.sources.tables import read_table, write_sorted

KEYS = ["entity", "year"]
ROWS_PER_TASK = 50_000
KEEP = ["rid", "flag"]

@dataclass
class Data:
    """The raw matrix, the standardised training rows (with folds) and test rows, the scaler."""
    raw: DataFrame
    train: DataFrame
    test: DataFrame
    stats: dict[str, tuple[float, float]]
    #: training rows and synthetic ones, where several models of a call share them
    smoted: DataFrame | None = None


def _data(spark: SparkSession, sf: str) -> Data:
    raw = written(c.split_matrix(spark, sf).withColumn("rid", F.col("entity") * 10000 + F.col("year")), "matrix")
    stats = sm.fit_standardizer(raw.where("split = 'train'"), c.FEATURES)
    scaled = sm.apply_standardizer(raw, stats)
    train = scaled.where("split = 'train'")
    folds = sm.stratified_folds(train.select(*KEYS, "flag"), "flag", KEYS, fv.N_FOLDS, fv.SEED)
    parts = -(-raw.count() // ROWS_PER_TASK)
    train = train.join(folds.select(*KEYS, "fold"), KEYS).repartition(max(parts, 1), "rid")
    train = written(train, "train")                                              # read by every fit
    return Data(raw, train, written(scaled.where("split = 'test'"), "test"), stats)


# ---------------------------------------------------------------- the models
#: columns that may split a node of a forest
ROOT = round(len(c.FEATURES) ** 0.5)
_FOREST = partial(Growth, "bag", split_columns=ROOT, cuts=63, seed=fv.SEED)
_BOOST = partial(Growth, "boost", seed=fv.SEED)


@dataclass(frozen=True)
class Kind:
    """Members whose probabilities are averaged; with ``smote`` the final fit also takes synthetic rows
    (the folds don't, as in the reference)."""
    members: tuple[Growth | Shape, ...]
    smote: bool = False


#: the reference's models at the reference's sizes and the defaults of the libraries it uses
KINDS = {
    "rf_balanced": Kind((_FOREST(500, max_depth=12, min_rows=2, sample="bootstrap", weights="balanced"),)),
    "rf_smote": Kind((_FOREST(500, max_depth=12, min_rows=2, sample="bootstrap"),), smote=True),
    "extra_trees": Kind((_FOREST(500, min_rows=2, weights="balanced", random_cut=True),)),
    "gbt_balanced": Kind((_BOOST(400, max_leaves=15, rate=0.03, min_rows=20, weights="balanced"),)),
    "gbt_pos_weight": Kind((_BOOST(400, max_depth=4, rate=0.03, row_share=0.85, column_share=0.85, min_hessian=3, l2=3, weights="positive"),)),
    "gbt_smote": Kind((_BOOST(350, max_depth=4, rate=0.035, row_share=0.85, column_share=0.85, min_hessian=2, l2=2),), smote=True),
    "mlp_smote": Kind((Shape(seed=fv.SEED),), smote=True),
    "soft_vote": Kind((_FOREST(300, sample="bootstrap", weights="balanced"),
                       _BOOST(300, max_depth=6, rate=0.3, min_hessian=1, l2=1, weights="positive"),
                       _BOOST(300, max_leaves=31, rate=0.1, min_rows=20, weights="balanced"))),
    "balanced_rf": Kind((_FOREST(500, max_depth=12, min_rows=2, sample="balanced"),)),
}


def _with_smote(train: DataFrame) -> DataFrame:
    """Training rows and synthetic ones, which belong to no fold."""
    base = train.select("rid", "flag", F.array(*c.FEATURES).alias("vec"))
    syn = sm.smote(base, "rid", "vec", "flag", 1, fv.SMOTE_K, fv.SEED)
    syn = md.vectors_to_columns(syn.select((-1 - F.col("syn_id")).alias("rid"), "flag", "vec"), "vec", c.FEATURES)
    rows = train.select("rid", "flag", "fold", *c.FEATURES)
    return written(rows.unionByName(syn.withColumn("fold", F.lit(ONLY_FINAL))), "smote")


def _fitted(kind: Kind, d: Data, folds: bool = True) -> dict[int, list]:
    """The members of the final fit, and of those that leave a fold out."""
    rows = d.train
    if kind.smote:
        rows = _with_smote(d.train) if d.smoted is None else d.smoted
    fits = [FINAL, *range(fv.N_FOLDS)] if folds else [FINAL]
    by = md.run_parallel([lambda m=m: (fit_net if isinstance(m, Shape) else fit_trees)(rows, c.FEATURES, "flag", m, fits, "fold")
                          for m in kind.members], len(kind.members))
    return {f: [one[f] for one in by] for f in fits}


def _out_of_fold(models: dict[int, list], d: Data) -> DataFrame:
    return written(md.score_fitted(models, d.train, c.FEATURES, [*KEEP, "fold"], "fold"), "fold-scores")


def _evaluated(name: str, d: Data) -> tuple[list, DataFrame, DataFrame]:
    """Final members, test metrics at the threshold tuned on all folds, and the folds' scores."""
    models = _fitted(KINDS[name], d)
    tune = _out_of_fold(models, d)
    scored = written(md.score_fitted(models, d.test, c.FEATURES, [*KEEP, BASELINE]), "test-scores")
    row = md.evaluate(name, scored, "flag", tune)
    alone = ev.roc_auc(scored, "flag", BASELINE).select(F.greatest("auc", 1 - F.col("auc"))).scalar()
    differ = scored.select(F.count_distinct("score")).scalar()
    return models[FINAL], row.withColumns({"baseline_auc": alone, "n_scores": differ}), tune


#: the feature whose own values are the scores to beat
BASELINE = "season_total"


COUNTS = ["tp", "fp", "fn", "tn"]
RATES = ["accuracy", "balanced_accuracy", "precision", "recall", "f1", "auc"]


def metrics(name: str, spark: SparkSession, sf: str) -> DataFrame:
    """The metrics row of one model on the test rows, its threshold tuned on all folds."""
    return _evaluated(name, _data(spark, sf))[1]


def checks(m: DataFrame) -> DataFrame:
    """What holds for any right metrics row, and what a model must do: scores that differ, and an AUC above
    chance and above that of one feature alone.  The registered single-model queries
    return this, as SQL can state it (``metrics`` has the figures)."""
    tp, fp, fn, tn = (F.col(x) for x in COUNTS)
    n, grid = tp + fp + fn + tn, F.round(F.col("threshold") * 100)
    same = lambda x, num, den: F.abs(F.col(x) - F.coalesce(F.try_divide(num.cast("double"), den), F.lit(0.0))) < 1e-9
    return m.select(
        "model", n.alias("n"), (tp + fn).alias("n_pos"),
        ((F.abs(F.col("threshold") * 100 - grid) < 1e-9) & grid.between(fv.TUNE_GRID[0], fv.TUNE_GRID[1] - 1)).alias("threshold_on_grid"),
        (same("accuracy", tp + tn, n) & same("precision", tp, tp + fp) & same("recall", tp, tp + fn)
         & same("f1", 2 * tp, 2 * tp + fp + fn)).alias("rates_match_counts"),
        F.col("auc").between(0.0, 1.0).alias("auc_in_range"),
        (F.col("n_scores") > 1).alias("scores_differ"),
        ((F.col("auc") > 0.5) & (F.col("auc") > F.col("baseline_auc"))).alias("better_than_one_feature"))


def _single(name: str, spark: SparkSession, sf: str) -> DataFrame:
    return checks(metrics(name, spark, sf))


def _values(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return metrics(name, spark, sf)
    return query


def _leaderboard(d: Data) -> tuple[dict[str, list], DataFrame]:
    """All models with cross-validated F1, and the fitted models by name."""
    def one(name: str) -> tuple[list, DataFrame]:
        members, row, tune = _evaluated(name, d)
        cv = md.cv_f1(tune, "flag").select("cv_f1").scalar()
        return members, written(row.withColumn("cv_f1", cv), "metrics")

    d = replace(d, smoted=_with_smote(d.train))
    found = md.run_parallel([partial(one, n) for n in KINDS], 4)
    out = found[0][1]
    for _, m in found[1:]:
        out = out.unionByName(m)
    return {n: m for n, (m, _) in zip(KINDS, found, strict=True)}, out


def _champion(board: DataFrame) -> str:
    return ev.argmax_tuple(board, "model", ["f1", "recall", "auc"]).first()["best_model"]


# ---------------------------------------------------------------- queries
def rf_balanced(spark, sf):
    return _single("rf_balanced", spark, sf)


def rf_smote(spark, sf):
    return _single("rf_smote", spark, sf)


def gbt_balanced(spark, sf):
    return _single("gbt_balanced", spark, sf)


def gbt_pos_weight(spark, sf):
    return _single("gbt_pos_weight", spark, sf)


def gbt_smote(spark, sf):
    return _single("gbt_smote", spark, sf)


def mlp_smote(spark, sf):
    return _single("mlp_smote", spark, sf)


def balanced_rf(spark, sf):
    return _single("balanced_rf", spark, sf)


def soft_vote_ensemble(spark, sf):
    return _single("soft_vote", spark, sf)


def extra_trees(spark, sf):
    return _single("extra_trees", spark, sf)


ROW = ["entity", "grp", "year", "flag"]


def _scored_all(spark: SparkSession, sf: str) -> DataFrame:
    d = _data(spark, sf)
    models = _fitted(KINDS["rf_balanced"], d, folds=False)
    return written(md.score_fitted(models, sm.apply_standardizer(d.raw, d.stats), c.FEATURES, ROW), "scores")


def batch_score(spark, sf):
    """Every row of the panel, scored: keys, label, and whether the score is a probability, not the same
    for all rows, and on the average higher for flagged rows."""
    s = _scored_all(spark, sf)
    by = s.agg(F.struct(F.count_distinct("score").alias("n"), F.avg(F.when(F.col("flag") == 1, F.col("score"))).alias("one"),
                        F.avg(F.when(F.col("flag") == 0, F.col("score"))).alias("zero"))).scalar()
    return s.withColumn("_by", by).select(*ROW, F.col("score").between(0.0, 1.0).alias("has_score"),
                                          ((F.col("_by.n") > 1) & (F.col("_by.one") > F.col("_by.zero"))).alias("scores_tell"))


def batch_score_values(spark, sf):
    """Every row of the panel with its risk score."""
    return _scored_all(spark, sf).select("entity", "grp", "year", "flag", "score")


def cv_f1_values(spark, sf):
    """Mean F1 of the forest over the folds."""
    d = _data(spark, sf)
    return md.cv_f1(_out_of_fold(_fitted(KINDS["rf_balanced"], d), d), "flag")


def group_risk_from_model(spark, sf):
    """Mean model risk score per group with the three-tier band (> .55, > .35), ascending."""
    return agg.group_mean_rank(_scored_all(spark, sf), "grp", "score", fv.RISK_BAND_HIGH, fv.RISK_BAND_MEDIUM)


def feature_importance(spark, sf):
    models = _fitted(KINDS["rf_balanced"], _data(spark, sf), folds=False)
    return md.feature_importance(models[FINAL], c.FEATURES, spark, 15)


def feature_importance_check(spark, sf):
    """What holds of the importances of all features: each is a share, they add up to 1, and differ."""
    models = _fitted(KINDS["rf_balanced"], _data(spark, sf), folds=False)
    every = md.feature_importance(models[FINAL], c.FEATURES, spark, len(c.FEATURES))
    return every.agg(F.count("*").alias("n"), F.count_distinct("feature").alias("n_features"),
                     F.bool_and(F.col("importance").between(0, 1)).alias("in_range"),
                     (F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"), (F.count_distinct("importance") > 1).alias("differ"),
                     F.bool_and(F.col("band").isin("high", "medium", "low")).alias("banded"))


def group_risk_check(spark, sf):
    """The model's risk by group against an average taken anew from the scores, its bands and its order."""
    s = _scored_all(spark, sf)
    ranked = agg.group_mean_rank(s, "grp", "score", fv.RISK_BAND_HIGH, fv.RISK_BAND_MEDIUM)
    mean = [x for x in ranked.columns if x not in ("grp", "band", "rank", "n")][0]
    anew = s.groupBy("grp").agg((F.sum("score") / F.count("score")).alias("_mean"), F.count("*").alias("n_rows"))
    return ranked.join(anew, "grp").select("grp", "n_rows", (F.abs(F.col(mean) - F.col("_mean")) < 1e-4).alias("mean_matches"))


def cv_f1(spark, sf):
    """Out-of-fold scores of the forest by fold (sizes and checks; ``md.cv_f1`` has the mean F1)."""
    d = _data(spark, sf)
    scores = _out_of_fold(_fitted(KINDS["rf_balanced"], d), d)
    per = scores.groupBy("fold").agg(F.count("*").alias("n"), F.sum("flag").alias("n_pos"),
                                     F.bool_and(F.col("score").between(0.0, 1.0)).alias("scores_in_range"),
                                     (F.count_distinct("score") > 1).alias("scores_differ"))
    mean = md.cv_f1(scores, "flag").select("cv_f1").scalar()
    return per.withColumn("_cv", mean).select("fold", "n", "n_pos", "scores_in_range", "scores_differ",
                                              F.col("_cv").between(0.0, 1.0).alias("cv_f1_in_range"))


def model_leaderboard(spark, sf):
    """All models, rounded as the published table, best F1 first."""
    _, board = _leaderboard(_data(spark, sf))
    return board.select("model", F.bround("threshold", 2).alias("threshold"),
                        *[F.bround(x, 3).alias(x) for x in ("cv_f1", *RATES)],
                        *COUNTS).orderBy(F.col("f1").desc(), "model")


def cv_test_gap(spark, sf):
    """Cross-validated F1 next to the hold-out F1 of the eight models best in it, and their gap."""
    _, board = _leaderboard(_data(spark, sf))
    top = ev.top_k(board, [F.col("cv_f1").desc(), F.col("model")], 8)
    return top.select("model", F.round("cv_f1", 3).alias("cv_f1"), F.round("f1", 3).alias("test_f1"),
                      F.round(F.col("cv_f1") - F.col("f1"), 3).alias("gap"))


def _save(members: list, d: Data, row: DataFrame, path: str) -> None:
    meta = row.select("model", "threshold", *[x for x in ("cv_f1",) if x in row.columns], *RATES, *COUNTS,
                      F.array(*[F.lit(f) for f in c.FEATURES]).alias("features"),
                      F.lit("stratified_hash_80_20").alias("split_type"), F.lit(fv.TEST_FRACTION).alias("test_size"))
    md.save_model(members, md.scaler_model(d.stats), meta, path)


def _load_and_score(spark: SparkSession, raw: DataFrame, path: str) -> DataFrame:
    """Raw rows scored by what was saved alone, with the decision at the saved threshold."""
    members, scaler, meta = md.load_model(spark, path)
    scored = md.score_fitted({FINAL: members}, scaler.transform(raw), c.FEATURES, ROW)
    return scored.withColumn("_t", meta.select("threshold").scalar()).withColumn(
        "predicted", (F.col("score") >= F.col("_t")).cast("int")).drop("_t")


def _saved(spark: SparkSession, sf: str) -> tuple[list, Data, str, DataFrame]:
    """A forest saved with scaler and metadata; the raw rows scored by what was loaded."""
    d = _data(spark, sf)
    members, row, _ = _evaluated("rf_balanced", d)
    path = work_dir(spark, "models")
    _save(members, d, row, path)
    return members, d, path, written(_load_and_score(spark, d.raw, path), "loaded-scores")


def model_save_load_score_values(spark, sf):
    """Every row with score and decision by the saved and loaded forest."""
    return _saved(spark, sf)[3].select(*ROW, "score", "predicted")


def model_save_load_score(spark, sf):
    """Fit, save with scaler and metadata, load, score raw rows, write keys and risk scores: are they
    equal to the scores in memory?"""
    members, d, path, loaded = _saved(spark, sf)
    memory = md.score_fitted({FINAL: members}, sm.apply_standardizer(d.raw, d.stats), c.FEATURES, ROW)
    both = (_deliver(spark, loaded, path).join(memory.select("entity", "year", F.col("score").alias("_m")), KEYS)
            .join(loaded.select("entity", "year", "predicted"), KEYS))
    return both.select(*ROW, (F.abs(F.col("risk_score") - F.col("_m")) < 1e-9).alias("same_as_in_memory"),
                       F.col("predicted").isin(0, 1).alias("has_decision"))


def _championed(spark: SparkSession, sf: str) -> DataFrame:
    d = _data(spark, sf)
    models, board = _leaderboard(d)
    name, root = _champion(board), work_dir(spark, "champion")
    published.publish(spark, root, lambda path: _save(models[name], d, board.where(F.col("model") == name), path))
    return _deliver(spark, _load_and_score(spark, d.raw, published.current(spark, root)), root)


def champion_scores_values(spark, sf):
    """The leaderboard's champion, published with its scaler and metadata; keys and risk scores of all
    rows by the model that is current, written in order of the keys and read back."""
    return _championed(spark, sf)


def champion_scores(spark, sf):
    """``champion_scores_values`` as SQL can state it: every row once, with a probability."""
    return _championed(spark, sf).select(*ROW, F.col("risk_score").between(0.0, 1.0).alias("has_score"))


def _deliver(spark: SparkSession, scored: DataFrame, path: str) -> DataFrame:
    """Keys, label and risk score, as a CSV table in order of the keys, which is read back."""
    out = write_sorted(scored.select(*ROW, F.col("score").alias("risk_score")), f"{path}/scores", KEYS, "csv")
    return read_table(spark, out, "entity long, grp string, year int, flag int, risk_score double", "csv")


#: the figures behind the single-model checks
VALUES = {f"{'soft_vote_ensemble' if n == 'soft_vote' else n}_values": _values(n) for n in KINDS}
VALUES |= {"champion_scores_values": champion_scores_values, "batch_score_values": batch_score_values, "cv_f1_values": cv_f1_values,
           "model_save_load_score_values": model_save_load_score_values}
