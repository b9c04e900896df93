"""Distributed evaluation of scored rows: confusion, metrics, AUC, sweeps, curves.

Inputs are long tables ``(group..., label, score)``; a group is typically a
model name.  Nothing is collected: every metric is an aggregate, and the
curves use the range-partitioned running sums of ``ordered``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcraft.operators.ordered import ordered_running_sum


def _div0(a: Column, b: Column) -> Column:
    """a / b, 0 when undefined (the reference's ``zero_division=0``)."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def with_score(df: DataFrame, score: str) -> DataFrame:
    """Rows that have a score.  The one rule of this module: rows whose score is null or NaN are
    left out of every measure; ``unscored`` counts them."""
    return df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score)))


def unscored(df: DataFrame, score: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Number of rows (per group) that the measures leave out."""
    return df.groupBy(*group_cols).agg(F.count_if(F.col(score).isNull() | F.isnan(F.col(score))).alias("n_unscored"))


def confusion_at(df: DataFrame, label: str, score: str, threshold: float | Column,
                 group_cols: Sequence[str] = ()) -> DataFrame:
    """TP, FP, FN, TN of ``score >= threshold`` per group (one pass)."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    pred = F.col(score) >= t
    y = F.col(label) == 1
    return with_score(df, score).groupBy(*group_cols).agg(
        F.count_if(pred & y).alias("tp"), F.count_if(pred & ~y).alias("fp"),
        F.count_if(~pred & y).alias("fn"), F.count_if(~pred & ~y).alias("tn"))


def binary_metrics(conf: DataFrame) -> DataFrame:
    """Accuracy, balanced accuracy, precision, recall, F1 from tp/fp/fn/tn columns."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision = _div0(tp, tp + fp)
    recall = _div0(tp, tp + fn)
    specificity = _div0(tn, tn + fp)
    return conf.select(
        "*",
        _div0(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ((recall + specificity) / 2).alias("balanced_accuracy"),
        precision.alias("precision"), recall.alias("recall"),
        _div0(tp * 2, tp * 2 + fp + fn).alias("f1"))


def _score_counts(df: DataFrame, label: str, score: str, group_cols: Sequence[str]) -> DataFrame:
    """Pre-aggregate to one row per distinct (group, score): positives and negatives."""
    y = F.col(label) == 1
    return (with_score(df, score)
              .groupBy(*group_cols, score)
              .agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")))


def roc_auc(df: DataFrame, label: str, score: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Exact ROC AUC with ties counted one half (Mann-Whitney form).

    AUC = sum over distinct scores s of pos(s) * (neg below s + neg(s) / 2), over P*N.
    The data is first reduced to distinct scores; the running negative count is a
    range-partitioned running sum, so no task sees more than one slice.
    """
    c = _score_counts(df, label, score, group_cols)
    c = ordered_running_sum(c, [F.col(score)], ["neg"], group_cols)
    below = F.col("neg_cum") - F.col("neg")
    return (c.groupBy(*group_cols)
             .agg(F.sum(F.col("pos") * (below + F.col("neg") * 0.5)).alias("_u"),
                  F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
             .select(*group_cols,
                     F.try_divide(F.col("_u"), F.col("_p").cast("double") * F.col("_n")).alias("auc")))


def roc_curve(df: DataFrame, label: str, score: str, group_cols: Sequence[str] = (),
              origin: bool = False, corners: bool = False) -> DataFrame:
    """One ROC point per distinct score (predict positive when ``score >= s``); with ``origin``
    also the point (0, 0) of each curve, at an infinite threshold.

    With ``corners`` only the points that the drawn curve needs: the first, the last and
    those whose step from the point before differs from the step to the point after.  The step to
    the next point is the next distinct score's counts, which cross range slices with the offsets."""
    c = _score_counts(df, label, score, group_cols)
    c = ordered_running_sum(c, [F.col(score).desc()], ["pos", "neg"], group_cols,
                            next_suffix="_next" if corners else None)
    tot = c.groupBy(*group_cols).agg(F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))
    if group_cols:
        c = c.join(tot, list(group_cols), "inner")
    else:                                        # one scalar subquery, projected once
        t = tot.select(F.struct("_P", "_N")).scalar()
        c = c.withColumn("_t", t).select("*", F.col("_t._P").alias("_P"),
                                         F.col("_t._N").alias("_N")).drop("_t")
    if corners:                                  # the first point has nothing but its own counts before it
        first = (F.col("pos_cum") == F.col("pos")) & (F.col("neg_cum") == F.col("neg"))
        c = c.where(first | F.col("pos_next").isNull() | (F.col("pos_next") != F.col("pos"))
                    | (F.col("neg_next") != F.col("neg")))
    if origin:
        inf = F.lit(float("inf")).alias(score)
        zero = F.lit(0).cast("long")
        start = c.select(*group_cols, "_P", "_N").distinct().select(
            *group_cols, "_P", "_N", inf, zero.alias("pos_cum"), zero.alias("neg_cum"))
        c = c.select(*start.columns).unionByName(start)
    return c.select(*group_cols, F.col(score).alias("threshold"),
                    F.col("pos_cum").alias("tp"), F.col("neg_cum").alias("fp"),
                    F.try_divide(F.col("neg_cum").cast("double"), F.col("_N")).alias("fpr"),
                    F.try_divide(F.col("pos_cum").cast("double"), F.col("_P")).alias("tpr"))


def threshold_sweep(df: DataFrame, label: str, score: str, lo: int = 10, hi: int = 90,
                    scale: int = 100, group_cols: Sequence[str] = ()) -> DataFrame:
    """Confusion and metrics at every threshold ``i / scale`` for ``lo <= i < hi``.

    One pass: each row is put in the bin of the highest grid threshold it
    reaches (exact ``>=`` against the same doubles ``i / scale``), bins are
    counted, and the counts at each threshold are reverse running sums over at
    most ``hi - lo + 1`` rows per group.
    """
    s = F.col(score)
    # clamp before the int cast (ANSI casts raise on overflow)
    sc = F.least(F.greatest(s, F.lit((lo - 2) / scale)), F.lit((hi + 1) / scale))
    b0 = F.floor(sc * scale).cast("int")
    # repair floating error of floor(s * scale) against the exact comparison s >= i/scale
    b1 = (F.when(s < b0.cast("double") / scale, b0 - 1)
           .when(s >= (b0 + 1).cast("double") / scale, b0 + 1).otherwise(b0))
    bin_ = F.least(F.greatest(b1, F.lit(lo - 1)), F.lit(hi - 1))
    y = F.col(label) == 1
    bins = (with_score(df, score)
              .groupBy(*group_cols, bin_.alias("i"))
              .agg(F.count_if(y).alias("_pos"), F.count_if(~y).alias("_neg")))
    grid = df.sparkSession.range(lo, hi).select(F.col("id").cast("int").alias("i"))
    if group_cols:
        grid = (bins.select(*group_cols).distinct()
                .select(*group_cols, F.explode(F.sequence(F.lit(lo), F.lit(hi - 1))).alias("i")))
    w = Window.partitionBy(*group_cols).orderBy(F.col("i").desc()).rowsBetween(
        Window.unboundedPreceding, 0)
    cum = bins.select(*group_cols, "i", F.sum("_pos").over(w).alias("tp"),
                      F.sum("_neg").over(w).alias("fp"))
    # threshold i takes the counts of the lowest non-empty bin >= i (0 when none)
    cw = Window.partitionBy(*group_cols).orderBy("i").rowsBetween(0, Window.unboundedFollowing)
    joined = (grid.join(cum, [*group_cols, "i"], "left")
                  .withColumn("tp", F.first("tp", ignorenulls=True).over(cw))
                  .withColumn("fp", F.first("fp", ignorenulls=True).over(cw)))
    totals = bins.groupBy(*group_cols).agg(F.sum("_pos").alias("_P"), F.sum("_neg").alias("_N"))
    if group_cols:
        joined = joined.join(totals, list(group_cols), "inner")
    else:                                        # one scalar subquery, projected once
        t = totals.select(F.struct("_P", "_N")).scalar()
        joined = joined.withColumn("_t", t).select("*", F.col("_t._P").alias("_P"),
                                                   F.col("_t._N").alias("_N")).drop("_t")
    conf = joined.select(
        *group_cols, (F.col("i").cast("double") / F.lit(float(scale))).alias("threshold"),
        F.coalesce("tp", F.lit(0)).alias("tp"), F.coalesce("fp", F.lit(0)).alias("fp"),
        (F.col("_P") - F.coalesce("tp", F.lit(0))).alias("fn"),
        (F.col("_N") - F.coalesce("fp", F.lit(0))).alias("tn"))
    return binary_metrics(conf)


def best_threshold(sweep: DataFrame, metric: str = "f1", default: float = 0.5,
                   group_cols: Sequence[str] = ()) -> DataFrame:
    """Threshold of the highest ``metric``; the lowest wins ties; ``default`` if all are 0."""
    best = F.max_by(F.col("threshold"), F.struct(F.col(metric), -F.col("threshold")))
    return (sweep.groupBy(*group_cols)
                 .agg(best.alias("_t"), F.max(metric).alias(f"best_{metric}"))
                 .select(*group_cols,
                         F.when(F.col(f"best_{metric}") > 0, F.col("_t"))
                          .otherwise(F.lit(default)).alias("threshold"),
                         f"best_{metric}"))


def argmax_tuple(df: DataFrame, name: str, keys: Sequence[str],
                 group_cols: Sequence[str] = ()) -> DataFrame:
    """The ``name`` whose ``keys`` tuple is lexicographically largest (e.g. f1, recall, auc)."""
    return df.groupBy(*group_cols).agg(
        F.max_by(F.col(name), F.struct(*[F.col(k) for k in keys])).alias(f"best_{name}"))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows in ``order`` (planned as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)


def top_roc_curves(df: DataFrame, label: str, score: str, name: str, k: int = 8) -> DataFrame:
    """ROC curves, with their origins, of the ``k`` names of the largest AUC (ties by name)."""
    best = top_k(roc_auc(df, label, score, [name]), [F.col("auc").desc(), F.col(name)], k)
    return roc_curve(df, label, score, [name], origin=True).join(F.broadcast(best), name)   # k rows


def soft_vote(scores: DataFrame, row_id: str, score: str, name: str = "score") -> DataFrame:
    """Mean of several models' probabilities per row (long input: row_id, model, score)."""
    return scores.groupBy(row_id).agg(F.avg(score).alias(name))
