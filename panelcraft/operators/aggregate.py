"""Grouped and global aggregates.

The aggregates are hash aggregates with a partial (map-side) stage, so a key that
holds a third of the rows is combined inside each map task before the shuffle;
keeping the first row of a key is limited there likewise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcraft.functions.expressions import col_of, nan_to_null, rule_cascade


def season_features(df: DataFrame, entity: str, date_col: str, value: str,
                    season_months: Sequence[int] = (6, 7, 8, 9),
                    pre_months: Sequence[int] = (4, 5),
                    wet_cut: float = 5.0,
                    extra_aggs: Sequence[Column] = ()) -> DataFrame:
    """Annual, in-season and pre-season statistics per (entity, year) in ONE pass.

    The reference scans the series three times (season, annual, pre-season) and
    joins the results; here all of them are conditional aggregates of a single
    ``groupBy``, so the series is read and shuffled once.

    Output: ``entity, year, annual_total, annual_max, season_total, season_avg,
    season_max, season_wet_days, pre_season_total`` (+ ``extra_aggs``).
    Rows whose date is null (unparseable) leave the aggregates, NaN values are
    treated as missing, and the wet-day count is strict (``value > wet_cut``).
    In-season statistics are null for a year without in-season rows.
    """
    v = nan_to_null(value)
    month = F.month(date_col)
    in_season = month.isin(list(season_months))
    in_pre = month.isin(list(pre_months))
    return (df.where(F.col(date_col).isNotNull())
              .groupBy(F.col(entity), F.year(date_col).alias("year"))
              .agg(F.coalesce(F.sum(v), F.lit(0.0)).alias("annual_total"),
                   F.max(v).alias("annual_max"),
                   F.sum(F.when(in_season, v)).alias("season_total"),
                   F.avg(F.when(in_season, v)).alias("season_avg"),
                   F.max(F.when(in_season, v)).alias("season_max"),
                   F.count_if(in_season & (v > F.lit(wet_cut))).alias("season_wet_days"),
                   F.sum(F.when(in_pre, v)).alias("pre_season_total"),
                   *extra_aggs))


def value_counts(df: DataFrame, col: str | Column, name: str = "n") -> DataFrame:
    """Counts per value, the most frequent first, ties by value (one row per value)."""
    c = col_of(col)
    out = df.groupBy(c).agg(F.count(F.lit(1)).alias(name))
    return out.orderBy(F.col(name).desc(), out.columns[0])


def group_sizes(df: DataFrame, keys: Sequence[str], where: Column | None = None,
                name: str = "n") -> DataFrame:
    """Rows per key, optionally counting only rows that satisfy ``where``."""
    agg = F.count(F.lit(1)) if where is None else F.count_if(where)
    return df.groupBy(*keys).agg(agg.alias(name))


def dataset_profile(df: DataFrame, distinct_cols: Sequence[str] = (),
                    numeric_cols: Sequence[str] = (), approx: bool = False,
                    rsd: float = 0.01) -> DataFrame:
    """One row: row count, distinct counts, and min / max / mean of numeric columns.

    Exact distinct counts (the default, as the reference) shuffle every distinct
    value; ``approx=True`` uses HyperLogLog++ sketches merged map-side instead
    (relative standard deviation ``rsd``), which is what a 100 TB profile wants.
    """
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    distinct = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.count_distinct
    aggs += [distinct(c).alias(f"n_distinct_{c}") for c in distinct_cols]
    for c in numeric_cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"),
                 F.avg(c).alias(f"mean_{c}")]
    return df.agg(*aggs)


def class_balance(df: DataFrame, label: str, minority_share_flag: float = 0.35) -> DataFrame:
    """Positive / negative counts, shares, the neg:pos ratio and an imbalance flag."""
    pos = F.count_if(F.col(label) == 1)
    n = F.count(F.lit(1))
    return (df.agg(n.alias("n_rows"), pos.alias("n_pos"), (n - pos).alias("n_neg"))
              .select("n_rows", "n_pos", "n_neg",
                      F.try_divide(F.col("n_pos") * 100.0, F.col("n_rows")).alias("pct_pos"),
                      F.try_divide(F.col("n_neg"), F.col("n_pos")).alias("neg_pos_ratio"),
                      (F.try_divide(F.col("n_pos") * 1.0, F.col("n_rows"))
                       < F.lit(minority_share_flag)).alias("imbalanced")))


def dedupe_keep_first(df: DataFrame, keys: Sequence[str], seq: str | Sequence[str]) -> DataFrame:
    """Keep, per key, the row with the smallest ``seq`` (the "first" occurrence).

    ``seq`` may be several columns (compared in order) so ties have a defined winner.

    A row number filtered to 1: Spark keeps only the first row of each key before the shuffle
    already (a group limit in each map task), so a hot key sends one row per task, and nearly
    unique keys cost one sort instead of the two of a sort-based ``min_by``.
    """
    order = [seq] if isinstance(seq, str) else list(seq)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_first", F.row_number().over(w)).where("_first = 1").drop("_first")


def group_mean_rank(df: DataFrame, group: str, score: str, high: float = 0.55,
                    medium: float = 0.35) -> DataFrame:
    """Mean score per group, ascending, with a three-tier band (``> high``, ``> medium``, else low)."""
    m = F.avg(score)
    return (df.groupBy(group).agg(m.alias("mean_score"))
              .withColumn("band", rule_cascade([(F.col("mean_score") > high, "high"),
                                                (F.col("mean_score") > medium, "medium")],
                                               "low"))
              .orderBy("mean_score", group))
