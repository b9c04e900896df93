"""Derived features: interactions, fills, smoothed priors, anomalies, pressure.

Statistics "broadcast back to rows" (group mean, group prior) are computed as a
partial aggregate and joined back, instead of ``avg() over (partition by g)``:
the window would place a hot group in one task; the aggregate + join is
combined map-side and the join is broadcast or skew-split by AQE.  Global
scalars (overall mean, sample std) enter as scalar subqueries, not joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from panelcraft.functions.expressions import gate
from panelcraft.sources.tables import lookup_map


def interaction_features(df: DataFrame, season_total: str, season_avg: str, season_max: str,
                         wet_days: str, pre_total: str, annual_total: str, score: str,
                         river: str, geo_code: str, elevation: str, low_elev_cut: float = 100.0
                         ) -> DataFrame:
    """The nine ratio / product features of the training step.

    Ratios use ``try_divide``: a zero denominator gives null instead of an ANSI
    error (values are identical otherwise).
    """
    s, r, e = F.col(season_total), F.col(river), F.col(elevation)
    div = F.try_divide
    return df.withColumns({
        "rain_x_river": s * (r + 1),
        "rain_x_geo_risk": s * F.col(geo_code),
        "intensity_x_river": F.col(score) * (r + 1),
        "elev_inverse": div(F.lit(1.0), e + 1),
        "low_elev_high_rain": gate(e < F.lit(low_elev_cut), s),
        "season_intensity": div(s, F.col(wet_days) + 1),
        "rain_concentration": div(F.col(season_max), F.col(season_avg) + 0.1),
        "saturation_index": div(F.col(pre_total) * s, e + 1),
        "pre_season_ratio": div(F.col(pre_total), F.col(annual_total) + 1),
    })


def fill_and_round(df: DataFrame, value: float = 0.0, digits: int = 4,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """Fill nulls in numeric columns with ``value`` and round every double column
    (half-even, NumPy's rule).

    Spark's fill skips string columns (the reference's fill also hits strings;
    the panel has no null strings).  NaN in doubles is treated like null.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    exprs = {}
    for f in fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.col(f.name)
            c = F.when(F.isnan(c) | c.isNull(), F.lit(float(value))).otherwise(c)
            exprs[f.name] = F.bround(c, digits)      # half-even, like NumPy
        elif f.dataType.typeName() in ("integer", "long", "short", "byte", "decimal"):
            exprs[f.name] = F.coalesce(F.col(f.name), F.lit(value).cast(f.dataType))
    return df.withColumns(exprs)


def select_available(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Select the wanted columns that exist, in the wanted order."""
    have = set(df.columns)
    return df.select(*[c for c in wanted if c in have])


def smoothed_prior(df: DataFrame, key: str, label: str, m: float, name: str,
                   fit: DataFrame | None = None, few_keys: bool = False) -> DataFrame:
    """``(sum_y + p*m) / (n + m)`` per key, ``p`` the global label mean of ``fit``.

    ``fit`` defaults to ``df`` itself (the reference's whole-data, leaking
    version); pass the training rows for a leak-free prior.  Keys unseen in
    ``fit`` get ``p``.  ``few_keys``: the keys are a small fixed domain (groups), looked
    up in a scalar map instead of a join.
    """
    fit = df if fit is None else fit
    p = fit.select(F.avg(F.col(label).cast("double"))).scalar()
    stats = fit.groupBy(key).agg(F.sum(F.col(label).cast("double")).alias("_ps"),
                                 F.count(F.lit(1)).alias("_pn"))
    if few_keys:
        found = lookup_map(stats, key, (F.struct("_ps", "_pn")))
        df = df.withColumn("_pm", found).withColumn("_pe", F.try_element_at("_pm", F.col(key)))
        joined = df.select("*", "_pe._ps", "_pe._pn").drop("_pm", "_pe")
    else:
        joined = df.join(stats, key, "left")
    # the scalar is projected once and then read as a column: every reference to
    # a scalar-subquery Column would otherwise plan (and run) its own subquery
    return (joined.withColumn("_pp", p)
              .withColumn(name, F.coalesce((F.col("_ps") + F.col("_pp") * F.lit(float(m)))
                                           / (F.col("_pn") + F.lit(float(m))), F.col("_pp")))
              .drop("_ps", "_pn", "_pp"))


def group_mean_back(df: DataFrame, key: str | Sequence[str], x: str, name: str,
                    fit: DataFrame | None = None) -> DataFrame:
    """``avg(x) over (partition by key)`` of ``fit`` (default: df) as aggregate + join."""
    keys = [key] if isinstance(key, str) else list(key)
    stats = (df if fit is None else fit).groupBy(*keys).agg(F.avg(x).alias(name))
    return df.join(stats, keys, "left")


def entity_anomaly(df: DataFrame, key: str, x: str, name: str = "anomaly",
                   fit: DataFrame | None = None) -> DataFrame:
    """``x - mean(x) of the row's entity``, the means taken from ``fit`` (default: df);
    an entity that ``fit`` lacks has the mean of all its rows."""
    out = group_mean_back(df, key, x, "_gm", fit)
    if fit is not None:
        out = out.withColumn("_all", fit.select(F.avg(x)).scalar()).withColumn(
            "_gm", F.coalesce("_gm", "_all")).drop("_all")
    return out.withColumn(name, F.col(x) - F.col("_gm")).drop("_gm")


def period_pressure(df: DataFrame, period: str, x: str, name: str = "period_pressure",
                    fit: DataFrame | None = None) -> DataFrame:
    """``(mean(x) of the period - mean(x)) / (stddev_samp(x) + 1)``, all of ``fit`` (default: df).

    There are few periods: their means are a scalar map, not a join.  A period that ``fit``
    lacks has pressure 0 (null if ``x`` is null throughout)."""
    source = df if fit is None else fit
    g = source.select(F.struct(F.avg(x).alias("m"), F.stddev_samp(x).alias("s"))).scalar()  # one pass
    means = lookup_map(source.groupBy(period).agg(F.avg(x).alias("_m")), period, "_m")
    out = df.withColumn("_g", g).withColumn("_pm", means)                # one subquery each
    mean = F.try_element_at("_pm", F.col(period))
    if fit is not None:
        mean = F.coalesce(mean, F.col("_g.m"))
    return out.withColumn(name, (mean - F.col("_g.m")) / (F.col("_g.s") + F.lit(1.0))).drop("_pm", "_g")


__all__ = ["interaction_features", "fill_and_round", "select_available", "smoothed_prior",
           "group_mean_back", "entity_anomaly", "period_pressure"]
