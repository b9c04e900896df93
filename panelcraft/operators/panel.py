"""Panel construction: entity x period scaffolds, membership flags, left joins.

No operator here uses a cross join.  Period ranges are generated per entity
row with ``explode(sequence(...))``, where the bounds may be scalar subqueries
(``df.select(F.min(...)).scalar()``) so they come from the data without a join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcraft.functions.expressions import col_of, days_in_month, dictionary_encode
from panelcraft.sources.tables import lookup_map


def panel_scaffold(entities: DataFrame, key: str, start: int | Column | None = None,
                   end: int | Column | None = None, period: str = "year", unique: bool = False,
                   bounds: Column | None = None) -> DataFrame:
    """One row per (distinct entity, period in [start, end]).

    ``bounds`` may replace ``start``/``end``: a struct column ``(lo, hi)``, e.g. one
    scalar subquery, which is projected once.  ``unique=True`` skips the
    distinct (a shuffle) when ``key`` is already a key.
    """
    ents = entities.select(key) if unique else entities.select(key).distinct()
    if bounds is not None:
        ents = ents.withColumn("_b", bounds)
        s, e = F.col("_b.lo"), F.col("_b.hi")
    else:
        s = F.lit(start) if isinstance(start, int) else start
        e = F.lit(end) if isinstance(end, int) else end
    return ents.select(key, F.explode(F.sequence(s.cast("int"), e.cast("int"))).alias(period))


def membership_flag(panel: DataFrame, events: DataFrame, keys: Sequence[str],
                    name: str = "flag") -> DataFrame:
    """``panel`` plus ``name`` = 1 if its key tuple occurs in ``events``, else 0.

    The event side is reduced to distinct keys first (partial aggregate), then
    left-joined; AQE broadcasts it when it is measured small and splits skewed
    partitions otherwise.
    """
    hits = events.select(*keys).distinct().withColumn("_hit", F.lit(1))
    return (panel.join(hits, list(keys), "left")
                 .withColumn(name, F.coalesce(F.col("_hit"), F.lit(0)))
                 .drop("_hit"))


def panel_left_join(panel: DataFrame, parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Left-join several keyed feature tables onto the panel, in order."""
    out = panel
    for p in parts:
        out = out.join(p, list(keys), "left")
    return out


def dim_join(panel: DataFrame, dim: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Left-join a projected dimension (only ``columns`` are read from it)."""
    return panel.join(dim.select(key, *columns), key, "left")


def date_spine(entities: DataFrame, key: str, start: str | Column | None = None,
               end: str | Column | None = None, bounds: Column | None = None) -> DataFrame:
    """One row per (entity, calendar day in [start, end]) with its calendar parts.

    ``bounds`` may replace ``start``/``end``: a struct column ``(lo, hi)`` projected once.
    """
    ents = entities.select(key).distinct()
    if bounds is not None:
        ents = ents.withColumn("_b", bounds)
        s, e = F.to_date(F.col("_b.lo")), F.to_date(F.col("_b.hi"))
    else:
        s = F.to_date(F.lit(start)) if isinstance(start, str) else F.to_date(start)
        e = F.to_date(F.lit(end)) if isinstance(end, str) else F.to_date(end)
    return (ents.select(key, F.explode(F.sequence(s, e, F.expr("INTERVAL 1 DAY"))).alias("day"))
                    .select(key, "day", F.year("day").alias("year"), F.month("day").alias("month"),
                            F.dayofmonth("day").alias("day_of_month"),
                            days_in_month("day").alias("days_in_month")))


def seasonal_weight(df: DataFrame, month: str | Column, year: str | Column,
                    month_weights: Mapping[int, float] | DataFrame,
                    year_mult: Mapping[int, float] | DataFrame,
                    name: str = "weight") -> DataFrame:
    """``weight = month_weights[month] * year_mult[year]``; unknown keys give null.

    Either lookup is a literal map (inlined into the projection) or a keyed
    DataFrame ``(key, value)`` of bounded size (months, periods), read as a scalar map: the
    rows are never dealt out by month or year.
    """
    out = df.withColumn("_m", col_of(month)).withColumn("_y", col_of(year))
    parts = []
    for src, key, tag in ((month_weights, "_m", "_mw"), (year_mult, "_y", "_ym")):
        if isinstance(src, DataFrame):
            k, v = src.columns[:2]
            out = (out.withColumn("_lm", lookup_map(src, k, v))
                   .withColumn(tag, F.try_element_at("_lm", F.col(key))).drop("_lm"))
        else:
            m = F.create_map(*[x for kv in src.items() for x in (F.lit(kv[0]), F.lit(float(kv[1])))])
            out = out.withColumn(tag, F.try_element_at(m, F.col(key)))
        parts.append(tag)
    return out.withColumn(name, F.col("_mw") * F.col("_ym")).drop("_m", "_y", "_mw", "_ym")


def encode_columns(df: DataFrame, specs: Mapping[str, tuple[str, Mapping[str, int]]]) -> DataFrame:
    """Add ``new = map[src]`` for each ``new: (src, map)``; unmapped -> 0."""
    return df.withColumns({new: dictionary_encode(src, m) for new, (src, m) in specs.items()})
