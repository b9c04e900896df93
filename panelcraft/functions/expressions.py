"""Scalar column builders: rules, buckets, encodings, cleaning, dates, hashing.

Everything returns a ``Column`` made of built-in functions, so it stays inside
whole-stage codegen.  Division helpers use ``try_divide`` because plain ``/ 0``
raises under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of", "rule_cascade", "geo_rule", "bucketize", "dictionary_encode",
    "sentinel_clamp", "nan_to_null", "parse_yyyymmdd", "date_key", "days_in_month",
    "hash_uniform", "hash_key", "gate", "composite_intensity",
]


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rule_cascade(rules: Sequence[tuple[Column, object]], default: object) -> Column:
    """Ordered rules; the first true condition wins (a chained CASE WHEN)."""
    if not rules:
        return F.lit(default)
    expr = F.when(rules[0][0], F.lit(rules[0][1]))
    for cond, value in rules[1:]:
        expr = expr.when(cond, F.lit(value))
    return expr.otherwise(F.lit(default))


def geo_rule(group: str | Column, elevation: str | Column, river: str | Column,
             terrain: str | Column,
             rules: Iterable[tuple], default: str) -> Column:
    """Build ``rule_cascade`` from rows ``(groups, elev_below, river_required, terrains, label)``.

    ``None`` in a slot means "no condition"; ``river_required=False`` means the
    river flag is not tested.
    """
    g, e, r, t = map(col_of, (group, elevation, river, terrain))
    built = []
    for groups, below, need_river, terrains, label in rules:
        cond = F.lit(True)
        if groups is not None:
            cond = cond & g.isin(sorted(groups))
        if below is not None:
            cond = cond & (e < F.lit(below))
        if need_river:
            cond = cond & (r == F.lit(1))
        if terrains is not None:
            cond = cond & t.isin(sorted(terrains))
        built.append((F.coalesce(cond, F.lit(False)), label))
    return rule_cascade(built, default)


def bucketize(c: str | Column, cuts: Sequence[float], labels: Sequence[object]) -> Column:
    """Half-open buckets ``[cuts[i-1], cuts[i])``; ``len(labels) == len(cuts) + 1``.

    A null value falls in the first bucket, like the reference (it fills nulls
    with 0 before bucketing); pass a filled column to make that explicit.
    """
    if len(labels) != len(cuts) + 1:
        raise ValueError("need one more label than cut points")
    x = col_of(c)
    expr = F.when(x.isNull() | (x < F.lit(cuts[0])), F.lit(labels[0]))
    for cut, label in zip(cuts[1:], labels[1:-1]):
        expr = expr.when(x < F.lit(cut), F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def dictionary_encode(c: str | Column, mapping: Mapping[str, int], missing: int | None = 0) -> Column:
    """Look a string up in a literal map; unmapped keys give ``missing``."""
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    hit = F.try_element_at(m, col_of(c))
    return hit if missing is None else F.coalesce(hit, F.lit(missing))


def nan_to_null(c: str | Column) -> Column:
    x = col_of(c)
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def sentinel_clamp(c: str | Column, sentinel: float = -999.0, replacement: float = 0.0,
                   floor: float = 0.0, digits: int = 3) -> Column:
    """``sentinel -> replacement``, then ``max(floor, x)`` rounded to ``digits``.

    NaN is turned into null first; ``greatest`` skips nulls, so a null input
    comes out as ``floor`` (the reference's ``max(0, x)`` on a missing value).
    """
    x = nan_to_null(c)
    x = F.when(x == F.lit(sentinel), F.lit(replacement)).otherwise(x)
    return F.bround(F.greatest(F.lit(float(floor)), x), digits)      # half-even, like Python round


def parse_yyyymmdd(c: str | Column) -> Column:
    """``yyyyMMdd`` text (or integer) to DATE; invalid values give null, never raise."""
    return F.try_to_date(col_of(c).cast("string"), "yyyyMMdd")


def date_key(c: str | Column) -> Column:
    """DATE/TIMESTAMP to its ``yyyyMMdd`` key."""
    return F.date_format(col_of(c), "yyyyMMdd")


def days_in_month(c: str | Column) -> Column:
    return F.dayofmonth(F.last_day(col_of(c)))


def hash_key(*parts: str | Column) -> Column:
    """Text key ``p1|p2|...`` used for deterministic pseudo-random choices."""
    return F.concat_ws("|", *[col_of(p).cast("string") for p in parts])


def hash_uniform(*parts: str | Column) -> Column:
    """Uniform [0, 1) from the first 32 bits of ``md5(key)``.

    Unlike ``rand()`` it does not depend on partitioning, so splits and samples
    are reproducible and survive task retries.  DuckDB form:
    ``('0x' || substr(md5(key), 1, 8))::BIGINT / 4294967296.0``.
    """
    h = F.substring(F.md5(hash_key(*parts)), 1, 8)
    return F.conv(h, 16, 10).cast("long") / F.lit(4294967296.0)


def gate(cond: Column, value: str | Column) -> Column:
    """``int(cond) * value``."""
    return cond.cast("int") * col_of(value)


def composite_intensity(season_total: str | Column, annual_max: str | Column,
                        rainy_days: str | Column, river: str | Column,
                        geo_code: str | Column, elevation: str | Column,
                        w_season: float = 0.6, w_max: float = 2.0, w_rainy: float = 1.5,
                        digits: int = 4) -> Column:
    """``round((ws*S + wm*M + wr*R) * (river+1) * geo / sqrt(elev+1), digits)``, half-even."""
    s, m, r, rv, g, e = map(col_of, (season_total, annual_max, rainy_days, river, geo_code, elevation))
    # try_divide: elevation -1 (sqrt 0) gives null, later filled, instead of an ANSI error
    raw = F.try_divide((s * F.lit(w_season) + m * F.lit(w_max) + r * F.lit(w_rainy))
                       * (rv + F.lit(1)) * g, F.sqrt(e + F.lit(1)))
    return F.bround(raw, digits)
