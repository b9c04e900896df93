"""The reference's own pipeline, composed from the generic operators.

For users who run the reference's domain today: the same inputs (dimension
rows, year -> entity-list event map, landed daily payloads) and the same
output columns, built as Spark jobs.  Column names and constants are the
reference's (see ``functions.fixed_values``).  Differences from pandas that
matter are listed in the README (string nulls stay null, exact strata).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcraft.functions import fixed_values as fv
from panelcraft.functions.expressions import (bucketize, composite_intensity, dictionary_encode,
                                              geo_rule, parse_yyyymmdd)
from panelcraft.operators import aggregate as agg
from panelcraft.operators import features as feat
from panelcraft.operators import panel as pnl
from panelcraft.sources.payload import daily_series_rows
from panelcraft.sources.tables import explode_keyed_lists

BASE_FEATURES = ["annual_total_mm", "annual_max_daily", "monsoon_total_mm", "monsoon_avg_daily",
                 "monsoon_max_daily", "monsoon_rainy_days", "premonsoon_total_mm", "lat", "lon",
                 "elevation_m", "river_proximity", "terrain_code", "geo_risk_code", "province_code",
                 "flood_intensity_score", "flood_intensity_code"]


def district_dimension(raw: DataFrame, seq: str = "seq") -> DataFrame:
    """Keep the first row per (district, province) and add ``flood_risk_geo`` by the
    nine-rule cascade.  ``seq`` orders the input rows (file order)."""
    d = agg.dedupe_keep_first(raw, ["district", "province"], seq).drop(seq)
    return d.withColumn("flood_risk_geo", geo_rule("province", "elevation_m", "river_proximity",
                                                   "terrain_type", fv.GEO_RISK_RULES,
                                                   fv.GEO_RISK_DEFAULT))


def label_panel(dim: DataFrame, event_map: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """district x year with ``flooded`` = 1 when the district is listed for the year.

    ``event_map`` has one row per year with an ``array<string>`` of districts, or is
    a single-row ``map<int, array<string>>`` column named ``events``.
    """
    if "events" in event_map.columns:
        long = explode_keyed_lists(event_map, "events", [], "year", "district")
    else:
        long = event_map.select("year", F.explode("districts").alias("district"))
    scaffold = pnl.panel_scaffold(dim, "district", first_year, last_year)
    return pnl.membership_flag(scaffold, long.select("district", F.col("year").cast("int")),
                               ["district", "year"], "flooded")


def daily_rainfall(payloads: DataFrame, parameter: str = "PRECTOTCORR") -> DataFrame:
    """Landed API payloads (district, lat, lon, payload json) -> daily rows
    (district, lat, lon, date, year, month, day, rainfall_mm)."""
    rows = daily_series_rows(payloads, "payload", ["district", "lat", "lon"],
                             ("properties", "parameter", parameter), fv.PAYLOAD_SENTINEL,
                             fv.PAYLOAD_ROUND)
    return rows.withColumnRenamed("value", "rainfall_mm")


def flood_features(labels: DataFrame, dim: DataFrame, rainfall: DataFrame) -> DataFrame:
    """The processed feature table: seasonal aggregates (one pass), joins, codes,
    composite score, fill + round 4, intensity class and code."""
    r = rainfall.withColumn("_d", parse_yyyymmdd("date"))
    s = (agg.season_features(r, "district", "_d", "rainfall_mm", fv.MONSOON_MONTHS,
                             fv.PREMONSOON_MONTHS, fv.RAINY_DAY_MM)
            .select("district", "year", F.col("annual_total").alias("annual_total_mm"),
                    F.col("annual_max").alias("annual_max_daily"),
                    F.col("season_total").alias("monsoon_total_mm"),
                    F.col("season_avg").alias("monsoon_avg_daily"),
                    F.col("season_max").alias("monsoon_max_daily"),
                    F.col("season_wet_days").alias("monsoon_rainy_days"),
                    F.col("pre_season_total").alias("premonsoon_total_mm")))
    p = labels.join(s, ["district", "year"], "left")
    # joined on the district name alone, as the reference does
    p = p.join(dim.select("district", "province", "lat", "lon", "elevation_m", "terrain_type",
                          "river_proximity", "flood_risk_geo"), "district", "left")
    p = p.withColumns({
        "terrain_code": dictionary_encode("terrain_type", fv.TERRAIN_CODES, None),
        "geo_risk_code": dictionary_encode("flood_risk_geo", fv.RISK_CODES, None),
        "province_code": dictionary_encode("province", fv.PROVINCE_CODES, None)})
    p = p.withColumn("flood_intensity_score", composite_intensity(
        "monsoon_total_mm", "annual_max_daily", "monsoon_rainy_days", "river_proximity",
        "geo_risk_code", "elevation_m", fv.SCORE_W_SEASON, fv.SCORE_W_MAX, fv.SCORE_W_RAINY))
    p = feat.fill_and_round(p, 0.0, 4)
    cat = bucketize("flood_intensity_score", fv.INTENSITY_CUTS, fv.INTENSITY_LABELS)
    return (p.withColumn("flood_intensity_category", cat)
             .withColumn("flood_intensity_code",
                         dictionary_encode("flood_intensity_category", fv.INTENSITY_CODES)))


def training_matrix(features: DataFrame, fit: DataFrame | None = None,
                    base: Sequence[str] = BASE_FEATURES) -> DataFrame:
    """Base features (missing ones skipped, nulls -> 0) plus the 14 engineered ones.

    ``fit`` is the frame the priors, anomaly and pressure are estimated on; the
    default (``features`` itself) reproduces the reference, which uses all rows.
    """
    have = [c for c in base if c in features.columns]
    x = features.na.fill(0, subset=have)
    x = feat.interaction_features(
        x, "monsoon_total_mm", "monsoon_avg_daily", "monsoon_max_daily", "monsoon_rainy_days",
        "premonsoon_total_mm", "annual_total_mm", "flood_intensity_score", "river_proximity",
        "geo_risk_code", "elevation_m", low_elev_cut=100.0)
    x = x.withColumnsRenamed({"season_intensity": "monsoon_intensity", "pre_season_ratio": "premonsoon_ratio"})
    x = feat.smoothed_prior(x, "district", "flooded", fv.ENTITY_PRIOR_M, "district_flood_prior", fit)
    x = feat.smoothed_prior(x, "province", "flooded", fv.GROUP_PRIOR_M, "province_flood_prior", fit,
                            few_keys=True)
    x = feat.entity_anomaly(x, "district", "monsoon_total_mm", "monsoon_anomaly", fit)
    return feat.period_pressure(x, "year", "monsoon_total_mm", "year_rain_pressure", fit)
