"""The reference's own pipeline on a hand-made fixture (FIXTURES.md schemas)."""

import json
import math

from pyspark.sql import functions as F

from panelcraft.plans import domain


def _payload(days):
    return json.dumps({"properties": {"parameter": {"PRECTOTCORR": days}}})


def test_reference_domain_end_to_end(spark):
    raw = spark.createDataFrame([
        ("Karachi", "Sindh", 24.8, 67.0, 8, "coastal", 0, 1),
        ("Lahore", "Punjab", 31.5, 74.3, 217, "plains", 1, 2),
        ("Lahore", "Punjab", 31.5, 74.3, 218, "plains", 1, 3),        # repeat: first wins
        ("Islamabad", "ICT", 33.7, 73.0, 540, "hills", 0, 4)],
        "district string, province string, lat double, lon double, elevation_m int, "
        "terrain_type string, river_proximity int, seq int")
    dim = domain.district_dimension(raw)
    geo = {r["district"]: (r["elevation_m"], r["flood_risk_geo"]) for r in dim.collect()}
    assert geo == {"Karachi": (8, "high"), "Lahore": (217, "medium"), "Islamabad": (540, "low")}

    events = spark.createDataFrame([(2010, ["Karachi"]), (2011, ["Lahore", "Karachi"])],
                                   "year int, districts array<string>")
    labels = domain.label_panel(dim, events, 2010, 2011)
    flags = {(r["district"], r["year"]): r["flooded"] for r in labels.collect()}
    assert len(flags) == 6 and flags[("Karachi", 2010)] == 1 and flags[("Lahore", 2010)] == 0

    pay = spark.createDataFrame([
        ("Karachi", 24.8, 67.0, _payload({"20100701": 10.0, "20100702": -999, "20100801": 4.0,
                                          "20100415": 2.5, "20101340": 50.0})),
        ("Lahore", 31.5, 74.3, _payload({"20110715": 30.0}))],
        "district string, lat double, lon double, payload string")
    rain = domain.daily_rainfall(pay)
    assert rain.count() == 6
    fp = domain.flood_features(labels, dim, rain)
    k = fp.where((F.col("district") == "Karachi") & (F.col("year") == 2010)).first()
    # invalid date 20101340 leaves the aggregates; -999 became 0.0
    assert (k["monsoon_total_mm"], k["annual_total_mm"], k["monsoon_rainy_days"]) == (14.0, 16.5, 1)
    assert k["premonsoon_total_mm"] == 2.5 and k["province_code"] == 2 and k["geo_risk_code"] == 3
    expect = round((14.0 * 0.6 + 10.0 * 2 + 1 * 1.5) * 1 * 3 / math.sqrt(9), 4)
    assert k["flood_intensity_score"] == expect and k["flood_intensity_category"] == "low"
    i = fp.where(F.col("district") == "Islamabad").first()
    assert i["province_code"] == 0 and i["flood_intensity_score"] == 0.0
    assert i["flood_intensity_category"] == "very_low"

    tm = domain.training_matrix(fp)
    assert tm.count() == 6
    assert {"district_flood_prior", "province_flood_prior", "monsoon_anomaly",
            "year_rain_pressure", "premonsoon_ratio"} <= set(tm.columns)


def test_label_panel_from_keyed_list_map(spark):
    dim = spark.createDataFrame([("A",), ("B",), ("C",)], "district string")
    ev = spark.createDataFrame([({2010: ["A", "C"], 2011: ["B"]},)], "events map<int, array<string>>")
    got = {(r["district"], r["year"]): r["flooded"]
           for r in domain.label_panel(dim, ev, 2010, 2011).collect()}
    assert got == {("A", 2010): 1, ("B", 2010): 0, ("C", 2010): 1,
                   ("A", 2011): 0, ("B", 2011): 1, ("C", 2011): 0}
