"""Role bindings of the operators onto the driver's test tables.

| role               | binding                                                        |
| ------------------ | -------------------------------------------------------------- |
| entity dimension   | supplier x nation x region, group = region name                |
| daily measure      | lineitem (l_suppkey, l_shipdate, l_quantity)                    |
| elevation          | greatest(s_acctbal, 0)                                         |
| river flag         | s_suppkey % 2                                                   |
| terrain            | CASE on s_acctbal                                               |
| label              | 8 * #returned lines > 3 * #lines per (supplier, year)          |
| event membership   | customer x year, 1 if an urgent order exists                    |
| scores             | orders: o_totalprice / 500000, y = (o_orderstatus = 'F')       |
| vectors            | embeddings, label 0 as the minority class                      |

The SQL mirrors of these bindings live in ``panelcraft.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcraft.functions.expressions import geo_rule, rule_cascade

# Parameters of the bound queries (chosen for the test tables' value ranges).
SEASON_MONTHS = (6, 7, 8, 9)
PRE_MONTHS = (4, 5)
WET_CUT = 25.0                       # l_quantity is 1..50
GROUP_CODES = {"AFRICA": 1, "AMERICA": 2, "ASIA": 3, "EUROPE": 4}   # MIDDLE EAST unmapped -> 0
TERRAIN_CUTS = ((1000.0, "coastal"), (4000.0, "plains"), (7000.0, "hills"))
TERRAIN_TOP = "mountains"
# a rule set of its own for suppliers: one rule for each kind of condition
BOUND_RULES = (
    (None, 700, False, {"coastal"}, "high"),
    ({"MIDDLE EAST", "AFRICA"}, 2600, True, None, "high"),
    ({"ASIA"}, None, True, {"mountains", "plains"}, "medium"),
    ({"EUROPE"}, 6100, False, {"plains", "hills"}, "medium"),
    (None, 3300, True, None, "medium"),
)
SCORE_SCALE = 500000.0
URGENT = "1-URGENT"
SEED = 42


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entity_dim(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """entity, name, grp, elevation, river, terrain, geo_risk (one row per supplier), and ``more``
    columns of the supplier table."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    d = (s.join(n, s.s_nationkey == n.n_nationkey, "left")
          .join(r, F.col("n_regionkey") == r.r_regionkey, "left")
          .select(F.col("s_suppkey").alias("entity"), F.col("s_name").alias("name"),
                  F.col("r_name").alias("grp"),
                  F.greatest(F.col("s_acctbal"), F.lit(0.0)).alias("elevation"),
                  (F.col("s_suppkey") % 2).alias("river"), *more,
                  rule_cascade([(F.col("s_acctbal") < cut, lab) for cut, lab in TERRAIN_CUTS],
                               TERRAIN_TOP).alias("terrain")))
    return d.withColumn("geo_risk", geo_rule("grp", "elevation", "river", "terrain",
                                             BOUND_RULES, "low"))


def measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "lineitem")
            .select(F.col("l_suppkey").alias("entity"), F.col("l_shipdate").alias("day"),
                    F.col("l_quantity").alias("amount"), "l_returnflag"))


def scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_id, y, score: the evaluation binding."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("row_id"),
                    (F.col("o_orderstatus") == "F").cast("int").alias("y"),
                    (F.col("o_totalprice") / F.lit(SCORE_SCALE)).alias("score"),
                    F.col("o_orderpriority").alias("grp"))
