"""One key holding a third (here: half) of all rows must not land in one task."""

from pyspark.sql import functions as F

from panelcraft.operators import aggregate as agg
from panelcraft.operators import ordered as od


def _skewed(spark, n=60000):
    # key 0 holds half of the rows, the rest spread over 1000 keys
    return spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 1000).alias("k"),
        (F.col("id") % 97).cast("double").alias("v"))


def test_range_slices_balanced_under_skew(spark):
    df = _skewed(spark)
    r = od._ranged(df, [F.col("k"), F.col("id")], 16)
    sizes = [row["n"] for row in r.groupBy(od._PID).agg(F.count("*").alias("n")).collect()]
    # the hot key is split across many slices: no slice is far above the mean
    assert max(sizes) < 2.5 * (sum(sizes) / len(sizes))


def test_row_number_exact_for_hot_group(spark):
    df = _skewed(spark)
    got = od.ordered_row_number(df, ["id"], ["k"], "rn", "n", num_partitions=16)
    hot = got.where(F.col("k") == 0).agg(F.min("rn"), F.max("rn"), F.countDistinct("rn"),
                                         F.max("n")).first()
    assert tuple(hot) == (1, 30000, 30000, 30000)
    # rn follows id order inside the hot group
    bad = got.where(F.col("k") == 0).where(F.col("rn") != F.col("id") / 2 + 1).count()
    assert bad == 0


def test_dedupe_and_season_on_hot_key(spark):
    df = _skewed(spark).withColumn("day", F.make_date(F.lit(2020), (F.col("id") % 12 + 1).cast("int"),
                                                      F.lit(1)))
    s = agg.season_features(df, "k", "day", "v", wet_cut=50.0)
    hot = s.where(F.col("k") == 0).first()
    ref = df.where(F.col("k") == 0).agg(F.sum("v")).first()[0]
    assert hot["annual_total"] == ref
    d = agg.dedupe_keep_first(df, ["k"], "id")
    assert d.where(F.col("k") == 0).first()["v"] == 0.0
    assert d.count() == df.select("k").distinct().count()


def test_smote_many_copies_per_row(spark):
    """3 minority rows facing 300k majority rows: ~100k copies per row, chunked."""
    from panelcraft.operators.sampling import smote
    df = spark.range(300003).select(
        F.col("id"), F.array((F.col("id") % 7).cast("double"), (F.col("id") % 11).cast("double")).alias("v"),
        (F.col("id") < 3).cast("int").alias("y"))
    syn = smote(df, "id", "v", "y", 1, 5, 42)
    stats = syn.agg(F.count("*").alias("n"), F.countDistinct("syn_id").alias("d"),
                    F.min("syn_id").alias("lo"), F.max("syn_id").alias("hi")).first()
    need = 300000 - 3
    assert tuple(stats) == (need, need, 0, need - 1)
