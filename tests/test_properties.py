"""Properties of the distributed operators against brute force on small inputs."""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelcraft.operators import evaluate as ev
from panelcraft.operators import ordered as od
from panelcraft.operators import sampling as smp

SF = "/root/testdata/sf0.001"


def test_ordered_row_number_matches_window(spark):
    # order keys must be unique: (o_totalprice, o_orderkey)
    df = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_totalprice", "o_orderstatus")
    got = od.ordered_row_number(df, [F.col("o_totalprice").desc(), "o_orderkey"], ["o_orderstatus"],
                                "rn", "n", num_partitions=7)
    w = Window.partitionBy("o_orderstatus").orderBy(F.col("o_totalprice").desc(), "o_orderkey")
    ref = df.withColumn("ref", F.row_number().over(w)).withColumn("nref", F.count("*").over(
        Window.partitionBy("o_orderstatus")))
    j = got.join(ref, ["o_orderkey", "o_totalprice", "o_orderstatus"])
    assert j.where((F.col("rn") != F.col("ref")) | (F.col("n") != F.col("nref"))).count() == 0
    assert j.count() == df.count()


def test_exact_quantiles_match_numpy(spark):
    df = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_totalprice")
    q = od.exact_quantiles(df, "o_totalprice", [0.75, 0.4, 0.0, 1.0], tiebreak=["o_orderkey"]).first()
    v = np.array([r[0] for r in df.select("o_totalprice").collect()])
    assert np.allclose([q["q_0"], q["q_1"], q["q_2"], q["q_3"]], np.quantile(v, [0.75, 0.4, 0.0, 1.0]))


def _scored(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    return o.select((F.col("o_orderstatus") == "F").cast("int").alias("y"),
                    (F.col("o_totalprice") / 500000.0).alias("s"))


def test_auc_antisymmetry_and_brute_force(spark):
    s = _scored(spark)
    a = ev.roc_auc(s, "y", "s").first()["auc"]
    b = ev.roc_auc(s.withColumn("s", -F.col("s")), "y", "s").first()["auc"]
    assert abs(a + b - 1.0) < 1e-12
    rows = s.collect()
    pos = np.array([r["s"] for r in rows if r["y"] == 1])
    neg = np.array([r["s"] for r in rows if r["y"] == 0])
    brute = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert abs(a - brute) < 1e-12


def test_sweep_recall_non_increasing_and_counts(spark):
    s = _scored(spark)
    sw = ev.threshold_sweep(s, "y", "s", 5, 95).orderBy("threshold").collect()
    n = s.count()
    assert all(r["tp"] + r["fp"] + r["fn"] + r["tn"] == n for r in sw)
    rec = [r["recall"] for r in sw]
    assert all(a >= b for a, b in zip(rec, rec[1:]))


def test_split_is_partition_with_exact_strata(spark):
    df = spark.read.parquet(f"{SF}/orders.parquet").select(
        "o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    sp = smp.stratified_split(df, "y", ["o_orderkey"], 0.2, 42)
    assert sp.count() == df.count() and sp.select("o_orderkey").distinct().count() == df.count()
    for r in sp.groupBy("y").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "test").alias("t")).collect():
        assert abs(r["t"] - 0.2 * r["n"]) <= 1


def test_folds_balanced(spark):
    df = spark.read.parquet(f"{SF}/orders.parquet").select(
        "o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    f = smp.stratified_folds(df, "y", ["o_orderkey"], 5, 42)
    for y in (0, 1):
        sizes = [r[1] for r in f.where(F.col("y") == y).groupBy("fold").count().collect()]
        assert max(sizes) - min(sizes) <= 1


def test_smote_balances_and_stays_on_segments(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet").select(
        "vec_id", "embedding", (F.col("label") == 0).cast("int").alias("m"))
    n_min = e.where("m = 1").count()
    n_maj = e.where("m = 0").count()
    syn = smp.smote(e, "vec_id", "embedding", "m", 1, 5, 42)
    assert syn.count() == n_maj - n_min
    vec = {r["vec_id"]: np.array(r["embedding"], dtype=float) for r in e.collect()}
    for r in syn.limit(50).collect():
        x, nn, g = vec[r["base_id"]], vec[r["nn_id"]], r["gap"]
        assert 0.0 <= g < 1.0
        assert np.allclose(np.array(r["embedding"]), x + g * (nn - x))


def test_knn_matches_brute_force(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    got = smp.knn_within(e, "vec_id", "embedding", 3, block_rows=7)   # many tiles
    vec = {r["vec_id"]: np.array(r["embedding"], dtype=float) for r in e.collect()}
    ids = sorted(vec)
    for r in got.where("nn_rank = 1").collect():
        d = sorted((np.sqrt(((vec[r["vec_id"]] - vec[j]) ** 2).sum()), j) for j in ids if j != r["vec_id"])
        assert r["nn_id"] == d[0][1]


def test_knn_exact_with_duplicate_points(spark):
    """A third of the points are copies: ties must be settled by id, never by luck."""
    e = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    dup = e.where(F.col("vec_id") % 3 == 0).select((F.col("vec_id") + 100000).alias("vec_id"), "embedding")
    both = e.unionByName(dup)
    got = smp.knn_within(both, "vec_id", "embedding", 4, block_rows=16)
    vec = {r["vec_id"]: np.array(r["embedding"], dtype=float) for r in both.collect()}
    ids = sorted(vec)
    for r in got.collect():
        q = vec[r["vec_id"]]
        ranked = sorted((np.sqrt(((q - vec[j]) ** 2).sum()), j) for j in ids if j != r["vec_id"])
        assert ranked[r["nn_rank"] - 1][1] == r["nn_id"]


def test_grouped_running_sum_matches_window(spark):
    df = spark.read.parquet(f"{SF}/orders.parquet").select(
        "o_orderkey", "o_orderpriority", F.col("o_totalprice").alias("v"))
    got = od.ordered_running_sum(df, [F.col("v").desc(), "o_orderkey"], ["v"], ["o_orderpriority"],
                                 num_partitions=5)
    w = (Window.partitionBy("o_orderpriority").orderBy(F.col("v").desc(), "o_orderkey")
         .rowsBetween(Window.unboundedPreceding, 0))
    ref = df.withColumn("ref", F.sum("v").over(w))
    j = got.join(ref, ["o_orderkey", "o_orderpriority", "v"])
    assert j.count() == df.count()
    assert j.where(F.abs(F.col("v_cum") - F.col("ref")) > 1e-6 * F.abs(F.col("ref"))).count() == 0


def test_knn_many_exact_ties_ranked_by_id(spark):
    """20 identical points (more than k + 4): neighbours are the copies with the smallest ids."""
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(20)] + [(100 + i, [9.0, float(i), 0.0]) for i in range(10)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r["vec_id"], r["nn_rank"]): (r["nn_id"], r["dist"])
           for r in smp.knn_within(df, "vec_id", "embedding", 3).collect()}
    assert [got[(5, i)] for i in (1, 2, 3)] == [(0, 0.0), (1, 0.0), (2, 0.0)]
    assert [got[(0, i)][0] for i in (1, 2, 3)] == [1, 2, 3]


def test_ordered_row_number_null_group(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, F.lit(None))
                                  .otherwise(F.col("id") % 2).alias("g"))
    got = od.ordered_row_number(df, ["id"], ["g"], "rn", "n", num_partitions=6)
    w = Window.partitionBy("g").orderBy("id")
    ref = df.withColumn("ref", F.row_number().over(w))
    j = got.join(ref, ["id"])
    assert j.count() == 1000 and j.where(F.col("rn") != F.col("ref")).count() == 0


def test_exact_quantiles_skip_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, float("nan")), (4, 3.0), (5, None)],
                               "k int, v double")
    q = od.exact_quantiles(df, "v", [0.5, 1.0], tiebreak=["k"]).first()
    assert (q["q_0"], q["q_1"]) == (2.0, 3.0)
