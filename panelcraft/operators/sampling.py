"""Splitting, folds, scaling, exact k-NN, SMOTE, class weights, balanced bags.

Randomness is hash-based (``md5`` of the row key and a seed), never ``rand()``:
the result does not depend on partitioning and is identical after a retry.
Within-class ranks use ``ordered_row_number`` (range slices), not a window per
class, because one class can hold most of the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcraft.functions.expressions import hash_key, hash_uniform
from panelcraft.operators.ordered import ordered_row_number
from panelcraft.operators.pivot_knn import knn_pivots
from panelcraft.session import shuffle_partitions, written
from panelcraft.sources.tables import lookup_map


def _hash_order(keys: Sequence[str], seed: int | str, *salt: Column) -> list[Column]:
    return [F.md5(hash_key(*keys, F.lit(str(seed)), *salt)), *[F.col(k) for k in keys]]


def _joined_back(df: DataFrame, chosen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Only keys, class and order are numbered; the rows' other columns meet the result here."""
    return df.join(chosen, list(keys))


def stratified_split(df: DataFrame, label: str, keys: Sequence[str], test_fraction: float = 0.2,
                     seed: int = 42, name: str = "split") -> DataFrame:
    """``name`` = 'test' for the first ``ceil(f * n_c)`` rows of each class in hash
    order, else 'train'.  Each class's test share is exact to one row."""
    r = ordered_row_number(df.select(label, *keys), _hash_order(keys, seed), [label], "_sp_rn", "_sp_n")
    is_test = F.col("_sp_rn") <= F.ceil(F.col("_sp_n") * F.lit(float(test_fraction)))
    chosen = r.select(*keys, F.when(is_test, F.lit("test")).otherwise(F.lit("train")).alias(name))
    return _joined_back(df, chosen, keys)


def stratified_folds(df: DataFrame, label: str, keys: Sequence[str], k: int = 5,
                     seed: int = 42, name: str = "fold") -> DataFrame:
    """``name`` = (rank within class in hash order - 1) mod k: class sizes per fold
    differ by at most one row."""
    r = ordered_row_number(df.select(label, *keys), _hash_order(keys, seed), [label], "_fd_rn")
    return _joined_back(df, r.select(*keys, ((F.col("_fd_rn") - 1) % k).cast("int").alias(name)), keys)


def fit_standardizer(fit: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Fit: mean and POPULATION std of each column in one aggregate pass.

    Like MLlib's scaler models, the fitted state is one row of 2 x d numbers
    (bounded by the schema, not the data) held by the caller.
    """
    row = fit.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(columns)],
                  *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(columns)]).first()
    return {c: (row[f"m_{i}"], row[f"s_{i}"]) for i, c in enumerate(columns)}


def apply_standardizer(df: DataFrame, stats: dict[str, tuple[float, float]],
                       suffix: str = "") -> DataFrame:
    """Transform: ``(x - mean) / std``; a zero (or undefined) std divides by 1."""
    out = {}
    for c, (m, s) in stats.items():
        den = 1.0 if (s is None or s == 0 or s != s) else float(s)
        out[c + suffix] = (F.col(c) - F.lit(m if m is not None else 0.0)) / F.lit(den)
    return df.withColumns(out)


def standardize(df: DataFrame, columns: Sequence[str], fit: DataFrame | None = None,
                suffix: str = "") -> DataFrame:
    """``(x - mean) / std`` with the mean and population std of ``fit`` (default: df)."""
    return apply_standardizer(df, fit_standardizer(df if fit is None else fit, columns), suffix)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Per class: count, "balanced" weight n / (k * n_c), and the positive weight
    n_neg / max(n_pos, 1) of the whole frame."""
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    # totals over the per-class table (one row per class): no second pass, no subquery
    w = Window.partitionBy()
    n = F.sum("n_class").over(w)
    k = F.count(F.lit(1)).over(w)
    p = F.coalesce(F.sum(F.when(F.col(label) == 1, F.col("n_class"))).over(w), F.lit(0))
    return per.select(label, "n_class",
                      (n.cast("double") / (k * F.col("n_class"))).alias("balanced_weight"),
                      ((n - p).cast("double") / F.greatest(p, F.lit(1))).alias("pos_weight"))


def with_class_weight(df: DataFrame, label: str, name: str = "weight",
                      mode: str = "balanced") -> DataFrame:
    """Attach a per-row weight column ('balanced' or 'positive') for ``weightCol``."""
    w = class_weights(df, label)
    if mode == "balanced":
        m = lookup_map(w, label, "balanced_weight")
        return df.withColumn("_wm", m).withColumn(name, F.try_element_at("_wm", F.col(label))).drop("_wm")
    pw = w.select(F.max("pos_weight")).scalar()
    return df.withColumn(name, F.when(F.col(label) == 1, pw).otherwise(F.lit(1.0)))


def balanced_bags(df: DataFrame, label: str, keys: Sequence[str], n_bags: int,
                  seed: int = 42, minority: int = 1) -> DataFrame:
    """For each bag: every minority row plus ``n_minority`` majority rows drawn by hash
    rank (without replacement).  Output: the rows with a ``bag`` column."""
    per = {bool(r["m"]): r["n"] for r in df.groupBy((F.col(label) == minority).alias("m")).agg(
        F.count(F.lit(1)).alias("n")).collect()}          # two rows
    n_min, n_maj = per.get(True, 0), per.get(False, 0)
    bags = F.explode(F.sequence(F.lit(0), F.lit(n_bags - 1))).alias("bag")
    majority = df.where(F.col(label) != minority).select(*keys, bags)
    # the rank decides by the first 8 digits of the same hash: only rows below a bound that holds
    # n_min of them with certainty enough are ranked, and the bound is raised if it was short
    first = F.conv(F.substring(_hash_order(keys, seed, F.col("bag"))[0], 1, 8), 16, 10).cast("long")
    share = min(1.0, (n_min + 8 * math.sqrt(n_min + 1) + 16) / max(n_maj, 1))
    while True:
        few = written(majority.where(first < F.lit(math.ceil(share * (1 << 32)))), "bag-candidates")
        enough = few.groupBy("bag").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min(n_min, n_maj)).count()
        if share >= 1.0 or enough == n_bags:
            break
        share = min(1.0, share * 2)
    ranked = ordered_row_number(few, _hash_order(keys, seed, F.col("bag")), ["bag"], "_bg_rn")
    picked = df.join(ranked.where(F.col("_bg_rn") <= n_min).select(*keys, "bag"), list(keys))
    return df.where(F.col(label) == minority).select("*", bags).unionByName(picked)


# ----------------------------------------------------------------------------- k-NN
def _knn_block(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        q = pdf[pdf["_role"] == 0]
        r = pdf[pdf["_role"] == 1]
        empty = pd.DataFrame({"id": pd.Series([], dtype="int64"), "nn_id": pd.Series([], dtype="int64"),
                              "dist": pd.Series([], dtype="float64")})
        if len(q) == 0 or len(r) == 0:
            return empty
        Q = np.stack(q["vec"].to_numpy()).astype(np.float64)
        R = np.stack(r["vec"].to_numpy()).astype(np.float64)
        qid, rid = q["id"].to_numpy(), r["id"].to_numpy()
        rn = (R * R).sum(1)
        kk = min(k, len(r))
        keep = min(kk + 4, len(r))
        ids_out, nn_out, d_out = [], [], []

        def emit(qi, cand_idx, exact):
            order = np.lexsort((rid[cand_idx], exact))[:k]
            ok = np.isfinite(exact[order])
            ids_out.append(np.full(ok.sum(), qi, dtype=np.int64))
            nn_out.append(rid[cand_idx][order][ok])
            d_out.append(exact[order][ok])

        for s in range(0, len(Q), 256):          # bounded memory: 256 x |R| at a time
            Qs, ids = Q[s:s + 256], qid[s:s + 256]
            qn = (Qs * Qs).sum(1)
            d2 = qn[:, None] + rn[None, :] - 2.0 * Qs @ R.T     # approximate, for selection
            d2[ids[:, None] == rid[None, :]] = np.inf          # no self match
            kth = np.partition(d2, kk - 1, axis=1)[:, kk - 1]
            tol = 1e-9 * (qn + rn.max()) + 1e-12
            within = np.isfinite(d2) & (d2 <= (kth + tol)[:, None])
            n_within = within.sum(1)
            part = np.argpartition(d2, keep - 1, axis=1)[:, :keep] if keep < len(r) else \
                np.tile(np.arange(len(r)), (len(Qs), 1))
            fast = n_within <= keep        # every near-tie candidate is inside ``part``
            if fast.any():
                rows = np.nonzero(fast)[0]
                cand = part[rows]                                        # (n, keep)
                exact = np.sqrt(((R[cand] - Qs[rows][:, None, :]) ** 2).sum(-1))
                exact[~np.isfinite(np.take_along_axis(d2[rows], cand, 1))] = np.inf
                order = np.lexsort((rid[cand], exact), axis=-1)[:, :k]
                ex = np.take_along_axis(exact, order, 1)
                nn = np.take_along_axis(rid[cand], order, 1)
                ok = np.isfinite(ex)
                ids_out.append(np.repeat(ids[rows], ok.sum(1)))
                nn_out.append(nn[ok])
                d_out.append(ex[ok])
            for row in np.nonzero(~fast)[0]:   # many exact ties: rank all of them exactly
                c = np.nonzero(within[row])[0]
                emit(ids[row], c, np.sqrt(((R[c] - Qs[row]) ** 2).sum(1)))
        if not ids_out:
            return empty
        return pd.DataFrame({"id": np.concatenate(ids_out), "nn_id": np.concatenate(nn_out),
                             "dist": np.concatenate(d_out)})
    return run


def knn_within(df: DataFrame, id_col: str, vec_col: str, k: int = 5,
               block_rows: int = 8192, method: str = "exact", **lsh) -> DataFrame:
    """k nearest neighbours (Euclidean, ties by id) of every row among the rows.

    ``method="exact"`` takes one task up to ``block_rows`` rows.  Beyond, rows are dealt to
    pivot cells, and a tile is only compared with cells that can hold a nearer row
    (``operators/pivot_knn.py``); no pair is ever materialised as a row, and no group is above about twice
    ``block_rows`` whatever the skew.  ``method="lsh"`` is approximate: see ``knn_lsh``, which takes the
    remaining arguments.  Output: ``id_col, nn_rank, nn_id, dist``.
    """
    if method == "lsh":
        return knn_lsh(df, id_col, vec_col, k, **lsh)
    if method != "exact":
        raise ValueError(f"unknown method {method!r}")
    base = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    if base.limit(block_rows + 1).count() > block_rows:
        found = knn_pivots(base, k, block_rows, _knn_block)
    else:
        both = base.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("_role"))
        cand = both.groupBy().applyInPandas(_knn_block(k), "id long, nn_id long, dist double")
        w = Window.partitionBy("id").orderBy("dist", "nn_id")
        found = cand.withColumn("nn_rank", F.row_number().over(w)).where(F.col("nn_rank") <= k)
    return found.select(F.col("id").alias(id_col), "nn_rank", "nn_id", "dist")


def knn_lsh(df: DataFrame, id_col: str, vec_col: str, k: int = 5, tables: int = 8,
            bucket_length: float | None = None, radius: float = math.inf, seed: int = 42) -> DataFrame:
    """Approximate k nearest neighbours by bucketed random projections (MLlib's LSH).

    Rows that share a bucket in any of ``tables`` hash tables within ``radius`` are compared.
    A longer ``bucket_length`` finds more and compares more (default: from the spread of the
    coordinates).  Output as ``knn_within``; a row may have fewer than ``k`` neighbours.
    """
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector
    v = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("x"))
    if bucket_length is None:
        spread = v.select(F.explode("x").alias("x")).agg(F.stddev_pop("x")).first()[0]
        bucket_length = max(4.0 * (spread or 0.0), 1e-9)
    v = v.select("id", array_to_vector("x").alias("v"))
    lsh = BucketedRandomProjectionLSH(inputCol="v", outputCol="h", bucketLength=bucket_length,
                                      numHashTables=tables, seed=seed)
    pairs = lsh.fit(v).approxSimilarityJoin(v, v, radius, "dist").select(
        F.col("datasetA.id").alias("id"), F.col("datasetB.id").alias("nn_id"), "dist").where("id <> nn_id")
    w = Window.partitionBy("id").orderBy("dist", "nn_id")
    return (pairs.withColumn("nn_rank", F.row_number().over(w)).where(F.col("nn_rank") <= k)
                 .select(F.col("id").alias(id_col), "nn_rank", "nn_id", "dist"))


def smote(df: DataFrame, id_col: str, vec_col: str, label: str, minority: int = 1,
          k: int = 5, seed: int = 42, block_rows: int = 8192, method: str = "exact") -> DataFrame:
    """Synthetic minority rows until both classes have equal counts.

    Synthetic row ``s`` starts from the minority row of hash ordinal ``s mod m``,
    picks one of its ``min(k, m-1)`` nearest minority neighbours and a gap
    ``g`` in [0, 1) from ``md5(s, seed)``, and is ``x + g * (nn - x)``.
    Output: ``syn_id, base_id, nn_id, gap, <vec_col>, <label>``.  Fewer than 2
    minority rows are an error (unless nothing is needed).  ``method``: see ``knn_within``.
    """
    mino = df.where(F.col(label) == minority).select(id_col, vec_col)
    n_min = df.where(F.col(label) == minority).select(F.count(F.lit(1))).first()[0]
    n_maj = df.where(F.col(label) != minority).select(F.count(F.lit(1))).first()[0]
    need = n_maj - n_min
    if need <= 0:                      # balanced already: nothing to add
        return df.sparkSession.createDataFrame([], f"syn_id long, base_id long, nn_id long, gap double, "
                                                   f"{vec_col} array<double>, {label} int")
    if n_min < 2:
        raise ValueError(f"SMOTE needs two rows of class {minority} at least, there are {n_min}")
    kk = min(k, n_min - 1)
    nn = knn_within(mino, id_col, vec_col, kk, block_rows, method)
    if method == "lsh":                # approximate: a row may have found fewer than kk
        nn = nn.withColumn("_found", F.count(F.lit(1)).over(Window.partitionBy(id_col)))
    ordn = ordered_row_number(mino, [F.md5(hash_key(id_col, F.lit(str(seed)))), F.col(id_col)],
                              [], "_o")
    per, extra = divmod(need, n_min)
    cnt = F.lit(per) + F.when(F.col("_o") <= extra, 1).otherwise(0)
    # A row's copies are generated in chunks of at most ``chunk`` rows that are
    # spread over tasks first, so a tiny minority facing a huge majority never
    # makes one task produce all the copies of one row.
    chunk = 65536
    n_parts = max(1, min(shuffle_partitions(df.sparkSession), math.ceil(need / chunk)))
    chunks = (ordn.where(cnt > 0)
                  .select(F.col(id_col).alias("base_id"),
                          F.col(vec_col).cast("array<double>").alias("_x"), "_o",
                          cnt.alias("_cnt"),
                          F.explode(F.sequence(F.lit(0), F.floor((cnt - 1) / chunk).cast("int")))
                          .alias("_ch"))
                  .repartition(n_parts, "base_id", "_ch"))
    j_lo = F.col("_ch") * chunk
    j_hi = F.least(j_lo + chunk, F.col("_cnt")) - 1
    syn = (chunks.select("base_id", "_x", "_o", F.explode(F.sequence(j_lo, j_hi)).alias("_j"))
                 .withColumn("syn_id", (F.col("_j") * F.lit(n_min) + F.col("_o") - 1).cast("long"))
                 .drop("_j", "_o"))
    syn = syn.select("*",
                     hash_uniform("syn_id", F.lit(seed), F.lit("nn")).alias("_u"),
                     hash_uniform("syn_id", F.lit(seed), F.lit("gap")).alias("gap"))
    found = F.lit(kk)
    if method == "lsh":                # neighbours found differ by row; a row without any takes itself
        held = nn.select(F.col(id_col).alias("base_id"), "_found").distinct()
        syn, found = syn.join(held, "base_id", "left"), F.coalesce("_found", F.lit(0))
        nn = nn.drop("_found").unionByName(mino.select(F.col(id_col).cast("long").alias(id_col)).join(
            held.select(F.col("base_id").alias(id_col)), id_col, "left_anti").select(
            id_col, F.lit(1).alias("nn_rank"), F.col(id_col).alias("nn_id"), F.lit(0.0).alias("dist")))
    syn = syn.withColumn("_pick", (F.floor(F.col("_u") * F.greatest(found, F.lit(1))) + 1).cast("int"))
    nbr = nn.select(F.col(id_col).alias("base_id"), F.col("nn_rank").alias("_pick"), "nn_id")
    vecs = mino.select(F.col(id_col).alias("nn_id"), F.col(vec_col).cast("array<double>").alias("_nv"))
    out = syn.join(nbr, ["base_id", "_pick"]).join(vecs, "nn_id")
    return out.select("syn_id", "base_id", "nn_id", "gap",
                      F.zip_with("_x", "_nv", lambda a, b: a + F.col("gap") * (b - a)).alias(vec_col),
                      F.lit(minority).alias(label))
