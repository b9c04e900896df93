"""Exact k nearest neighbours on pivot cells: a tile is only compared with those that can matter.

1. Equal vectors become one point that keeps the least ``k + 1`` ids, so copies cost nothing.
2. Every point goes to the cell of its nearest pivot (at most ``PIVOTS`` of them, the points with
   the least id hashes).  Cells above ``block_rows`` are split by hash into tiles.
3. Each tile finds the k nearest within itself; the k-th distance bounds the true one from above.
4. A point asks every other cell that the triangle inequality doesn't exclude: one whose
   nearest possible point is no farther than the bound.  The lower limits are distance to
   the cell's pivot less its radius, its least radius less that distance, and the
   half-space between both pivots.  Limits have slack for rounding; the final
   distances are computed exactly and ties go by id.
5. Askers of a tile are split like tiles, so no group is above about twice ``block_rows``.

What comes to the driver or is broadcast is bounded by ``PIVOTS``: the pivots and three figures a cell.
How much is excluded depends on the data; for vectors without any structure in many
dimensions nothing is, and the cost is that of comparing all tiles.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcraft.session import written

PIVOTS = 4096
_CHUNK = 512                    # points whose distances to all pivots are held at once


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    d2 = (x * x).sum(1)[:, None] + (p * p).sum(1)[None, :] - 2.0 * x @ p.T
    return np.sqrt(np.maximum(d2, 0.0))


def _chunks(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for pdf in frames:
        for a in range(0, len(pdf), _CHUNK):
            part = pdf.iloc[a:a + _CHUNK]
            yield part, np.stack(part["vec"].to_numpy()).astype(np.float64)


def _within_tile(block: Callable[[pd.DataFrame], pd.DataFrame], k: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = block(pd.concat([pdf.assign(_role=0), pdf.assign(_role=1)]))
        found = found.sort_values(["id", "dist", "nn_id"])
        near, nn, dist = (found[c].to_numpy() for c in ("id", "nn_id", "dist"))
        lo, hi = (np.searchsorted(near, pdf["id"].to_numpy(), side) for side in ("left", "right"))
        full = hi - lo >= k
        bound = np.full(len(pdf), np.inf)
        bound[full] = dist[hi[full] - 1]
        return pdf[["id", "vec", "cell", "sub"]].assign(
            bound=bound, nn_id=[nn[a:b] for a, b in zip(lo, hi)], dist=[dist[a:b] for a, b in zip(lo, hi)])
    return run


def pivot_search(points: DataFrame, k: int, block_rows: int,
                 block: Callable[[int], Callable[[pd.DataFrame], pd.DataFrame]],
                 most: int = PIVOTS) -> tuple[DataFrame, dict[str, int]]:
    """(id, nn_rank, nn_id, dist) of ``points`` (id, vec), no two of equal vectors, and a report.

    ``block(k)`` compares the rows of ``_role`` 0 with those of ``_role`` 1 of one group.  The
    report holds the numbers of points, cells and tiles, and of point pairs compared.
    """
    spark = points.sparkSession
    m = points.count()
    chosen = (points.orderBy(F.xxhash64("id"), "id").limit(min(most, max(1, math.ceil(4 * m / block_rows))))
              .select("vec").collect())
    if not chosen:
        return points.select("id", F.lit(1).alias("nn_rank"), F.col("id").alias("nn_id"), F.lit(0.0).alias("dist")), {
            "points": 0, "cells": 0, "tiles": 0, "pairs": 0}
    pivots = np.array([r["vec"] for r in chosen], dtype=np.float64)
    shared = spark.sparkContext.broadcast(pivots)

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, x in _chunks(frames):
            d = _distances(x, shared.value)
            cell = d.argmin(axis=1)
            yield part.assign(cell=cell.astype(np.int32), away=d[np.arange(len(x)), cell])

    placed = written(points.mapInPandas(assign, "id long, vec array<double>, cell int, away double"), "knn-cells")
    n, radius, least = np.zeros(len(pivots), dtype=np.int64), np.zeros(len(pivots)), np.zeros(len(pivots))
    for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("hi"), F.min("away").alias("lo")).collect():
        n[r["cell"]], radius[r["cell"]], least[r["cell"]] = r["n"], r["hi"], r["lo"]
    subs = -(-n // block_rows)
    sizes = spark.createDataFrame([(j, int(s)) for j, s in enumerate(subs) if s], "cell int, subs int")
    tiled = (placed.join(F.broadcast(sizes), "cell")                    # at most PIVOTS rows
             .select("id", "vec", "cell", F.pmod(F.xxhash64("id", F.lit(1)), "subs").cast("int").alias("sub")))
    one = block(k)
    first = written(tiled.groupBy("cell", "sub").applyInPandas(
        _within_tile(one, k), "id long, vec array<double>, cell int, sub int, bound double, "
                              "nn_id array<long>, dist array<double>"), "knn-within")

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = shared.value
        reach = np.sqrt((p * p).sum(1)).max()
        many = n > k
        for part, x in _chunks(frames):
            at, own, d = np.arange(len(x)), part["cell"].to_numpy(), _distances(x, p)
            scale = np.sqrt((x * x).sum(1)) + reach
            bound = part["bound"].to_numpy()
            if many.any():                               # k points at least lie within the whole cell
                bound = np.minimum(bound, (d[:, many] + radius[many]).min(axis=1))
            bound = bound + 1e-6 * scale
            between = _distances(p[own], p)
            with np.errstate(divide="ignore", invalid="ignore"):
                half = (d * d - (d[at, own] ** 2)[:, None] - 1e-9 * (scale * scale)[:, None]) / (2 * between)
            half[~(between > 0)] = 0.0
            low = np.maximum(np.maximum(d - radius, least - d), half)
            need = (n > 0) & (low <= bound[:, None])
            need[at, own] = subs[own] > 1
            yield pd.DataFrame({"id": part["id"], "vec": part["vec"], "own": own, "sub": part["sub"],
                                "cells": [np.flatnonzero(row).astype(np.int32) for row in need]})

    asked = written(first.select("id", "vec", "cell", "sub", "bound").mapInPandas(
        ask, "id long, vec array<double>, own int, sub int, cells array<int>"), "knn-asked")
    shared.destroy()                                     # both tables that use it are written
    askers = np.zeros(len(pivots), dtype=np.int64)
    for r in asked.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count("*").alias("n")).collect():
        askers[r["cell"]] = r["n"]
    parts = -(-askers // block_rows)
    plan = F.broadcast(spark.createDataFrame(                            # at most PIVOTS rows
        [(j, int(s), int(t)) for j, (s, t) in enumerate(zip(subs, parts)) if t], "cell int, subs int, parts int"))
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    queries = (asked.select("id", "vec", "own", F.col("sub").alias("own_sub"), F.explode("cells").alias("cell"))
               .join(plan, "cell").select("*", upto("subs").alias("sub"))
               .where((F.col("cell") != F.col("own")) | (F.col("sub") != F.col("own_sub")))
               .select("id", "vec", "cell", "sub", F.pmod(F.xxhash64("id", F.lit(2)), "parts").cast("int").alias("part"),
                       F.lit(0).alias("_role")))
    held = (tiled.join(plan.select("cell", "parts"), "cell")
            .select("id", "vec", "cell", "sub", upto("parts").alias("part"), F.lit(1).alias("_role")))
    more = queries.unionByName(held).groupBy("cell", "sub", "part").applyInPandas(
        lambda pdf: one(pdf), "id long, nn_id long, dist double")
    near = first.select("id", F.explode(F.arrays_zip("nn_id", "dist")).alias("f")).select("id", "f.nn_id", "f.dist")
    w = Window.partitionBy("id").orderBy("dist", "nn_id")                # at most k rows a tile asked
    best = (near.unionByName(more).withColumn("nn_rank", F.row_number().over(w)).where(F.col("nn_rank") <= k)
            .select("id", "nn_rank", "nn_id", "dist"))
    own_pairs = int((n * -(-n // np.maximum(subs, 1))).sum())
    return best, {"points": m, "cells": int((n > 0).sum()), "tiles": int(subs.sum()),
                  "pairs": own_pairs + int((askers * n).sum())}


def knn_pivots(rows: DataFrame, k: int, block_rows: int,
               block: Callable[[int], Callable[[pd.DataFrame], pd.DataFrame]]) -> DataFrame:
    """(id, nn_rank, nn_id, dist) of ``rows`` (id, vec), of which many may have equal vectors.

    A point stands for all rows of a vector under their least id.  Only the least k + 1 ids of a
    vector can be among anyone's k nearest, so hot vectors stay short lists; the rows meet
    the list of their point by a join whose hot side AQE may split, as lists are one row each.
    """
    rows = written(rows, "knn-rows")
    lists = written(rows.groupBy("vec").agg(F.min("id").alias("point"), F.count("*").alias("n")), "knn-points")
    best, _ = pivot_search(lists.select(F.col("point").alias("id"), "vec"), k, block_rows, block)
    if lists.where(F.col("n") > 1).isEmpty():
        return best
    by = Window.partitionBy("point").orderBy("id")                       # cut to k + 1 rows a key before the shuffle
    members = written(rows.join(lists.select("vec", "point"), "vec").select("id", "point"), "knn-members")
    few = members.withColumn("r", F.row_number().over(by)).where(F.col("r") <= k + 1).select("id", "point")
    reach = best.select(F.col("id").alias("for"), F.col("nn_id").alias("point"), "dist").unionByName(
        lists.select(F.col("point").alias("for"), "point", F.lit(0.0).alias("dist")))
    w = Window.partitionBy("for").orderBy("dist", "id")                  # at most (k + 1) ** 2 rows
    found = (reach.join(few, "point").withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1)
             .groupBy("for").agg(F.array_sort(F.collect_list(F.struct("dist", "id"))).alias("near")))
    others = members.join(found, members["point"] == found["for"]).select(
        members["id"], F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, k).alias("near"))
    return others.select("id", F.posexplode("near").alias("p", "x")).select(
        "id", (F.col("p") + 1).alias("nn_rank"), F.col("x.id").alias("nn_id"), F.col("x.dist").alias("dist"))
