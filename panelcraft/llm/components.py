"""Connected components of a link table, by large-star and small-star rounds.

Each round points every node to the least node it has seen (large-star: larger neighbours
of a node; small-star: smaller ones), until nothing changes; a component is then a star around
its least node.  All state is a table of links in the shared folder, written anew each round,
so a lost executor costs one round at most, and the driver only sees counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcraft.llm.common import keyed_join
from panelcraft.session import written


def _large_star(e: DataFrame, total: int) -> DataFrame:
    """``e`` has each link once as (u, v), u > v."""
    both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = (both.groupBy("u").agg(F.min("v").alias("m"), F.count_if(F.col("v") > F.col("u")).alias("n"))
             .filter("n > 0").select(F.col("u").alias("v"), F.least("u", "m").alias("m"), "n"))
    # larger neighbours of a node are the rows of e with it as v
    return keyed_join(e, least, "v", total).select("u", F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame, total: int) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    linked = (keyed_join(e, least, "u", total).filter(F.col("v") != F.col("m"))
              .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return linked.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label) for every node with a link: the least node of its component."""
    e = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                .filter("u <> v").distinct(), "links")
    state = _state(e)
    while state[0]:
        e = written(_large_star(e, state[0]), "links")
        e = written(_small_star(e, e.count()), "links")
        state, last = _state(e), state
        if state == last:
            break
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return nodes.unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
