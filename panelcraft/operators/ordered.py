"""Exact ordered numbering and running sums without one-task windows.

``row_number() over (partition by g order by o)`` and running sums are needed by
the split, the folds, the bags, the ROC curve and exact quantiles.  A plain
window puts each ``g`` (or, without ``g``, the whole table) into one task, which
does not survive a group holding a third of all rows.  Here the rows are
range-partitioned on ``(g, o)`` instead, so every task receives a contiguous,
sample-balanced slice of the global order.  Numbers inside a slice come from
``monotonically_increasing_id`` after a sort within the partition, and per-slice
offsets come from a table with at most ``#groups + #slices`` rows.

The order columns must form a total order (end them with a unique key).  The
range bounds come from sampling, which can differ between two evaluations of
the same plan; the sliced rows are therefore written once with a reliable
``checkpoint()`` (into the shared ``spark.checkpoint.dir``) and both the offset
table and the rows are read from that copy.  A lost executor then re-reads the
checkpoint instead of re-sampling.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcraft.session import checkpointed, shuffle_partitions

_PID, _POS = "_oq_pid", "_oq_pos"


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _ranged(df: DataFrame, keys: list[Column], num_partitions: int | None) -> DataFrame:
    n = num_partitions or shuffle_partitions(df.sparkSession)
    return checkpointed(df.repartitionByRange(n, *keys)
              .sortWithinPartitions(*keys)
              .withColumn(_PID, F.spark_partition_id())
              .withColumn(_POS, F.monotonically_increasing_id()
                          - F.shiftleft(F.col(_PID).cast("long"), 33)))


def _null_safe_join(big: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    # ``small`` has at most #groups + #slices rows; AQE turns this into a
    # broadcast join at run time when its measured size is below the threshold,
    # and keeps a shuffle join otherwise.
    s = small
    for k in keys:
        s = s.withColumnRenamed(k, f"_r_{k}")
    cond = [big[k].eqNullSafe(s[f"_r_{k}"]) for k in keys]
    return big.join(s, cond, "inner").drop(*[f"_r_{k}" for k in keys])


def ordered_row_number(df: DataFrame, order_cols: Sequence[str | Column],
                       group_cols: Sequence[str] = (), name: str = "rn",
                       count_name: str | None = None,
                       num_partitions: int | None = None) -> DataFrame:
    """Append ``name`` = 1-based position of each row inside its group.

    With ``count_name`` the group size is appended as well.
    """
    group_cols = list(group_cols)
    keys = _cols(group_cols) + _cols(order_cols)
    r = _ranged(df, keys, num_partitions)
    stats = (r.groupBy(_PID, *group_cols)
              .agg(F.count(F.lit(1)).alias("_oq_cnt"), F.min(_POS).alias("_oq_first")))
    w = Window.partitionBy(*group_cols).orderBy(_PID)
    stats = stats.withColumn(
        "_oq_off",
        F.coalesce(F.sum("_oq_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)))
    if count_name:
        stats = stats.withColumn(count_name, F.sum("_oq_cnt").over(
            w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    keep = [_PID, *group_cols, "_oq_off", "_oq_first"] + ([count_name] if count_name else [])
    out = _null_safe_join(r, stats.select(*keep), [_PID, *group_cols])
    return (out.withColumn(name, F.col("_oq_off") + F.col(_POS) - F.col("_oq_first") + 1)
               .drop(_PID, _POS, "_oq_off", "_oq_first"))


def ordered_running_sum(df: DataFrame, order_cols: Sequence[str | Column],
                        value_cols: Sequence[str], group_cols: Sequence[str] = (),
                        suffix: str = "_cum",
                        num_partitions: int | None = None,
                        next_suffix: str | None = None) -> DataFrame:
    """Append ``<v><suffix>`` = inclusive running sum of ``v`` in order, per group.

    With ``next_suffix`` also ``<v><next_suffix>``, the value of the next row of the group (null
    for the last row).  The row after the last one of a slice is the first of the group's next
    slice; these come with the offsets, from one row for each slice and group.
    """
    group_cols = list(group_cols)
    keys = _cols(group_cols) + _cols(order_cols)
    r = _ranged(df, keys, num_partitions)
    firsts = [F.min_by(v, _POS).alias(f"_oq_f_{v}") for v in value_cols] if next_suffix else []
    stats = r.groupBy(_PID, *group_cols).agg(
        *[F.sum(v).alias(f"_oq_t_{v}") for v in value_cols], *firsts)
    ws = Window.partitionBy(*group_cols).orderBy(_PID)
    w = ws.rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.select(_PID, *group_cols, *[
        F.coalesce(F.sum(f"_oq_t_{v}").over(w), F.lit(0)).alias(f"_oq_o_{v}") for v in value_cols],
        *[F.lead(f"_oq_f_{v}").over(ws).alias(f"_oq_s_{v}") for v in value_cols if next_suffix])
    # inside one slice: a window over that slice only (bounded by the range split)
    wn = Window.partitionBy(_PID, *group_cols).orderBy(_POS)
    wi = wn.rowsBetween(Window.unboundedPreceding, 0)
    last = F.lead(_POS).over(wn).isNull().alias("_oq_last")
    r = r.select("*", *[F.sum(v).over(wi).alias(f"_oq_i_{v}") for v in value_cols],
                 *([last] + [F.lead(v).over(wn).alias(f"_oq_n_{v}") for v in value_cols] if next_suffix else []))
    out = _null_safe_join(r, stats, [_PID, *group_cols])
    following = [F.when(F.col("_oq_last"), F.col(f"_oq_s_{v}")).otherwise(F.col(f"_oq_n_{v}"))
                 .alias(f"{v}{next_suffix}") for v in value_cols if next_suffix]
    out = out.select("*", *[(F.col(f"_oq_o_{v}") + F.col(f"_oq_i_{v}")).alias(f"{v}{suffix}")
                            for v in value_cols], *following)
    drop = [_PID, _POS, "_oq_last"] + [f"_oq_{t}_{v}" for v in value_cols for t in ("o", "i", "s", "n")]
    return out.drop(*drop)


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float],
                    group_cols: Sequence[str] = (), tiebreak: Sequence[str] = ()) -> DataFrame:
    """Linear-interpolated quantiles (numpy / ``quantile_cont`` rule), exact.

    Returns one row per group with columns ``q_<i>`` for each probability.
    Only the (at most two) rows adjacent to each cut are kept after numbering,
    so no group is ever gathered into one buffer.
    """
    group_cols = list(group_cols)
    # missing values (null, NaN) are left out; Spark would sort NaN above every number
    base = df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col)))
    numbered = ordered_row_number(base, [F.col(col), *_cols(tiebreak)], group_cols,
                                  name="_q_rn", count_name="_q_n")
    h = [(F.col("_q_n") - 1) * F.lit(float(p)) for p in probs]
    lo = [F.floor(x) + 1 for x in h]
    hi = [F.least(F.ceil(x) + 1, F.col("_q_n")) for x in h]
    near = F.lit(False)
    for a, b in zip(lo, hi):
        near = near | (F.col("_q_rn") == a) | (F.col("_q_rn") == b)
    aggs = []
    for i, x in enumerate(h):
        v_lo = F.max(F.when(F.col("_q_rn") == lo[i], F.col(col)))
        v_hi = F.max(F.when(F.col("_q_rn") == hi[i], F.col(col)))
        frac = F.max(x - F.floor(x))
        # lo + (hi - lo) * frac, the interpolation rule of quantile_cont
        aggs.append((v_lo + (v_hi - v_lo) * frac).alias(f"q_{i}"))
    return numbered.where(near).groupBy(*group_cols).agg(*aggs)
