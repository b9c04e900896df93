"""Document fingerprints by winnowing.

A text's tokens are its words (words longer than ``TOKEN_CHARS`` count as several); each
run of ``k`` tokens has a hash, each window of ``w`` consecutive hashes selects its
minimum (the rightmost one of equal minima), and the fingerprint is the selected hashes
with their positions.  So any run of ``k + w - 1`` tokens that two texts share selects
a common hash in both, and no match shorter than ``k`` tokens counts.  A text of fewer than
``k`` tokens has one hash, of all its tokens; one of fewer than ``w`` hashes is one window.

Everything is an expression over a text of the row.  ``with_next`` gives every
document its successor in ascending id with one shuffle: ids are cut into ranges at
sampled bounds (ids themselves), and the rows at a bound are also sent, as a halo, to
the end of the range before.

Defined cases: a null text counts as empty; texts without words have the hash of no
token, hence equal fingerprints; a null id sorts first; rows of one id are ordered by a hash
of their texts; an empty table gives no rows; a single document follows itself.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from panelcraft.llm.common import let
from panelcraft.session import shuffle_partitions

K, W = 3, 4
TOKEN_CHARS = 24


def _gram_hashes(text: Column, k: int) -> Column:
    tokens = F.regexp_extract_all(text, F.lit(rf"[^\x20\x09-\x0D]{{1,{TOKEN_CHARS}}}"), F.lit(0))
    return let(F.transform(tokens, lambda t: F.xxhash64(t)), lambda h: F.when(
        F.size(h) >= k,
        F.transform(F.slice(h, k, F.greatest(F.size(h) - k + 1, F.lit(0))),
                    lambda x, i: F.xxhash64(*[F.get(h, i + j) for j in range(k - 1)], x)))
        .otherwise(F.array(F.aggregate(h, F.lit(k).cast("long"), lambda a, x: F.xxhash64(a, x)))))


def _selected(g: Column, w: int) -> Column:
    """Positions of the window minima, ascending."""
    def rightmost(i: Column) -> Column:
        at = [F.get(g, i + j) for j in range(w)]      # beyond the end: null, never least
        def choose(low: Column) -> Column:
            c = F.when(at[w - 1] == low, i + (w - 1))
            for j in range(w - 2, -1, -1):
                c = c.when(at[j] == low, i + j)
            return c
        return let(F.least(*at), choose)

    starts = F.slice(g, 1, F.greatest(F.size(g) - w + 1, F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda _, i: rightmost(i)))


def fingerprint(text: Column, k: int = K, w: int = W) -> Column:
    """struct(positions array<int>, hashes array<bigint>) of a text."""
    return let(_gram_hashes(F.coalesce(text, F.lit("")), k), lambda g: let(
        _selected(g, w), lambda p: F.struct(
            p.alias("positions"), F.transform(p, lambda i: F.get(g, i)).alias("hashes"))))


def as_text(fp: Column) -> Column:
    """``position:hash`` in hexadecimal, joined by spaces."""
    return F.array_join(F.zip_with(fp["positions"], fp["hashes"], lambda p, h: F.concat_ws(
        ":", F.lower(F.hex(p)), F.lower(F.hex(h)))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Share of the selected hashes that both fingerprints have (Jaccard, 0 to 1)."""
    return F.size(F.array_intersect(a, b)).cast("double") / F.size(F.array_union(a, b))


def _below(bounds: np.ndarray, key: Column) -> Column:
    """How many of the ascending ``bounds`` are at most ``key`` (binary search)."""
    if not len(bounds):
        return F.lit(0)
    table = F.lit(bounds)
    steps = F.lit(np.array([1 << s for s in range(int(len(bounds)).bit_length() - 1, -1, -1)], dtype=np.int32))
    return F.aggregate(steps, F.lit(0), lambda lo, s: F.when(
        F.get(table, lo + s - 1) <= key, lo + s).otherwise(lo))


def with_next(docs: DataFrame, add: dict[str, Column], n_ranges: int | None = None) -> DataFrame:
    """(doc_id, text, the columns ``add``) of every document, and those of the document
    that follows it in ascending id (after the last: the first) as ``next_...``."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "_k", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long")))
    n = n_ranges or 6 * shuffle_partitions(docs.sparkSession)
    # a bounded summary of the id column: n quantiles, each an id of the table
    cuts = d.agg(F.percentile_approx("_k", F.lit([i / n for i in range(n)]), F.lit(10 * n)).alias("q"),
                 F.min("_k").alias("lo")).first()
    bounds = np.array(sorted(set(cuts["q"] or []) - {cuts["lo"]}), dtype=np.int64)
    last = len(bounds)
    at_bound = (F.col("_b") > 0) & (F.get(F.lit(bounds), F.col("_b") - 1) == F.col("_k")) if last else F.lit(False)
    place = lambda b, halo: F.struct(b.cast("int").alias("range"), F.lit(halo).alias("halo"))
    copies = F.concat(
        F.array(place(F.col("_b"), 0)),
        F.when(at_bound, F.array(place(F.col("_b") - 1, 1))).otherwise(F.array().cast("array<struct<range:int,halo:int>>")),
        F.when(F.col("_k") == F.lit(cuts["lo"]), F.array(place(F.lit(last), 1)))
        .otherwise(F.array().cast("array<struct<range:int,halo:int>>")))
    # rows travel with their text alone; what is added is derived after the shuffle
    dealt = (d.withColumn("_b", _below(bounds, F.col("_k"))).withColumn("_c", F.explode(copies))
             .select("doc_id", "_k", "text", "_c.range", "_c.halo").repartition("range"))
    w = Window.partitionBy("range").orderBy("halo", "_k", "_tie")
    full = dealt.withColumn("_tie", F.xxhash64("text")).withColumns(add)
    return (full.withColumns({f"next_{c}": F.lead(c).over(w) for c in ("text", *add)})
            .filter("halo = 0").select("doc_id", "text", *add, "next_text", *[f"next_{c}" for c in add]))


def compare_edited(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """Fingerprints of every text and of its edited text (the last quarter replaced by the
    beginning of the next document), with their likeness and that to the next document's."""
    d = with_next(docs, {"fp": fingerprint(F.col("text"), k, w)})
    n = F.length("text")
    q = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - q), F.substring("next_text", F.lit(1), q))
    e = d.withColumn("_e", let(edited, lambda t: F.struct(
        F.sha2(t.cast("binary"), 256).alias("sha"), fingerprint(t, k, w).alias("fp"))))
    return e.select(
        "doc_id", n.cast("long").alias("n_chars"), F.col("_e.sha").alias("edited_sha256"),
        as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("_e.fp")).alias("edited_fingerprint"),
        likeness(F.col("fp.hashes"), F.col("_e.fp.hashes")).alias("near_edited"),
        likeness(F.col("fp.hashes"), F.col("next_fp.hashes")).alias("near_next"))
