"""SimHash near-duplicates by a grid range join of segment popcounts.

A document's fingerprint sums the signs of the bits of its word shingles' XXH64 (bit set: in
over half of them).  Fingerprints link at ``max_bits`` differing bits or fewer.

Each distinct fingerprint is embedded as its bit counts in ``SEGMENTS`` segments.  Differing bits
change these counts by at least their Manhattan distance, so a link's two points are within
``max_bits`` there.  Every point is put into all unit cells of the grid within half that
radius; two points within the radius meet in a cell halfway.  Pairs that meet are verified
exactly.  A cell with more than ``CROWD`` points would give too many pairs: its points go on to
the finest grid, of 64 segments of one bit, where the Manhattan distance is the number of
differing bits.  There all points of a cell are at most ``max_bits`` apart (for an even
``max_bits``), and a link of each to the cell's least fingerprint stands for all pairs.

Components come from label propagation over these links: see ``components``.

Defined cases: a text with fewer words than a shingle has one, of all its words; null, empty
and blank texts have the fingerprint zero, and link like any other; equal texts have equal
fingerprints; rows of one id are documents of their own with that id; a null id is a
component's id only if no other member has one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcraft.llm.common import keyed_join
from panelcraft.llm.components import components
from panelcraft.llm.memo import begin
from panelcraft.session import written

SHINGLE, MAX_BITS, SEED = 3, 2, 42
SEGMENTS, CROWD = 16, 24
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a text, repeats included."""
    words = text.encode().lower().split() if text else []     # bytes: A-Z and ASCII white space alone
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    whole, digest = b" ".join(words), xxhash.xxh64_intdigest
    starts = [0, *ends[:len(words) - shingle]]
    total, n = np.zeros(64, dtype=np.int64), len(starts)
    for a in range(0, n, _CHUNK):
        h = np.array([digest(whole[i:j - 1], SEED) for i, j in
                      zip(starts[a:a + _CHUNK], ends[shingle - 1 + a:shingle - 1 + a + _CHUNK], strict=True)], dtype="<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, t, fp): a hash of the text, the fingerprint's bits as a signed 64-bit integer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("simhash")
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fps.view(np.int64))],
                                             names=["doc_id", "t", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text", F.hash("text").alias("t")).mapInArrow(
        run, "doc_id long, t int, fp long")


def _segment_counts(fp: np.ndarray, segments: int) -> np.ndarray:
    bits = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.reshape(len(fp), segments, 64 // segments).sum(axis=2, dtype=np.int64)


def _moves(segments: int, radius: int) -> np.ndarray:
    """All integer steps of a Manhattan length of at most ``radius``."""
    steps = {(0,) * segments}
    for _ in range(radius):
        steps |= {s[:i] + (s[i] + d,) + s[i + 1:] for s in steps for i in range(segments) for d in (-1, 1)}
    return np.array(sorted(s for s in steps if sum(map(abs, s)) <= radius), dtype=np.int64)


def cells(points: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """(cell, fp): every fingerprint in all cells within half the range of its counts."""
    width = 64 // segments
    moves = _moves(segments, -(-max_bits // 2))
    weights = np.array([(width + 1) ** i for i in range(segments)], dtype=np.int64)
    if (width + 1) ** segments >= 1 << 63:
        raise ValueError("a cell's number must fit into 63 bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy()
            at = _segment_counts(fp.copy(), segments)[:, None, :] + moves
            inside = ((at >= 0) & (at <= width)).all(axis=2)
            number = at @ weights
            yield pa.RecordBatch.from_arrays([pa.array(number[inside]), pa.array(np.repeat(fp, inside.sum(axis=1)))],
                                             names=["cell", "fp"])

    return points.select("fp").mapInArrow(run, "cell long, fp long")


def _flips(fp: Column, radius: int) -> Column:
    """A fingerprint and all with at most ``radius`` other bits: its cells in the finest grid."""
    masks = [sum(1 << b for b in c) for k in range(radius + 1) for c in combinations(range(64), k)]
    table = F.lit(np.array(masks, dtype=np.uint64).view(np.int64))
    return F.transform(table, lambda m: fp.bitwiseXOR(m))


def links(points: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS, crowd: int = CROWD) -> DataFrame:
    """(a, b), a < b: fingerprints at ``max_bits`` or fewer differing bits; all such pairs, or,
    in crowds, enough of them to connect all.  ``points``: distinct ``fp``."""
    if max_bits % 2:
        raise ValueError("an even range: cells lie halfway")
    # Spark takes a step from one row to many (cells, flips) for one row to one, and written tables by their compressed
    # size: it would broadcast what is many times its limit, so none of these joins is left to its choice
    placed = cells(points, max_bits, segments)
    size = placed.groupBy("cell").agg(F.count("*").alias("n"))
    # of most cells nothing is left: they hold one fingerprint
    shared = written(placed.join(size.filter("n > 1").hint("merge"), "cell"), "simhash-cells")
    near = shared.filter(F.col("n") <= crowd)
    differ = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b)))
    pairs = (near.select("cell", F.col("fp").alias("a")).join(near.select("cell", F.col("fp").alias("b")).hint("merge"), "cell")
             .filter((F.col("a") < F.col("b")) & (differ("a", "b") <= max_bits)).select("a", "b"))
    fine = (shared.filter(F.col("n") > crowd).select("fp").distinct()
            .select("fp", F.explode(_flips(F.col("fp"), max_bits // 2)).alias("cell")))
    least = fine.groupBy("cell").agg(F.min("fp").alias("a"), F.max("fp").alias("_high")).filter("a < _high")
    stars = (fine.join(least.select("cell", "a").hint("merge"), "cell").filter(F.col("a") < F.col("fp"))
             .select("a", F.col("fp").alias("b")))
    return pairs.unionAll(stars).distinct()


def _grouped(docs: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """(doc_id, t, fp, grp, component_id): ``grp`` is a fingerprint that all of a component share."""
    marked = written(fingerprints(docs, shingle), "simhash")       # points, counts and the result
    points = marked.groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    edges = links(points.select("fp"), max_bits)
    label = components(edges, "a", "b")                            # (node, label): linked ones alone
    named = points.join(label, points["fp"] == label["node"])
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    linked = named.select("fp", "label").join(least, "label")
    by_fp = written(points.join(linked, "fp", "left").select(
        "fp", "n", F.coalesce("label", "fp").alias("grp"),
        F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")), "simhash-classes")
    # many documents of one text share a fingerprint
    return keyed_join(marked, by_fp, "fp", marked.count())


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document."""
    return _grouped(docs, shingle, max_bits).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group of near-duplicates: that of the smallest (id, hash of the text)."""
    place = F.struct("doc_id", "t")
    found = written(_grouped(docs, shingle, max_bits).select(place.alias("_place"), "grp"), "simhash-groups")
    groups = found.groupBy("grp").agg(F.min("_place").alias("_first"), F.count("*").alias("n")).filter("n > 1")
    member = keyed_join(found, groups, "grp", found.count())
    # of the documents in groups: the one that stays, if it is there more than once, and all others
    flag = (member.groupBy("_place").agg(F.max(F.col("_place").eqNullSafe(F.col("_first"))).alias("_stays"), F.count("*").alias("_n"))
            .filter("not _stays or _n > 1"))
    key = F.struct(docs["doc_id"].cast("long").alias("doc_id"), F.hash(docs["text"]).alias("t"))
    met = docs.join(flag, key.eqNullSafe(flag["_place"]), "left")
    own = [docs[c] for c in docs.columns]
    once = met.filter(flag["_stays"]).dropDuplicates(["_place"])
    return met.filter(flag["_place"].isNull()).select(*own).unionByName(once.select(*own))
