"""Merkle manifest of a dataset: a tree of digests for each group of rows, and one over the groups.

Every row is a leaf: the digest of its fields, each written with its length.  The leaves of a
group stand in a given order; while a level has several nodes, every run of ``arity`` consecutive
ones (the last may be shorter) becomes one node of the next.  The groups' roots, in the order of
their groups, are the leaves of the tree above, whose last node is the root of the dataset.

A level is one equijoin of its nodes with the sibling positions computed from each node's own
(exclusive or for runs of two, offsets of the slot otherwise); the rows of slot zero then have
their whole run and emit the parents.  Positions are part of every join key, so a group that
holds most rows is spread like any other.  Texts are read once and never shuffled; a level has
``arity`` times fewer rows than the one below it and is written before the next is made.
From the top down, each node joins its parent's path, so a row ends with the siblings of all levels.

Defined cases: a null field is ``-``, so it differs from an empty one; rows with a null group form
the first group; rows with a null key come first; rows with equal keys stand in the order of
their digests, and equal rows are leaves of their own; a group of one row has its leaf as its
root; an empty table has no rows (and no root); columns that are no fields don't matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcraft.operators.ordered import ordered_row_number
from panelcraft.session import written

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(fields: Sequence[Column]) -> Column:
    """Lowercase hex digest of the fields: ``-`` for null, else bytes, ``:`` and the value."""
    def one(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*[one(c) for c in fields]), 256)


def _hex(d: Column) -> Column:
    return F.lower(F.hex(d))


def _joined(digests: Column) -> Column:
    return F.array_join(F.transform(digests, _hex), "")


def leaves(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "source", key: str = "doc_id",
           changed: dict[str, Column] | None = None) -> DataFrame:
    """(key, tree, digest, seen): a row's digest, and the digest with the ``changed`` fields, if any
    (else null).  ``tree`` names the group, null before all others."""
    other = digest([(changed or {}).get(f, F.col(f)) for f in fields]) if changed else F.lit(None).cast("string")
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    return docs.select(F.col(key).alias("key"), tree.alias("tree"),
                       F.unhex(digest([F.col(f) for f in fields])).alias("digest"), F.unhex(other).alias("seen"))


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes (tree, pos, n, digest, ...) with the digests of their run before (``left``) and after
    them (``right``)."""
    pos, slot = F.col("pos"), F.col("pos") % arity
    wanted = (F.array(pos.bitwiseXOR(F.lit(1).cast("long"))) if arity == 2 else
              F.transform(F.sequence(F.lit(1), F.lit(arity - 1)), lambda k: pos - slot + (slot + k) % arity))
    asks = nodes.select("tree", "pos", F.explode(F.filter(wanted, lambda p: p < F.col("n"))).alias("at"))
    found = asks.join(nodes.select("tree", F.col("pos").alias("at"), "digest"), ["tree", "at"])
    run = found.groupBy("tree", "pos").agg(F.sort_array(F.collect_list(F.struct("at", "digest"))).alias("run"))
    side = lambda f: F.transform(F.filter(F.coalesce("run", F.array()), f), lambda x: x["digest"])
    return (nodes.join(run, ["tree", "pos"], "left")
            .select(*nodes.columns, side(lambda x: x["at"] < pos).alias("left"), side(lambda x: x["at"] > pos).alias("right")))


def _parents(level: DataFrame, arity: int) -> DataFrame:
    whole = F.sha2(F.concat(_hex(F.col("digest")), _joined(F.col("right"))), 256)
    return level.filter(F.col("pos") % arity == 0).select(
        "tree", F.floor(F.col("pos") / arity).alias("pos"), F.ceil(F.col("n") / arity).alias("n"), F.unhex(whole).alias("digest"))


def build(nodes: DataFrame, arity: int) -> tuple[list[DataFrame], DataFrame]:
    """All levels of several nodes, each written, with siblings; and the root (tree, digest) of each tree."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels, roots = [], nodes.filter("n = 1").select("tree", "digest")
    while most > 1:
        levels.append(written(with_siblings(nodes.filter("n > 1"), arity), "merkle-level"))
        nodes = _parents(levels[-1], arity)
        roots = roots.unionByName(nodes.filter("n = 1").select("tree", "digest"))
        most = -(-most // arity)
    return levels, written(roots, "merkle-roots")


def paths(leaf_nodes: DataFrame, levels: list[DataFrame], roots: DataFrame, arity: int) -> DataFrame:
    """``leaf_nodes`` with ``path``: the siblings (left, right) of all levels up to the tree's root, then
    those that ``roots`` (tree, path, ...) has for that root; its other columns come along."""
    more = [c for c in roots.columns if c not in ("tree", "path")]
    own = F.array(F.struct("left", "right"))

    def climbed(frame: DataFrame, above: DataFrame | None, keep: list[str]) -> DataFrame:
        top = frame.filter(F.col("n") <= arity).join(roots, "tree")
        out = top.select(*keep, F.concat(own, "path").alias("path"), *more)
        if above is None:
            return out
        rest = frame.filter(F.col("n") > arity).withColumn("up", F.floor(F.col("pos") / arity))
        up = above.select("tree", F.col("pos").alias("up"), "path", *more)
        return out.unionByName(rest.join(up, ["tree", "up"]).select(*keep, F.concat(own, "path").alias("path"), *more))

    alone = leaf_nodes.filter("n = 1").join(roots, "tree").select(*leaf_nodes.columns, "path", *more)
    above = None
    for level in reversed(levels[1:]):
        above = climbed(level, above, ["tree", "pos"])
    return alone.unionByName(climbed(levels[0], above, leaf_nodes.columns)) if levels else alone


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "source", key: str = "doc_id",
             changed: dict[str, Column] | None = None, arity: int = ARITY) -> DataFrame:
    """A row for each row of ``docs``: its key, tree, position, digest, the digest seen (``changed``), the
    path of siblings up to the root, its group's root and the root."""
    rows = written(leaves(docs, fields, group, key, changed), "merkle-leaves")
    nodes = written(ordered_row_number(rows, ["key", "digest"], ["tree"], "rn", "n")
                    .select("key", "tree", (F.col("rn") - 1).alias("pos"), "n", "digest", "seen"), "merkle-nodes")
    levels, roots = build(nodes, arity)
    tops = written(ordered_row_number(roots, ["tree"], (), "rn", "n").select(
        F.col("tree").alias("group"), F.lit("").alias("tree"), (F.col("rn") - 1).alias("pos"), "n", "digest"), "merkle-tops")
    top_levels, top = build(tops, arity)
    end = top.select("tree", F.array().cast("array<struct<left:array<binary>,right:array<binary>>>").alias("path"),
                     F.col("digest").alias("root"))
    groups = paths(tops, top_levels, end, arity).select(
        F.col("group").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
    return paths(nodes, levels, written(groups, "merkle-groups"), arity)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf (lowercase hex) and its path give."""
    return F.aggregate(path, leaf, lambda d, x: F.sha2(F.concat(_joined(x["left"]), d, _joined(x["right"])), 256))


def verified(docs: DataFrame, changed: dict[str, Column] | None = None, **how) -> DataFrame:
    """Digests in hex, the digest of the proof, and whether the row as seen still folds to the root."""
    m = manifest(docs, changed=changed, **how)
    proof = F.sha2(F.array_join(F.transform("path", lambda x: F.concat(_joined(x["left"]), _joined(x["right"]))), ""), 256)
    out = m.select("key", *[_hex(F.col(c)).alias(c) for c in ("subroot", "root")], _hex(F.col("digest")).alias("leaf"),
                   proof.alias("proof_sha256"), folded(_hex(F.coalesce("seen", "digest")), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered_text(text: str = "text", key: str = "doc_id", every: int = 5) -> Column:
    """The text, A-Z lower-cased in the rows whose key's crc32 ``every`` divides."""
    hit = F.crc32(F.col(key).cast("string")) % every == 0
    return F.when(hit, F.translate(F.col(text), UPPER, LOWER)).otherwise(F.col(text))


def report(docs: DataFrame) -> DataFrame:
    """Every document's leaf, roots, proof and check, a part of the texts being tampered with."""
    v = verified(docs, {"text": tampered_text()})
    return v.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
