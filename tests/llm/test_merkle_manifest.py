"""Merkle manifest against plain Python."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from panelcraft.llm import merkle_manifest as q


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, text):
    values = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(digests, arity):
    """(root, the siblings before and after each leaf by level)."""
    levels = [digests]
    while len(levels[-1]) > 1:
        d = levels[-1]
        levels.append([H(*d[i:i + arity]) for i in range(0, len(d), arity)])
    def path(i):
        out = []
        for d in levels[:-1]:
            a = i // arity * arity
            out.append((d[a:i], d[i + 1:a + arity]))
            i //= arity
        return out
    return levels[-1][0], [path(i) for i in range(len(digests))]


def brute(rows, arity=16):
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    groups = {}
    for r in rows:
        t = r["text"]
        hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and t is not None
        groups.setdefault(r["source"], []).append(
            ((r["doc_id"] is not None, r["doc_id"] or 0), leaf_of(r, t), leaf_of(r, low(t) if hit else t), r["doc_id"]))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for s in names:
        groups[s].sort(key=lambda x: x[:2])
        built[s] = tree([x[1] for x in groups[s]], arity)
    root, tops = tree([built[s][0] for s in names], arity) if names else (None, [])
    out = Counter()
    for s, top in zip(names, tops, strict=True):
        sub, own = built[s]
        for (_, leaf, seen, doc_id), p in zip(groups[s], own, strict=True):
            d = seen
            for a, b in p + top:
                d = H(*a, d, *b)
            out[doc_id, leaf, sub, root, H(*[x for a, b in p + top for x in a + b]), d, d == root] += 1
    return out


COLUMNS = "doc_id long, text string, source string, lang string, n_chars long"


def rows_of(spark, n, sources, **more):
    rows = [(i * 7 % n, None if i % 11 == 3 else f"Text Number {i}" if i % 3 else "plain", sources[i % len(sources)], "en" if i % 2 else None, i)
            for i in range(n)]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.mark.parametrize("n,sources", [(1, ["a"]), (16, ["a"]), (17, ["a"]), (300, ["hot", "hot", "hot", None, "", "b"]), (60, [f"s{i}" for i in range(40)])])
def test_against_plain_python(spark, n, sources):
    df = rows_of(spark, n, sources)
    got = Counter(tuple(r) for r in q.report(df).collect())
    assert got == brute(df.collect())
    assert sum(got.values()) == n


@pytest.mark.parametrize("arity", [2, 3])
def test_other_runs(spark, arity):
    df = rows_of(spark, 45, ["a", "b", "a", "c", "a"])
    got = q.verified(df, arity=arity)
    want = brute(df.collect(), arity)
    assert {(r["key"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"]) for r in got.collect()} == {k[:5] for k in want}
    assert got.filter("not verified").count() == 0                        # nothing was changed


def test_cases(spark, edge, empty):
    more = [F.lit("s").alias("source"), F.lit(None).cast("string").alias("lang"), F.lit(1).cast("long").alias("n_chars")]
    clash = [F.lit(1).alias(c) for c in ("tree", "digest", "path", "root", "pos")]
    df = edge.select("*", *more, *clash)
    df = df.unionByName(df.filter("doc_id = 6"))                          # repeated rows
    assert Counter(tuple(r) for r in q.report(df).collect()) == brute(df.collect())
    assert q.report(empty.select("*", *more)).collect() == []


def test_only_changed_texts_fail(spark, docs):
    got = q.report(docs).join(docs.select("doc_id", "text"), "doc_id")
    changed = (F.crc32(F.col("doc_id").cast("string")) % 5 == 0) & F.col("text").rlike("[A-Z]")
    assert got.filter(F.col("verified") == changed).count() == 0
    assert 0 < got.filter("verified").count() < got.count()


def test_a_node_reads_its_siblings_by_position(spark):
    nodes = spark.createDataFrame([("t", i, 5, bytes([i])) for i in range(5)], "tree string, pos long, n long, digest binary")
    got = {r["pos"]: ([x[0] for x in r["left"]], [x[0] for x in r["right"]]) for r in q.with_siblings(nodes, 4).collect()}
    assert got == {0: ([], [1, 2, 3]), 1: ([0], [2, 3]), 2: ([0, 1], [3]), 3: ([0, 1, 2], []), 4: ([], [])}
    two = {r["pos"]: ([x[0] for x in r["left"]], [x[0] for x in r["right"]]) for r in q.with_siblings(nodes, 2).collect()}
    assert two == {0: ([], [1]), 1: ([0], []), 2: ([], [3]), 3: ([2], []), 4: ([], [])}
