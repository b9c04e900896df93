"""Winnowing against plain Python."""

import hashlib
import re
import struct
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from panelcraft.llm import winnowing as q


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chain(hashes, seed=42):
    for h in hashes:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", h), seed)
    return signed(seed)


def brute(text, k=q.K, w=q.W):
    tokens = re.findall(rf"[^\x20\x09-\x0D]{{1,{q.TOKEN_CHARS}}}", text or "")
    h = [signed(xxhash.xxh64_intdigest(t, 42)) for t in tokens]
    if len(h) >= k:
        g = [chain(h[i:i + k]) for i in range(len(h) - k + 1)]
    else:
        a = k
        for x in h:
            a = chain([a, x])
        g = [a]
    picked = {}
    for i in range(max(len(g) - w + 1, 1)):
        window = g[i:i + w]
        p = max(j for j, x in enumerate(window) if x == min(window)) + i
        picked[p] = g[p]
    return picked


def near(a, b):
    a, b = set(a.values()), set(b.values())
    return len(a & b) / len(a | b)


def check(df):
    key = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, signed(xxhash.xxh64_intdigest(r["text"] or "", 42)))
    rows = sorted(df.collect(), key=key)
    got = Counter(tuple(r) for r in q.compare_edited(df).collect())
    want = Counter()
    for i, r in enumerate(rows):
        text, nxt = r["text"] or "", rows[(i + 1) % len(rows)]["text"] or ""
        n = len(text) // 4
        edited = text[:len(text) - n] + nxt[:n]
        a, b, c = brute(text), brute(edited), brute(nxt)
        show = lambda f: " ".join(f"{p:x}:{x & (1 << 64) - 1:x}" for p, x in f.items())
        want[(r["doc_id"], len(text), hashlib.sha256(edited.encode()).hexdigest(), show(a), show(b), near(a, b), near(a, c))] += 1
    assert got == want


def test_against_plain_python(docs):
    check(docs)


@pytest.mark.parametrize("ranges", [1, 7])
def test_number_of_ranges_does_not_matter(docs, ranges):
    cols = ["doc_id", "next_text"]
    a = q.with_next(docs, {"x": F.lit(1)}, ranges).select(cols).collect()
    ids = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    want = {i: ids[(k + 1) % len(ids)][1] for k, (i, _) in enumerate(ids)}
    assert {r["doc_id"]: r["next_text"] for r in a} == want


def test_edge_cases(edge):
    check(edge)


def test_empty_table_and_single_document(empty, edge):
    assert q.compare_edited(empty).collect() == []
    one = q.compare_edited(edge.filter("doc_id = 8")).first()
    assert one["near_next"] == 1.0


def test_match_guarantee(spark):
    shared = " ".join(f"s{i}" for i in range(q.K + q.W - 1))
    d = spark.createDataFrame([(1, f"a1 a2 a3 {shared} a4 a5 a6 a7"), (2, f"b9 {shared} b8")], "doc_id long, text string")
    a, b = (set(r["fp"]["hashes"]) for r in d.select(q.fingerprint(F.col("text")).alias("fp")).collect())
    assert a & b
