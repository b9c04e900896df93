"""Quality rules against plain Python on small tables."""

import math
import re
import struct
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from panelcraft.llm import quality_llr as q

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def counts(text):
    w, lines = words(text), (text or "").split("\n")
    seen, dup = set(), 0
    for x in lines:
        if words(x):
            dup += x in seen
            seen.add(x)
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    inside = {j for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(inside)


def grams(text):
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    h = [signed(xxhash.xxh64_intdigest(w, 42)) for w in words(text)]
    chain = lambda a, b: signed(xxhash.xxh64_intdigest(struct.pack("<q", b), xxhash.xxh64_intdigest(struct.pack("<q", a), 42)))
    return h + [q.ECHO if a == b else chain(a, b) for a, b in zip(h, h[1:])]


def brute(rows, trusted, n):
    raw, target = Counter(), Counter()
    for i, t in rows:
        for g in grams(t):
            raw[g % n] += 1
            target[g % n] += i in trusted
    r, s = sum(raw.values()), sum(target.values())
    return [round((math.log((target[b] + 1) / (s + n)) - math.log((raw[b] + 1) / (r + n))) * 1e6) for b in range(n)]


def check(df, trusted_df, n=512):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    trusted = {r["doc_id"] for r in trusted_df.collect()}
    weights = q.bucket_weights(df, trusted_df, n_buckets=n)
    assert weights.tolist() == brute(rows, trusted, n)
    got = Counter(tuple(r) for r in q.verdicts(df, weights).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score_micronats", "kept").collect())
    want = Counter()
    for i, t in rows:
        c = counts(t)
        base = c[0] < 20 or 100 * c[4] > 30 * c[0]
        score = sum(int(weights[g % n]) for g in grams(t)) // max(2 * c[0] - 1, 1)
        want[(i, *c, base, score, not base and score >= q.THRESHOLD)] += 1
    assert got == want


def test_against_plain_python(docs, labels):
    check(docs, q.trusted_sample(labels))


def test_edge_cases(edge, labels):
    check(edge, q.trusted_sample(labels))


def test_empty_table_and_no_trusted_rows(empty, docs, labels):
    none = q.trusted_sample(labels.limit(0))
    assert not q.bucket_weights(docs, none).any()
    assert not q.bucket_weights(empty, q.trusted_sample(labels)).any()
    assert q.verdicts(empty, q.bucket_weights(empty, none)).collect() == []


def test_keep_passes_own_columns(edge, labels):
    w = q.bucket_weights(edge, q.trusted_sample(labels))
    kept = q.keep(edge, w, threshold=-10 ** 9)
    assert kept.columns == edge.columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {
        r["doc_id"] for r in q.verdicts(edge, w).filter("not base_failed").collect()}


def test_junk_is_rejected_and_clean_kept(docs, labels):
    w = q.bucket_weights(docs, q.trusted_sample(labels))
    v = q.verdicts(docs, w).filter("not base_failed").join(labels.select("doc_id", "quality").distinct(), "doc_id")
    share = {r["quality"]: r["s"] for r in v.groupBy("quality").agg({"kept": "max", "doc_id": "count"}).withColumnRenamed("max(kept)", "s").collect()}
    kept = {r["quality"]: r["n"] for r in v.filter("kept").groupBy("quality").count().withColumnRenamed("count", "n").collect()}
    every = {r["quality"]: r["n"] for r in v.groupBy("quality").count().withColumnRenamed("count", "n").collect()}
    assert share[1] and kept[1] >= 0.97 * every[1]
    assert kept.get(0, 0) <= 0.5 * every[0]


def test_no_python_in_the_plan(docs, labels):
    import numpy as np
    plan = q.verdicts(docs, np.zeros(16, dtype=np.int64))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_sample_is_the_least_hashes(spark):
    from panelcraft.llm.common import hash_sample
    df = spark.range(5000)
    want = [r["id"] for r in df.orderBy(F.xxhash64("id"), "id").limit(700).collect()]
    assert [r["id"] for r in hash_sample(df, "id", 700).collect()] == want
    assert hash_sample(df, "id", 9000).count() == 5000
