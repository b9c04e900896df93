"""SimHash, its grid join and components against brute force."""

import random
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from panelcraft.llm import simhash_grid as q
from panelcraft.llm.components import components


def fingerprint(text, k=3):
    w = [x for x in (text or "").encode().lower().split()]
    if not w:
        return 0
    s = [b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(fps, bits=2):
    """Least member of each fingerprint's component, by union of all close pairs."""
    parent = {f: f for f in fps}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    fps = sorted(parent)
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                a_, b_ = sorted((top(a), top(b)))
                parent[b_] = a_
    return {f: top(f) for f in fps}


def check(df):
    rows = [(r["doc_id"], fingerprint(r["text"])) for r in df.select("doc_id", "text").collect()]
    group = classes([f for _, f in rows])
    least = {}
    for i, f in rows:
        if i is not None:
            least[group[f]] = min(least.get(group[f], i), i)
    want = Counter((i, f"{f:016x}", least.get(group[f])) for i, f in rows)
    assert Counter(tuple(r) for r in q.near_duplicates(df).collect()) == want
    kept = q.keep_one(df)
    assert kept.columns == df.columns
    assert kept.count() == len(set(group.values()))
    assert {group[fingerprint(r["text"])] for r in kept.collect()} == set(group.values())


def test_documents(docs):
    check(docs)


def test_edge_cases(edge):
    check(edge)


def test_empty_table(empty):
    assert q.near_duplicates(empty).collect() == [] and q.keep_one(empty).collect() == []


def near_points(seed, n=400):
    """Clouds in which fingerprints differ by few bits, and lone ones."""
    rng = random.Random(seed)
    out = set()
    for _ in range(4):
        base = rng.getrandbits(64)
        for _ in range(n // 4):
            out.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))))
    return [x - (1 << 64) if x >> 63 else x for x in out | {rng.getrandbits(64) for _ in range(50)} | {0, (1 << 64) - 1}]


@pytest.mark.parametrize("crowd", [4, 10_000])
@pytest.mark.parametrize("segments", [8, 16])
def test_links_connect_what_all_pairs_connect(spark, crowd, segments):
    points = near_points(crowd + segments)
    df = spark.createDataFrame([(p,) for p in points], "fp long")
    found = [tuple(r) for r in q.links(df, segments=segments, crowd=crowd).collect()]
    m = (1 << 64) - 1
    assert all(((a ^ b) & m).bit_count() <= 2 for a, b in found)
    every = {(a, b) for a in points for b in points if a < b and ((a ^ b) & m).bit_count() <= 2}
    assert set(found) <= every
    if crowd == 10_000:
        assert set(found) == every
    label = {r["node"]: r["label"] for r in components(spark.createDataFrame(found, "a long, b long"), "a", "b").collect()}
    want = classes(p & m for p in points)
    groups = {}
    for p in points:
        groups.setdefault(want[p & m], set()).add(label.get(p, p))
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


def test_no_join_of_cells_is_left_to_a_broadcast(spark, monkeypatch):
    """Cells are 33 or 65 times the fingerprints whose size Spark goes by."""
    plans, kept = [], q.written
    plan = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(q, "written", lambda df, name: (plan(df), kept(df, name))[1])
    found = q.links(spark.createDataFrame([(p,) for p in near_points(5)], "fp long"), crowd=4)
    plan(found)
    assert len(plans) == 2 and all("SortMergeJoin" in p and "Broadcast" not in p for p in plans)
    assert found.count() > 0


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    df = spark.createDataFrame(chain + star + star + [(7, 7), (9, 8)], "a long, b long")
    got = {r["node"]: r["label"] for r in components(df, "a", "b").collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 500 for i in range(500, 560)}, 8: 8, 9: 8}
    assert components(df.limit(0), "a", "b").collect() == []


def test_very_long_text_equals_the_plain_sum():
    text = " ".join(f"w{i % 977}" for i in range(200_000))
    assert q.fingerprint(text) == fingerprint(text)


def test_hash_of_the_engine(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert got & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"a b c", 42)


def test_keyed_join_with_and_without_hot_keys(spark):
    from panelcraft.llm.common import keyed_join
    for hot in (0, 3000):
        big = spark.createDataFrame([(7, i) for i in range(hot)] + [(100 + i % 1500, i) for i in range(3000)], "k long, x long")
        small = big.groupBy("k").agg(F.count("*").alias("n"), (F.max("k") * 2).alias("y")).filter("k <> 105")
        want = Counter((r["k"], r["x"], 2 * r["k"]) for r in big.collect() if r["k"] != 105)
        for heavy in (2, 1024, 10 ** 9):
            got = keyed_join(big, small, "k", 3000 + hot, heavy).select("k", "x", "y")
            assert Counter(tuple(r) for r in got.collect()) == want
