"""Rules and propagation against plain Python."""

import re
from collections import Counter, defaultdict

import pytest

from panelcraft.llm import host_trust as q


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(c.lower() if c.isascii() else c for c in host), path


def rule(host, path):
    fits = [(h + p, v) for h, p, v in q.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return min(fits, key=lambda r: (-len(r[0]), r[0])) if fits else (None, None)


def spread(seeds, edges):
    """Personalised PageRank by the book, on {(src, dst): weight}: (ranks, what a lone seed keeps)."""
    out, whole = defaultdict(float), sum(seeds.values())
    for (a, _), w in edges.items():
        out[a] += w
    rank, kept = dict(seeds), 1.0
    for _ in range(q.ROUNDS):
        new = defaultdict(float)
        stuck = sum(r for h, r in rank.items() if h not in out)
        kept = 1 - q.DAMPING + q.DAMPING * stuck / whole if whole else 1.0
        for h, s in seeds.items():
            new[h] += kept * s
        for (a, b), w in edges.items():
            new[b] += q.DAMPING * rank.get(a, 0.0) * w / out[a]
        new = {h: round(r, 12) for h, r in new.items()}
        change = max((abs(r - rank.get(h, 0.0)) / max(r, 1.0) for h, r in new.items()), default=0.0)
        rank = new
        if change < q.TOLERANCE:
            break
    assert abs(sum(rank.values()) - whole) < 1e-6 * max(whole, 1.0)      # no rank is lost
    return rank, kept


def brute(rows):
    pages = [(i, *parse(u), h or "") for i, u, h in rows]
    judged = [(i, host, path, *rule(host, path)) for i, host, path, _ in pages]
    edges = Counter()
    for _, host, _, html in pages:
        for to in re.findall(r"""(?i)\b(?:href|src)\s*=\s*["']?\s*((?:[a-z][a-z0-9+.\-]*:)?//[^\s"'<>]*)""", html):
            other = parse(to if "://" in to else "x:" + to)[0]
            if host and other and host != other:
                edges[host, other] += 1.0
    names = {h for _, h, *_ in judged if h} | {b for _, b in edges}
    for h in names:
        above = h.partition(".")[2]
        if above in names:
            edges[h, above] += q.KIN
            edges[above, h] += q.KIN
    pages_of = lambda want: Counter(j[1] for j in judged if j[1] and (want is None or j[4] == want))
    size, (trust, _) = pages_of(None), spread(pages_of("allow"), edges)
    distrust, kept = spread(pages_of("block"), {(b, a): w for (a, b), w in edges.items()})
    out = Counter()
    for i, host, path, r, v in judged:
        limit = trust.get(host, 0.0) + q.NEUTRAL * kept * size.get(host, 0)
        out[(i, host, path, r, v or ("block" if host and distrust.get(host, 0.0) > limit else "allow"))] += 1
    return out


def check(df):
    rows = [tuple(r) for r in df.select("page_id", "url", "html").collect()]
    assert Counter(tuple(r)[:5] for r in q.verdicts(df).collect()) == brute(rows)


def test_pages(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))


ODD = [(1, None, None), (2, "no scheme", "x"), (3, "http://", "<a href=//b.net/x>"), (4, "HTTP://WWW.Example.COM/de/1?x#y", ""),
       (5, "a://b://c/d", None), (6, "https://example.net/en/", ""), (7, "https://example.net?en/", ""), (8, "http://xnet/", ""),
       (9, "http://É.org/fr/a", ""), (None, "http://a.org/", None), (1, None, None)]


def test_edge_cases(spark):
    df = spark.createDataFrame([(*r, 1, 2) for r in ODD], "page_id long, url string, html string, host int, n int")
    check(df)
    assert q.verdicts(df.limit(0)).collect() == []


def test_links_carry_trust_and_distrust(spark):
    good = [(i, "http://good.org/fr/a", '<a href="http://liked.com/">') for i in range(10)]
    bad = [(20 + i, "http://bad.example.com/de/a", "") for i in range(10)]
    mixed = [(40, "http://liked.com/x", "<a HREF='//neutral.com/'>"), (41, "http://linker.com/", '<a href="http://bad.example.com/">' * 5),
             (42, "http://neutral.com/", '<img src="http://sub.neutral.com/i.png">'), (43, "http://sub.neutral.com/", "")]
    df = spark.createDataFrame(good + bad + mixed, "page_id long, url string, html string")
    check(df)
    got = {r["host"]: r["verdict"] for r in q.verdicts(df).collect()}
    assert got["linker.com"] == "block" and got["liked.com"] == got["neutral.com"] == "allow"


def test_rank_of_hosts_that_lead_nowhere_returns_to_the_seeds(spark):
    seeds = [(("trust", "a"), 3.0), (("trust", "d"), 1.0), (("distrust", "b"), 2.0)]
    edges = [("trust", "a", "b", 1.0), ("trust", "a", "c", 3.0), ("distrust", "b", "a", 1.0)]
    rank, kept = q.propagate(spark.createDataFrame(seeds, "key struct<kind: string, host: string>, seed double"),
                             spark.createDataFrame(edges, "kind string, src string, dst string, w double"), rounds=60)
    got = {(r["key"]["kind"], r["key"]["host"]): r["rank"] for r in rank.collect()}
    # a keeps x, b and c get .85 x in parts 1 : 3, d keeps x / 3; all four are 4 pages
    x = 4 / (1 + 0.85 + 1 / 3)
    want = {("trust", "a"): x, ("trust", "b"): 0.85 * x / 4, ("trust", "c"): 0.85 * x * 3 / 4, ("trust", "d"): x / 3,
            ("distrust", "b"): 2 / 1.85, ("distrust", "a"): 0.85 * 2 / 1.85}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-4 for k in want)
    assert abs(kept["trust"] - x / 3) < 1e-4 and abs(kept["distrust"] - 1 / 1.85) < 1e-4


def test_one_parent_of_very_many_hosts(spark):
    """Its children are joined with it by broadcast, not dealt to one task; both ways are there."""
    hosts = spark.range(100_000).selectExpr("concat('h', id, '.com') AS host").unionByName(
        spark.createDataFrame([("com",), ("a.b.org",), ("b.org",), ("lone.net",)], "host string"))
    g = q._graph(spark.createDataFrame([], "src string, dst string, w double"), hosts)
    plan = g._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan
    ends = g.groupBy("kind").agg({"src": "count"}).collect()
    assert {tuple(r) for r in ends} == {("trust", 200_002), ("distrust", 200_002)}
    assert g.filter("kind = 'trust' and src = 'com'").count() == 100_000
    assert g.filter("kind = 'trust' and dst = 'b.org'").count() == 1


@pytest.mark.parametrize("url, host, path", [("http://A.b/c?d", "a.b", "/c"), ("x://h#/p", "h", ""), ("x", "", ""), ("x://h", "h", "")])
def test_parts(spark, url, host, path):
    from pyspark.sql import functions as F
    r = spark.range(1).select(q.host_of(F.lit(url)), q.path_of(F.lit(url))).first()
    assert tuple(r) == (host, path) == parse(url)
