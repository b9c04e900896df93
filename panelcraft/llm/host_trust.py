"""URL filters: rules first, link-graph propagation between hosts for all other pages.

A rule (host, path beginning) fits its host and all hosts below it; the longest fitting
rule decides a page.  Pages that no rule fits get the verdict of their host:

* host edges are the links of pages to other hosts (absolute and scheme-less references
  in ``href`` and ``src``), weighted by their number, and a weak link each way
  between a host and the one that it is below, if both have pages or are linked;
* trust is a personalised PageRank that starts at hosts in proportion to their pages that a rule
  allows, and follows links; distrust starts at pages that a rule blocks, and follows links
  backwards, as who links to blocked hosts is suspect; the rank of a host that leads nowhere goes
  back to the seeds, so that the ranks of a kind always sum to its seeds;
* a host is blocked if its distrust exceeds its trust and half of what an unlinked host keeps
  whose pages all are blocked.

Ranks count pages, and their rounding and the change at which the rounds end are relative to one page
or to the rank, so neither depends on the size of the table.  Ranks are tables in the shared
folder, written anew each round and deleted when their successor is written; edges of a host
with very many, and the hosts below a very common one, are not dealt to one task.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits no rule, and is
allowed; null html has no links; repeated rows count as pages each; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcraft.llm.common import keyed_join
from panelcraft.session import dropped, written

#: (host, path beginning, verdict)
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
DAMPING, ROUNDS, TOLERANCE = 0.85, 30, 1e-6
KIN = 0.1                   # weight of the link between a host and the one it is below
NEUTRAL = 0.5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest fitting rule, of equally long ones the first in the alphabet."""
    out = F.lit(None).cast("string"), F.lit(None).cast("string")
    if not rules:
        return out
    rule = verdict = None
    for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    return rule, verdict


def page_rules(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``pages`` with host, path, rule and the rule's verdict (null: no rule fits)."""
    d = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return d.select("*", rule.alias("rule"), verdict.alias("rule_verdict"))


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, w): links between different hosts, with their number."""
    quoted = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(
        r"""(?i)\b(?:href|src)\s*=\s*["']?\s*((?:[a-z][a-z0-9+.\-]*:)?//[^\s"'<>]*)"""), F.lit(1))
    links = pages.select(host_of(F.col("url")).alias("src"), F.explode(quoted).alias("_to"))
    full = F.when(F.col("_to").startswith("//"), F.concat(F.lit("x:"), F.col("_to"))).otherwise(F.col("_to"))
    out = links.select("src", host_of(full).alias("dst"))
    return (out.filter((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
            .groupBy("src", "dst").agg(F.count("*").cast("double").alias("w")))


def _graph(links: DataFrame, hosts: DataFrame) -> DataFrame:
    """(src, dst, share): where a host's rank goes, links and kin together, once for each direction."""
    names = written(hosts.select("host").union(links.select("dst")).distinct(), "host-names")
    below = names.select("host", F.regexp_replace("host", r"^[^.]*\.?", "").alias("above"))
    # how many hosts are below each one that is there: one row for a host, whatever its size
    sizes = below.groupBy("above").agg(F.count("*").alias("n")).join(names.select(F.col("host").alias("above")), "above")
    kin = keyed_join(below, written(sizes, "host-families"), "above", names.count())
    ways = kin.select(F.col("host").alias("src"), F.col("above").alias("dst")).union(
        kin.select(F.col("above").alias("src"), F.col("host").alias("dst"))).withColumn("w", F.lit(KIN))
    edges = links.unionByName(ways).groupBy("src", "dst").agg(F.sum("w").alias("w"))
    return edges.select(F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), "src", "dst", "w"),
        F.struct(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))).alias("e")).select("e.*")


def propagate(seeds: DataFrame, edges: DataFrame, rounds: int = ROUNDS,
              damping: float = DAMPING) -> tuple[DataFrame, dict[str, float]]:
    """(key, rank) from ``seeds`` (key, seed) along ``edges`` (kind, src, dst, w), key: (kind, host), and
    for each kind the part of its seed that a host without any edge keeps.

    Rank at a host without outgoing edges returns to the seeds of its kind, in proportion to them."""
    e = written(edges.select(F.struct("kind", F.col("src").alias("host")).alias("key"),
                             F.struct("kind", F.col("dst").alias("host")).alias("to"), "w"), "host-edges")
    out = written(e.groupBy("key").agg(F.sum("w").alias("out"), F.count("*").alias("n")), "host-out")
    total, start = e.count(), written(seeds, "host-seeds")
    whole = {r["kind"]: r["s"] for r in start.groupBy("key.kind").agg(F.sum("seed").alias("s")).collect()}
    leads = out.select("key", F.lit(True).alias("leads"))

    def stuck(rank: DataFrame, old: DataFrame | None = None) -> tuple[dict[str, float], float]:
        """Rank of each kind at hosts that lead nowhere, and the largest relative change."""
        d = rank.join(leads, "key", "left")
        before = F.lit(0.0)
        if old is not None:
            d = d.join(old.withColumnRenamed("rank", "old"), "key", "left")
            before = F.coalesce("old", F.lit(0.0))
        rows = d.groupBy("key.kind").agg(             # one row a kind
            F.sum(F.when(F.col("leads").isNull(), F.col("rank")).otherwise(0.0)).alias("stuck"),
            F.max(F.abs(F.col("rank") - before) / F.greatest(F.col("rank"), F.lit(1.0))).alias("change")).collect()
        return {r["kind"]: r["stuck"] for r in rows}, max((r["change"] for r in rows), default=0.0)

    rank = start.withColumnRenamed("seed", "rank")
    kept, (held, _) = dict.fromkeys(whole, 1.0), stuck(rank)
    for number in range(rounds):
        kept = {k: 1 - damping + damping * held.get(k, 0.0) / w if w else 1.0 for k, w in whole.items()}
        part = F.coalesce(*[F.when(F.col("key.kind") == k, F.lit(v)) for k, v in kept.items()], F.lit(0.0))
        given = rank.join(out, "key").select("key", (F.col("rank") / F.col("out")).alias("part"), "n")
        moved = (keyed_join(e, given, "key", total).groupBy(F.col("to").alias("key"))
                 .agg(F.sum(F.col("part") * F.col("w")).alias("moved")))
        new = written(start.join(moved, "key", "full").select("key", F.round(
            part * F.coalesce("seed", F.lit(0.0)) + damping * F.coalesce("moved", F.lit(0.0)), 12).alias("rank")), "host-rank")
        held, change = stuck(new, rank)               # who has rank once has some in all later rounds
        if number:
            dropped(rank)
        rank = new
        if change < TOLERANCE:
            break
    return rank, kept


def host_verdicts(pages: DataFrame, ruled: DataFrame) -> DataFrame:
    """(host, trust, distrust, host_verdict) of every host with pages."""
    hosts = written(ruled.filter("host <> ''").groupBy("host").agg(
        F.count("*").cast("double").alias("pages"),
        F.count_if(F.col("rule_verdict") == "allow").alias("allowed"),
        F.count_if(F.col("rule_verdict") == "block").alias("blocked")), "hosts")
    pages_total = F.lit(max(hosts.agg(F.sum("pages")).first()[0] or 0.0, 1.0))
    seed = lambda c: F.col(c).cast("double").alias("seed")
    seeds = hosts.select(F.explode(F.array(
        F.struct(F.struct(F.lit("trust").alias("kind"), "host").alias("key"), seed("allowed")),
        F.struct(F.struct(F.lit("distrust").alias("kind"), "host").alias("key"), seed("blocked")))).alias("s")).select("s.*")
    rank, kept = propagate(seeds, _graph(written(host_edges(pages), "host-links"), hosts))
    wide = rank.groupBy("key.host").agg(
        F.sum(F.when(F.col("key.kind") == "trust", F.col("rank"))).alias("trust"),
        F.sum(F.when(F.col("key.kind") == "distrust", F.col("rank"))).alias("distrust"))
    trust, distrust = (F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust"))
    limit = trust + F.lit(NEUTRAL * kept.get("distrust", 1.0)) * F.col("pages")
    return hosts.join(wide, "host", "left").select(
        "host", (trust / pages_total).alias("trust"), (distrust / pages_total).alias("distrust"), F.col("pages").cast("long").alias("n"),
        F.when(distrust > limit, "block").otherwise("allow").alias("host_verdict"))


def verdicts(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every page."""
    p = pages.select("page_id", "url", "html")
    ruled = page_rules(p, RULES if rules is None else rules)
    hosts = written(host_verdicts(p, ruled), "host-verdicts")
    named = ruled.filter("host <> ''")
    judged = keyed_join(named, hosts, "host", named.count())
    none = ruled.filter("host = ''").select("*", F.lit(0.0).alias("trust"), F.lit(0.0).alias("distrust"), F.lit("allow").alias("host_verdict"))
    return judged.unionByName(none).select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", "host_verdict").alias("verdict"), "trust", "distrust")
