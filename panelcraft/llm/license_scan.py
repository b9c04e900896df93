"""License scan: ordered signature rules over the words of a text.

A text's words, in lower case with one blank between two, are searched for the signatures of
``license_rules``: regexes, each with keywords.  A rule's longest keyword is its gate: a text that
has no rule's gate is done; otherwise the rules whose keywords all occur are run.  Each place is an
interval of words.  Intervals are sorted by start, length, priority and rule; a place is suppressed if
an interval before it, of a priority at least as strong, reaches its end, that is, contains it.

Everything is an expression over a text's own row: no text is shuffled, and no rule table is joined.
The work is linear in the text and the places found: starts are marked in the text and read off
its words, and running maxima are taken in blocks.

Defined cases: a null text counts as empty; without words or places the labels are empty strings,
the score is 0 and first and last word are null; repeated rows are scanned row by row; an empty
table gives no rows; other columns of the input don't matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcraft.llm.common import let
from panelcraft.llm.license_rules import RULES, Rule

#: what lies between words, after A-Z is lower-cased
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: confidence that a place of each priority gives
CONFIDENCE = (1.0, 0.95, 0.8, 0.4)
BLOCK = 256
#: put before the first word of a place; never part of a word
SIGN = "\x01"


def lowered_words(text: Column) -> Column:
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(low, BETWEEN), lambda w: w != "")


def gate(rule: Rule) -> str:
    return max(rule.keywords, key=len)


def _strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _table(rules: Sequence[Rule]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"),
                              _strings(r.keywords).alias("keywords"), F.lit(rf"(?<![^ ])(?:{r.regex})(?![^ ])").alias("regex"))
                     for i, r in enumerate(rules)])


def _places(text: Column, r: Column) -> Column:
    """Intervals (start, -end, priority, rule, label) of one rule's matches."""
    marked = F.split(F.regexp_replace(text, r["regex"], F.lit(SIGN + "$0")), " ")
    starts = F.filter(F.transform(marked, lambda w, i: F.when(F.startswith(w, F.lit(SIGN)), i)), lambda i: i.isNotNull())
    lengths = F.transform(F.regexp_extract_all(text, r["regex"], F.lit(0)), lambda m: F.size(F.split(m, " ")))
    found = let(lengths, lambda n: F.transform(starts, lambda s, k: F.struct(
        s.alias("start"), (-(s + F.get(n, k))).alias("minus_end"), r["priority"].alias("priority"),
        r["rule"].alias("rule"), r["label"].alias("label"))))
    return F.when(F.rlike(text, r["regex"]), found)


def running_max(values: Column, block: int = BLOCK) -> Column:
    """For each element the largest before it (null for the first), block by block."""
    n_blocks = F.ceil(F.size(values) / block).cast("int")
    starts = F.when(n_blocks > 0, F.sequence(F.lit(0), n_blocks - 1)).otherwise(F.array().cast("array<int>"))
    blocks = F.transform(starts, lambda b: F.slice(values, b * block + 1, F.lit(block)))
    return let(blocks, lambda bs: let(F.transform(bs, F.array_max), lambda tops: F.flatten(F.transform(bs, lambda v, b: let(
        F.array_max(F.slice(tops, F.lit(1), b)), lambda before: F.transform(
            v, lambda _, j: F.greatest(before, F.array_max(F.slice(v, F.lit(1), j)))))))))


def with_suppression(places: Column) -> Column:
    """Sorted places (start, end, priority, rule, label) with ``kept``."""
    def flagged(ps: Column) -> Column:
        reach = F.array(*[running_max(F.transform(ps, lambda d: F.when(d["priority"] <= p, -d["minus_end"])))
                          for p in range(len(CONFIDENCE))])
        return let(reach, lambda m: F.transform(ps, lambda d, j: F.struct(
            d["start"].alias("start"), (-d["minus_end"]).alias("end"), d["priority"].alias("priority"),
            d["rule"].alias("rule"), d["label"].alias("label"),
            F.coalesce(F.get(F.get(m, d["priority"]), j) < -d["minus_end"], F.lit(True)).alias("kept"))))
    return let(F.sort_array(places), flagged)


def places(words: Column, rules: Sequence[Rule] = RULES) -> Column:
    """All places of the rules in a text's words, null where there is none."""
    gates, keywords = sorted({gate(r) for r in rules}), sorted({k for r in rules for k in r.keywords})
    table = _table(rules)

    def run(text: Column) -> Column:
        having = let(F.array_intersect(words, _strings(keywords)), lambda present: F.filter(
            table, lambda r: F.size(F.array_except(r["keywords"], present)) == 0))
        found = F.flatten(F.filter(F.transform(having, lambda r: _places(text, r)), lambda x: x.isNotNull()))
        return let(found, lambda f: F.when(F.size(f) > 0, with_suppression(f)))

    return F.when(F.arrays_overlap(words, _strings(gates)), let(F.array_join(words, " "), run))


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, places): the number of words, and every place with its interval, label and verdict."""
    found = let(lowered_words(F.col(text)), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), places(w, rules).alias("places")))
    return docs.select(F.col(key), found.alias("_found")).select(key, "_found.n_words", "_found.places")


def detections(docs: DataFrame, rules: Sequence[Rule] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each kept place: key, label, priority, rule number, first word, word after the last."""
    return (scan(docs, rules, key, text).select(key, F.explode("places").alias("p")).filter("p.kept")
            .select(key, "p.label", "p.priority", "p.rule", F.col("p.start").cast("long").alias("start"),
                    F.col("p.end").cast("long").alias("end")))


def report(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per document: its words, the places of the fixed phrases, labels and score (the confidence
    of the strongest place)."""
    listed = lambda a: F.array_join(F.sort_array(F.array_distinct(a)), ",")
    labels = lambda f: F.transform(F.filter("places", f), lambda p: p["label"])
    fixed = lambda p: p["priority"] == 0
    starts = F.transform(F.filter("places", fixed), lambda p: p["start"].cast("long"))
    confidence = F.transform(F.filter("places", lambda p: p["kept"]), lambda p: F.get(F.array(*map(F.lit, CONFIDENCE)), p["priority"]))
    return scan(docs, rules).withColumn("places", F.coalesce("places", F.filter(F.array(F.struct(
        F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit(0).alias("priority"), F.lit(0).alias("rule"),
        F.lit("").alias("label"), F.lit(False).alias("kept"))), lambda _: F.lit(False)))).select(
        "doc_id", "n_words", F.size(starts).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), listed(labels(fixed)).alias("base_labels"),
        listed(labels(lambda p: p["kept"] | fixed(p))).alias("labels"),
        F.coalesce(F.array_max(confidence), F.lit(0.0)).alias("score"),
        F.size(F.filter("places", lambda p: p["kept"])).cast("long").alias("n_kept"))
