"""Quality rules: a hashed n-gram log-likelihood ratio between two corpora.

Two multinomials over ``n_buckets`` hashed buckets of word unigrams and bigrams are
(a word after itself is one feature, whatever the word) are counted: the *raw* one over
every document, the *target* one over trusted documents (a bounded,
hash-ordered sample of the rows labelled good).  A document's score is the
mean over its n-grams of log p_target(bucket) - log p_raw(bucket); documents below a
fixed threshold are rejected, whatever else is in the table.  Bucket weights are rounded
to integers (millionths of a nat), so that sums and verdicts don't depend on the order
of addition.

Everything per document is a higher-order-function expression over its own row: texts
are never shuffled.  Only bucket counts are, after map-side aggregation.

Defined cases: null, empty and blank texts have no words and fail the base rules; a text
with one word has one n-gram; repeated rows are judged row by row; an empty table (or no
trusted row) gives weight 0 to every bucket, so only the base rules decide; further
columns of the input are left alone.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcraft.llm.common import hash_sample, let, words

N_BUCKETS = 8192
TRUSTED_ROWS = 20_000
#: mean log-likelihood ratio below which a document is rejected, in millionths of a nat
THRESHOLD = -60_000
SMOOTHING = 1.0
WINDOW = 8
SYMBOLS = r"[^#*$%&|<>]+"


#: feature of a word that follows itself, the same for every word
ECHO = 1


def _pairs(wh: Column) -> Column:
    return F.transform(F.slice(wh, 2, F.greatest(F.size(wh) - 1, F.lit(0))),
                       lambda h, i: F.when(F.get(wh, i) == h, F.lit(ECHO).cast("long"))
                       .otherwise(F.xxhash64(F.get(wh, i), h)))


def ngram_hashes(word_hashes: Column) -> Column:
    """Hashes of all unigrams and bigrams."""
    return F.concat(word_hashes, _pairs(word_hashes))


def _word_hashes(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def _repeat_words(wh: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that occur twice or more in the text."""
    grams = F.when(F.size(wh) >= WINDOW,
                   F.transform(F.slice(wh, WINDOW, F.greatest(F.size(wh) - WINDOW + 1, F.lit(0))),
                               lambda _, i: F.xxhash64(*[F.get(wh, i + k) for k in range(WINDOW)])))

    def covered(g: Column) -> Column:
        def starts(s: Column) -> Column:
            h = lambda j: F.get(s, j)["h"]
            same = F.filter(F.transform(s, lambda x, j: F.when(
                h(j).eqNullSafe(h(j - 1)) | h(j).eqNullSafe(h(j + 1)), x["i"])),
                lambda x: x.isNotNull())
            return F.sort_array(same)

        ordered = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(ordered, lambda s: let(starts(s), lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(WINDOW), x - F.coalesce(F.get(p, k - 1), x - WINDOW))),
            F.lit(0).cast("long"), lambda a, x: a + x)))

    return let(grams, lambda g: F.when(g.isNull() | (F.size(F.array_distinct(g)) == F.size(g)), F.lit(0).cast("long"))
               .otherwise(covered(g)))


def _dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"),
                     lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def bucket_weights(docs: DataFrame, trusted: DataFrame, n_buckets: int = N_BUCKETS,
                   smoothing: float = SMOOTHING) -> np.ndarray:
    """Integer log-likelihood ratio per bucket (an array of ``n_buckets``, whatever the input).

    ``trusted`` has the ``doc_id`` of the trusted documents; it is joined by broadcast,
    so it must be a bounded sample (``trusted_sample``).
    """
    t = F.broadcast(trusted.select(F.col("doc_id").alias("_t")).distinct())
    d = docs.select("doc_id", "text")
    grams = (d.join(t, d["doc_id"] == t["_t"], "left")
             .select(F.col("_t").isNotNull().cast("long").alias("_target"),
                     F.explode(let(_word_hashes(words(F.col("text"))), ngram_hashes)).alias("_h"))
             .select("_target", F.pmod("_h", F.lit(n_buckets)).cast("int").alias("_b"))
             .groupBy("_b").agg(F.count("*").alias("raw"), F.sum("_target").alias("target")))
    raw, target = np.zeros(n_buckets), np.zeros(n_buckets)
    for r in grams.collect():            # at most n_buckets rows
        raw[r["_b"]], target[r["_b"]] = r["raw"], r["target"]
    if not target.sum():
        return np.zeros(n_buckets, dtype=np.int64)
    logp = lambda c: np.log((c + smoothing) / (c.sum() + smoothing * n_buckets))
    return np.rint((logp(target) - logp(raw)) * 1e6).astype(np.int64)


def trusted_sample(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """At most ``rows`` documents labelled good, taken in the order of a hash of the id."""
    good = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return hash_sample(good, "doc_id", rows)


def judged(text: Column, weights: np.ndarray, threshold: int = THRESHOLD) -> Column:
    """struct of the counts, the base rules, the score and the verdict of a text."""
    n_buckets, table = len(weights), F.lit(weights)

    def ratio(wh: Column) -> Column:
        return F.aggregate(ngram_hashes(wh), F.lit(0).cast("long"),
                           lambda a, h: a + F.get(table, F.pmod(h, F.lit(n_buckets)).cast("int")))

    counted = let(words(text), lambda w: let(_word_hashes(w), lambda wh: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _repeat_words(wh).alias("n_repeat_words"),
        ratio(wh).alias("llr"))))

    def verdict(q: Column) -> Column:
        n = q["n_words"]
        base = (n < 20) | (100 * q["n_repeat_words"] > 30 * n)
        score = F.floor(q["llr"] / F.greatest(2 * n - 1, F.lit(1))).cast("long")
        return F.struct(n.alias("n_words"), q["word_chars"].alias("word_chars"), q["n_repeat_words"].alias("n_repeat_words"),
                        base.alias("base_failed"), score.alias("score"), (~base & (score >= threshold)).alias("kept"))

    return let(counted, verdict)


def verdicts(docs: DataFrame, weights: np.ndarray, threshold: int = THRESHOLD) -> DataFrame:
    """One row per document: counts, base rules, score (millionths of a nat), verdict."""
    q = docs.select("doc_id", "text", judged(F.col("text"), weights, threshold).alias("q"))
    return q.select(
        "doc_id", "q.n_words", "q.word_chars",
        F.length(F.regexp_replace(F.coalesce("text", F.lit("")), SYMBOLS, "")).cast("long").alias("n_symbols"),
        _dup_lines(F.col("text")).alias("n_dup_lines"), "q.n_repeat_words",
        "q.base_failed", F.col("q.score").alias("score_micronats"), "q.kept")


def keep(docs: DataFrame, weights: np.ndarray, threshold: int = THRESHOLD) -> DataFrame:
    """The kept documents with their own columns."""
    return docs.filter(judged(docs["text"], weights, threshold)["kept"])
