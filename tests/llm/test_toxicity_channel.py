"""Noisy channel, classifier and held-out accuracy."""

import zlib

import numpy as np
import pytest

from panelcraft.llm import toxicity_channel as q


@pytest.fixture(scope="module")
def model(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return q.train(d, spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))


def test_trigrams_are_those_of_all_texts(docs):
    want = np.zeros((q.SIZE,) * 3, dtype=int)
    for r in docs.select("text").collect():
        k = [q.class_of(c) for c in f" {r['text']} "]
        np.add.at(want, (k[:-2], k[1:-1], k[2:]), 1)
    assert (q.trigrams(docs) == want).all()


def test_decoder_finds_the_best_path(model):
    """Against all paths of the lattice."""
    from itertools import product
    for text in ("l0s3r", "a.b.c", "st00o", "id1 t", "ooo1", "7h3"):
        best = max(product(*q.lattice(text)), key=lambda p: _score(p, model.table))
        assert q.decode(text, model.table).split() == "".join(m for m, _ in best).split()


def _score(path, logp):
    a = b = 0
    s = 0.0
    for meant, cost in (*path, (" ", 0.0)):
        s += cost
        for c in meant:
            k = q.class_of(c)
            if k or b:
                s += logp[(a * q.SIZE + b) * q.SIZE + k]
                a, b = b, k
    return round(s, 9)


def test_disguised_words_score_like_plain_ones(model):
    words = sorted((w for w in model.weights if "~" not in w and w.isascii() and len(w) > 4), key=lambda w: -model.weights[w])[:8]
    assert words
    for w in words:
        plain = model.score(f"the and {w} of the")
        for shown in (" ".join(w), "-".join(w), w[0] + w[1] * 5 + w[2:], w.replace("o", "0").replace("i", "1").replace("a", "@")):
            found = model.score(f"the and {shown} of the")
            assert found == pytest.approx(plain, abs=0.35), (w, shown)


def test_plain_text_is_left_alone():
    flat = np.zeros(q.SIZE ** 3).tolist()
    for t in ("words", "é", "l'eau", "the!!", "of%%%", "in,&&&", "a-b", "2024", "...", ""):
        assert all(w in t for w in q.restored_words(t, flat))


def test_held_out_accuracy_and_rows(spark, model):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = q.judgements(d, model).collect()
    assert len(rows) == d.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    judged = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(a == b for a, b in judged) >= 0.9 * len(judged)


def test_held_out_labels_are_never_read(spark, docs, labels):
    from pyspark.sql import functions as F
    flipped = labels.withColumn("toxic", F.when(q.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = q.train(docs, labels), q.train(docs, flipped)
    assert a.weights == b.weights and (a.coefficients == b.coefficients).all()


def test_edge_cases(edge, model):
    rows = q.judgements(edge, model).collect()
    none = model.score("")
    assert len(rows) == edge.count()
    assert {r["score"] for r in rows if r["doc_id"] in (0, 1, 2)} == {none} and none < q.THRESHOLD
    assert all(not r["held_out"] for r in rows if r["doc_id"] is None)
    assert q.keep(edge, model, threshold=2.0).columns == edge.columns
    assert q.keep(edge, model, threshold=2.0).count() == edge.count()


def test_empty_tables_and_one_class(empty, docs, labels, edge):
    m = q.train(docs, labels.filter("toxic = 0"))
    assert m.score("anything") == 0.0
    assert q.judgements(empty, m).collect() == []
    assert q.train(empty, labels).coefficients is None
