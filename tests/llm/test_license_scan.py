"""License scan against plain Python."""

import random
import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelcraft.llm import license_scan as q
from panelcraft.llm.license_rules import BASE, LONGEST, RULES, Rule

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def found(words, rules):
    """Every place by trying each rule, without keywords."""
    text, out = " ".join(words), []
    for i, r in enumerate(rules):
        for m in re.finditer(rf"(?<![^ ])(?:{r.regex})(?![^ ])", text):
            start = text[:m.start()].count(" ")
            out.append((start, start + m.group().count(" ") + 1, r.priority, i, r.label))
    return out


def kept(places):
    """Compares all pairs: a place goes if another of a priority as strong contains it."""
    def beats(e, d):
        if e[2] > d[2] or e[0] > d[0] or e[1] < d[1]:
            return False
        return (e[0], e[1]) != (d[0], d[1]) or (e[2], e[3]) < (d[2], d[3])
    return [d for d in places if not any(beats(e, d) for e in places)]


def brute(doc_id, text, rules=RULES):
    words = words_of(text)
    base = [(i, label) for label, phrase in BASE for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    ks = kept(found(words, rules))
    starts, names = [i for i, _ in base], {x for _, x in base}
    score = max([q.CONFIDENCE[d[2]] for d in ks], default=0.0)
    return (doc_id, len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(names)),
            ",".join(sorted(names | {d[4] for d in ks})), score, len(ks))


def check(df):
    want = Counter(brute(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())
    got = q.report(df)
    assert Counter(tuple(r) for r in got.collect()) == want
    return want


def test_documents(docs):
    want = check(docs)
    assert {"mit", "apache-2", "cc-by-nc"} <= {x for k in want for x in k[6].split(",")}


def test_cases(edge, empty):
    check(edge.unionByName(edge.filter("doc_id = 6")))
    assert q.report(empty).collect() == [] and q.detections(empty).collect() == []


TEXTS = ["Released under the MIT License.", "under the MIT-license UNDER THE mit  license", "underthe mit license", "CC-BY-NC 4.0 cc by-nc",
         "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
         "GNU Lesser General Public License, version 2.1 or GNU General Public License v3", "ÜNDER the mit license", "the mit licenseé",
         "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
         "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
         "SPDX-License-Identifier: MIT", "spdx license identifier foo", "apache license version 2 apache license version 2 0", "license", "mit mit"]


def test_texts(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    check(df)
    got = {r["doc_id"]: set(r["labels"].split(",")) for r in q.report(df).collect()}
    assert got[0] == got[1] == {"mit"} and got[2] == {"mit"} and got[6] == {"mit"} and got[7] == {""}
    assert got[5] == {"lgpl-2.1", "gpl-3"}                                     # the longer name contains the shorter


def test_random_mixtures(spark):
    rng, parts = random.Random(5), [r.regex.replace("(?:", "").split(" ") for r in RULES if not set("[{|?") & set(r.regex)]
    texts = [" ".join(w for _ in range(rng.randrange(1, 12)) for w in rng.choice(parts)[:rng.randrange(1, 30)]) for _ in range(150)]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


@pytest.mark.parametrize("n", [40_000])
def test_many_places_in_one_text(spark, n):
    df = spark.createDataFrame([(1, "cc by nc " * n), (2, "word " * 200_000 + "under the mit license"), (3, "x" * 500_000)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in q.report(df).collect()}
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["n_kept"]) == (n, 0, 3 * n - 3, n)
    assert (got[2]["n_base"], got[2]["first_word"]) == (1, 200_000) and got[3]["n_words"] == 1


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.data())
def test_rules_imply_their_keywords_and_are_bounded(data):
    for r in RULES:
        text = data.draw(st.from_regex(r.regex, fullmatch=True))
        assert set(r.keywords) <= set(text.split(" ")), r
        assert len(text.split(" ")) <= LONGEST
        assert not re.search(r"[*+]|\{\d*,\}", r.regex.replace("[^ ]+", "")), r


def test_suppression_by_priority_and_order(spark):
    rules = [Rule("weak", 3, ("b",), "a b c d"), Rule("strong", 1, ("b",), "b c"), Rule("same", 1, ("b",), "b c"), Rule("inner", 3, ("b",), "b"),
             Rule("overlap", 2, ("d",), "c d e")]
    df = spark.createDataFrame([(1, "a b c d e")], "doc_id long, text string")
    got = [(r["label"], r["start"], r["end"]) for r in q.detections(df, rules).orderBy("rule").collect()]
    assert got == [("weak", 0, 4), ("strong", 1, 3), ("overlap", 2, 5)]


def test_running_max_over_blocks(spark):
    rng = random.Random(1)
    v = [rng.randrange(100) for _ in range(37)]
    df = spark.createDataFrame([(v,), ([],), ([4],)], "v array<int>")
    for block in (1, 5, 64):
        got = [r["m"] for r in df.select(q.running_max(F.col("v"), block).alias("m")).collect()]
        assert got == [[max(v[:i], default=None) for i in range(len(v))], [], [None]]


def test_hundreds_of_rules_and_no_python_worker(docs):
    assert len(RULES) > 200
    plan = q.report(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Exchange"))
