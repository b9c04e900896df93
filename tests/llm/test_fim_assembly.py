"""Fill-in-the-middle against plain Python."""

import hashlib
import re
from collections import Counter

import pytest

from panelcraft.llm import fim_assembly as q

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
sha = lambda t: hashlib.sha256(t.encode()).hexdigest()


def brute(doc_id, text, fim=50, spm=80, seed=42):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    a, b = min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))
    if text == "" or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= fim:
        return doc_id, n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(df, **rates):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    want = [brute(*r, **rates) for r in rows]
    got = q.round_trip(df, q.Rates(**rates))
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == Counter((*w[:5], sha(w[5]), sha(t or "")) for w, (_, t) in zip(want, rows, strict=True))
    assert Counter(tuple(r) for r in q.transformed(df, q.Rates(**rates)).collect()) == Counter(want)


def test_documents(docs):
    check(docs)


@pytest.mark.parametrize("rates", [{"fim": 100, "spm": 0}, {"fim": 100, "spm": 100, "seed": 7}, {"fim": 0}])
def test_cases(edge, rates):
    check(edge.unionByName(edge.filter("doc_id = 6")), **rates)


def test_empty_table(empty):
    assert q.round_trip(empty).collect() == [] and q.transformed(empty).collect() == []


def test_markers_blanks_and_long_units(spark):
    texts = ["a <P> b", "<S>", "x<M", "<<P", "< P> <", "<P", " ", "\t\n a", "a \x0b", "é" * 9000 + " " * 9000 + "<" * 9000,
             "x" * 500_000, " ".join(["<"] * 2000), "日本 語\n", "ends in <"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "doc_id long, text string").repartition(2)
    for seed in (1, 2):
        check(df, fim=100, seed=seed)


def test_no_piece_is_large_and_tasks_stream(spark, monkeypatch):
    text = "word " * 5000 + "y" * 50_000
    ends, form, a, b = q.plan(text, "1", q.Rates(fim=100))
    got = list(q.pieces(text, ends, form, a, b))
    assert max(map(len, got)) <= q.CHARS and len(got) > 30
    assert q.MARK.sub(b"", b"".join(got)).decode() != "" and len(b"".join(got)) == len(text) + 9


def test_markers_cut_between_pieces():
    whole = b"<P>ab<S>cd<<M>e<"
    for size in (1, 2, 3, 5):
        p, found = q._Parser("psm"), {0: b"", 1: b"", 2: b""}
        for i in range(0, len(whole), size):
            for place, part in p.feed(whole[i:i + size]):
                found[place] += part
        for place, part in p.feed(b"", last=True):
            found[place] += part
        assert found == {0: b"ab", 2: b"cd<", 1: b"e<"}
