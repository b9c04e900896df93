"""Line and sentence dedup against plain Python."""

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from panelcraft.llm import line_dedup as q


@given(st.text(alphabet="ab .!?\n\t", max_size=60))
def test_units_cover_the_text(text):
    u = q.units(text)
    assert "".join(text[a:b] for a, b, _ in u) == text
    assert all("\n" not in text[a:b - 1] for a, b, _ in u)


M64 = (1 << 64) - 1
POWERS = [1]
for _ in range(4096):
    POWERS.append(POWERS[-1] * 0x9E3779B97F4A7C15 & M64)


def kind_of(c):
    """0 white space, 2 a word by itself, 1 any other."""
    return 0 if c.isspace() and ord(c) < 0x3100 else 2 if any(a <= ord(c) <= b for a, b in q.UNSPACED) else 1


def word_starts(text):
    ks = [kind_of(c) for c in text]
    return [i for i, k in enumerate(ks) if k and (i == 0 or ks[i - 1] != 1 or k == 2)]


def word_hash(word):
    h = 0
    for j, c in enumerate(word):
        if kind_of(c):
            h += POWERS[j % 4096 + 1] * (ord(c) + 1)
    h = (h & M64) ^ ((h & M64) >> 29)
    h = h * 0xBF58476D1CE4E5B9 & M64
    return h ^ (h >> 32)


def sentences(line):
    """Ends of the sentences of a line (its line end included)."""
    out, at = [], 0
    for m in re.finditer(r"[.!?]+[ \t]+|[。！？｡]+[ \t]*|\n", line):
        out.append((at, m.end()))
        at = m.end()
    return out + ([(at, len(line))] if at < len(line) else [])


def plain_units(text):
    """[(start, end, content)] by line, cut by hand; and the units of each line."""
    out, lines = [], []
    at = 0
    for line in re.findall(r"[^\n]*\n|[^\n]+", text):
        first = len(out)
        for a, b in sentences(line):
            sentence = line[a:b]
            starts = word_starts(sentence)
            cuts = [0]
            if len(starts) >= q.LONG:
                ends = starts[1:] + [len(sentence)]
                hs = [word_hash(sentence[i:j].casefold()) for i, j in zip(starts, ends)]
                cuts += [p for k, p in enumerate(starts) if hs[k] == min(hs[max(0, k - q.SIDE):k + q.SIDE + 1])]
            edges = sorted({*cuts, len(sentence)}) if sentence else [0]
            out += [(at + a + i, at + a + j, " ".join(sentence[i:j].casefold().split())) for i, j in zip(edges, edges[1:])]
        lines.append((first, len(out) - 1))
        at += len(line)
    return out, lines


def words_in(content):
    return content.count(" ") + 1 if content.isascii() else len(word_starts(content))


def brute(rows, min_words=q.MIN_WORDS, whole_lines=False):
    """rows (doc_id, t, text): spans, with units and lines seen in the order of the rows."""
    seen_units, seen_lines, spans = {}, {}, {}
    for has, i, t, text in sorted({(r[0] is not None, r[0] or 0, r[1], r[2]) for r in rows if r[2]}):
        found, lines = plain_units(text)
        gone = set()
        for k, (_, _, c) in enumerate(found):
            if c and seen_units.setdefault(c, (has, i, t, k)) != (has, i, t, k):
                gone.add(k)
        short = set()
        for a, b in lines if whole_lines else []:
            content = " ".join(text[found[a][0]:found[b][1]].casefold().split())
            if content and seen_lines.setdefault(content, (has, i, t, a)) != (has, i, t, a):
                short |= set(range(a, b + 1))
        marks, out, k = gone | short, [], 0
        while k < len(found):
            if k not in marks:
                k += 1
                continue
            run = [k]
            while run[-1] + 1 < len(found) and (run[-1] + 1 in marks or not found[run[-1] + 1][2]):
                run.append(run[-1] + 1)
            while run[-1] != k and not found[run[-1]][2]:
                run.pop()
            nxt = run[-1] + 1
            if sum(words_in(found[x][2]) for x in run if found[x][2]) >= min_words:
                out.append((found[k][0], found[run[-1]][1]))
            else:
                for x in run:
                    if x in short:
                        out.append((found[x][0], found[x][1]))
            k = nxt
        joined = []
        for a, b in out:
            if joined and joined[-1][1] == a and whole_lines:
                joined[-1] = (joined[-1][0], b)
            else:
                joined.append((a, b))
        spans[(i if has else None, t, text)] = tuple(joined)
    return Counter((i, spans.get((i, t, text), ())) for i, t, text in rows)


def check(df, min_words=q.MIN_WORDS, whole_lines=False):
    rows = [tuple(r) for r in df.selectExpr("doc_id", "hash(text)", "text").collect()]
    got = Counter()
    for r in q.without_repeats(df, min_words, whole_lines=whole_lines).collect():
        spans = tuple((s["start"], s["end"]) for s in r["removed"])
        got[(r["doc_id"], spans)] += 1
        edges = [0, *(x for s in spans for x in s), len(r["text"] or "")]
        kept = "".join((r["text"] or "")[a:b] for a, b in zip(edges[::2], edges[1::2]))
        assert (r["kept_text"] or "") == kept and (r["kept_text"] is None) == (r["text"] is None)
    assert got == brute(rows, min_words, whole_lines)


@pytest.mark.parametrize("whole_lines", [False, True])
def test_documents(docs, whole_lines):
    check(docs, whole_lines=whole_lines)


def test_edge_cases(edge):
    check(edge.filter("length(text) < 100000 or text is null"), whole_lines=True)
    check(edge.filter("length(text) < 100000 or text is null"), 1)


def test_ids_with_several_texts_and_mixed_lines(spark):
    rng = np.random.default_rng(8)
    some = ["Yes.", "No way.", "a b c d e f g h i j k l m n o p q r s t u v w", "One two. Three four five.", "", "  ", "yes.", "Ünï code. Ça va?",
            "first second third fourth fifth sixth seventh eighth ninth. Next one", "一二三。四五六。"]
    texts = ["\n".join(rng.choice(some, rng.integers(1, 9))) for _ in range(60)]
    rows = [(int(i) if i else None, t) for i, t in zip(rng.integers(0, 25, 60), texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for n in (1, 5, 20):
        check(df, n, True)
        check(df.filter("doc_id is not null").dropDuplicates(["doc_id"]), n, True)


def test_the_map_has_the_repeated_digests(spark):
    rng = np.random.default_rng(1)
    h = rng.integers(-1 << 62, 1 << 62, 3000)
    df = spark.createDataFrame([(h[:2000].tolist(),), (h[1000:].tolist(),)], "h array<long>")
    bits = np.unpackbits(q.repeated_map(df), bitorder="little")
    assert bits[h[1000:2000] & (q.BITS - 1)].all() and bits.sum() <= 1000


def test_empty_table(empty):
    assert q.report(empty).collect() == [] and q.strip(empty).collect() == []


def test_strip_keeps_the_schema(docs, edge):
    for df in (docs, edge):
        s = q.strip(df)
        assert s.dtypes == df.dtypes and s.count() == df.count()
    assert q.strip(docs).filter("n_chars <> length(text)").count() == 0


def test_passages_go_and_chance_repeats_stay(spark):
    passage = " ".join(f"Sentence number {i} of the shared passage stands here." for i in range(8))
    rows = [(1, f"Mine alone.\nYes.\n{passage}\nMore of mine."), (2, f"Other words. {passage} Yes. And other ends."),
            (3, "Yes.\nNothing else is shared."), (4, "a\n" * 50)]
    got = {r["doc_id"]: r for r in q.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["n_spans"] == 0 and got[3]["text"] == rows[2][1]
    assert got[2]["text"] == "Other words. And other ends."
    assert got[4]["text"] == "a\n"


def kept(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["text"] for r in q.report(df, **options).orderBy("doc_id").collect()]


def test_every_later_whole_line_goes(spark):
    texts = ["Yes.\nMine alone.\nA short line here", "a short  LINE here\nOther words. Yes.\n\nyes.\nEnd of two", "Yes. Indeed.\nEnd of two\nEnd of two"]
    assert kept(spark, texts, whole_lines=True) == [texts[0], "Other words. Yes.\n\nEnd of two", "Yes. Indeed.\n"]


def test_passages_pasted_inside_sentences_go(spark):
    rng = np.random.default_rng(3)
    some = lambda n: " ".join(f"w{i}" for i in rng.integers(0, 10**6, n))
    texts, passages = [], []
    for _ in range(40):
        passages.append(some(51))
        texts += [f"{some(6)} {passages[-1]} {some(5)}.\n"]
    first = len(texts)
    texts += [f"{some(7)} {p} {some(9)}." for p in passages]
    left = kept(spark, texts, whole_lines=True)
    assert left[:first] == texts[:first]
    gone = [len(a.split()) - len(b.split()) for a, b in zip(texts[first:], left[first:])]
    assert all(20 <= n <= 51 for n in gone) and sum(gone) / len(gone) > 35


def test_scripts_without_blanks(spark):
    passage = "".join(chr(0x4E00 + 37 * i) for i in range(60))
    left = kept(spark, [f"一二三。{passage}四五六。", f"Other {passage} words"])
    assert len(left[1]) < 35
    assert [c for _, _, c in q.units("一二三。四五。")] == ["一二三。", "四五。"]
