"""Packing: exact subset sums, gapless sequences, ids against the tokenizers library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from panelcraft.llm import slack_packing as q
from panelcraft.llm.word_ids import ChunkEncoder, check_chunked
from panelcraft.session import written

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 5), min_size=1, max_size=10), st.integers(0, 60))
def test_fullest_combination(counts, room):
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1) if s + k * length <= room}
    used = q.fullest(counts, room)
    assert sum(x * n for x, n in used.items()) == max(sums)
    assert all(n <= counts[x] for x, n in used.items())


def test_plan_uses_every_piece_once():
    rng = random.Random(3)
    counts = {rng.randint(1, 200): rng.randint(1, 50) for _ in range(60)}
    done = defaultdict(int)
    for use, times in (p := q.plan(counts, 200)):
        assert sum(x * n for x, n in use.items()) <= 200
        for x, n in use.items():
            done[x] += n * times
    assert dict(done) == counts
    bins = []                                    # first fit decreasing
    for x in sorted((x for x, n in counts.items() for _ in range(n)), reverse=True):
        k = next((i for i, b in enumerate(bins) if b + x <= 200), None)
        if k is None:
            bins.append(x)
        else:
            bins[k] += x
    assert sum(t for _, t in p) <= len(bins)


def check(df, capacity):
    rows = [r.asDict() for r in q.pack_documents(df, PATH, capacity).collect()]
    library = Tokenizer.from_file(PATH)
    want = []
    for r in df.select("doc_id", "text").collect():
        ids = [*library.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), capacity):
            p = ids[k:k + capacity]
            want.append((r["doc_id"], k // capacity, k, len(p), zlib.crc32(np.array(p, "<u4").tobytes())))
    key = lambda x: tuple((y is not None, y or 0) for y in x)
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=key) == sorted(want, key=key)
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(places) <= -(-sum(r["length"] for r in rows) // capacity) + 2


def test_documents(docs):
    check(docs, 4096)


@pytest.mark.parametrize("capacity", [16, 512])
def test_edge_cases(edge, capacity):
    check(edge, capacity)


def test_empty_table(empty):
    assert q.pack_documents(empty, PATH).collect() == []


def test_one_length_for_all(spark):
    d = written(spark.range(5000).selectExpr("id as doc_id", "0 as piece", "7L as length"), "test")
    rows = q.pack(d, 100).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 5000
    assert len({r["sequence_id"] for r in rows}) == -(-5000 // 14)


def test_wrong_lengths_are_an_error(spark):
    d = spark.createDataFrame([(1, 0, 101)], "doc_id long, piece int, length long")
    with pytest.raises(ValueError):
        q.pack(d, 100)


PIECES = st.sampled_from(["the", "Foo, bar.", " ", "\n", "\t", "  ", "'s", "DON'T", "é", "É", "ß", "Σ", "İ", "<|endoftext|>", "<|", "日本",
                          "a", "1", "23", "...", ",.", ".,", "%%", "µ", "ª", " ", "́", " ", "\x00", "\x85", "😀", "it's 9 o'clock"])


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=14).map("".join) | st.text(max_size=20))
def test_chunked_ids_equal_whole_text_ids(text):
    got = np.frombuffer(ENCODER.encode(text), "<u2").tolist()
    assert got == ENCODER.library.encode(text, add_special_tokens=False).ids


ENCODER = ChunkEncoder(PATH)


def test_only_files_that_can_be_chunked():
    with pytest.raises(ValueError):
        check_chunked(public_tokenizers.path("byte_bpe_50k.json"))
