"""Token files: round trips, single spans, damage, order."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from panelcraft.llm import rans_store as q

PATH, VOCAB = public_tokenizers.path("word_bpe_49k.json"), 49_408


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=3000), st.sampled_from([1, 8, 64]), st.sampled_from([1, 4, 128]))
def test_round_trip(ids, lanes, span):
    ids = np.array(ids, dtype=np.uint16)
    coder = q.Coder(q.scaled(np.bincount(ids, minlength=301)))
    block = coder.encode(ids, lanes, span)
    assert (coder.decode(block) == ids).all()
    for s in range(-(-len(ids) // (lanes * span))):
        assert (coder.decode(block, s) == ids[s * lanes * span:(s + 1) * lanes * span]).all()


def test_size_is_near_the_entropy():
    ids = np.minimum(np.random.default_rng(0).zipf(1.4, 300_000), 49_407).astype(np.uint16)
    n = np.bincount(ids)
    p = n[n > 0] / len(ids)
    size = len(q.Coder(q.scaled(n)).encode(ids))
    assert size <= 1.06 * -(p * np.log2(p)).sum() * len(ids) / 8 + 8 * q.LANES * 3


def test_scaled_frequencies():
    for counts in ([0, 1, 0], [1] * 500, [10 ** 12, 1, 1, 0], [0] * 4):
        f = q.scaled(np.array(counts))
        assert ((f > 0) == (np.array(counts) > 0)).all()
        assert f.sum() == (1 << q.SCALE if any(counts) else 0)


def test_damage_is_noticed():
    ids = np.arange(5000, dtype=np.uint16) % 100
    coder = q.Coder(q.scaled(np.bincount(ids)))
    block = bytearray(coder.encode(ids))
    block[-3] ^= 1
    with pytest.raises(ValueError):
        coder.decode(bytes(block))
    with pytest.raises(ValueError):
        q.Coder(q.scaled(np.array([1, 0]))).encode(np.array([1], dtype=np.uint16))


def check(df):
    library = Tokenizer.from_file(PATH)
    rows = [(r["doc_id"], [*library.encode(r["text"] or "", add_special_tokens=False).ids, 2]) for r in df.select("doc_id", "text").collect()]
    got = [tuple(r) for r in q.write_and_read(df, PATH, VOCAB).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    key = lambda x: (x[0] is not None, x[0] or 0)
    got.sort(key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert r[1] == at
        at += r[2]
    want = sorted(((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in rows), key=lambda r: (*key(r), r[1:]))
    assert sorted(((r[0], r[2], r[3]) for r in got), key=lambda r: (*key(r), r[1:])) == want


def test_documents(docs):
    check(docs)


def test_edge_cases(edge):
    check(edge)


def test_empty_table(empty):
    assert q.write_and_read(empty, PATH, VOCAB).collect() == []
