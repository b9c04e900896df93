"""The codec against the sentencepiece library."""

import hashlib
import random
import time
from collections import Counter

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from panelcraft.llm import piece_codec as q

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ENCODER = q.Encoder(MODEL)
LIBRARY = ENCODER.vocabulary.library
PIECES = st.sampled_from(["the", "foo, bar. baz\nqux", " ", "  ", "   ", "\n", "\t", "▁", "▁▁", ".", ",", "..", ",.", ".,", "é", "日本", "😀", "\x00",
                          "<s>", "</s>", "<0x41>", "don't", "1", "23", "a", "THE", "ing", "\r\n", " \n", "́"])


@settings(max_examples=500, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=12).map("".join) | st.text(max_size=20), max_size=4))
def test_same_ids_as_the_library(texts):
    ids, corrected = ENCODER.encode_batch(texts)
    assert ids == [LIBRARY.encode(t, add_eos=True) for t in texts]
    assert not any(corrected)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="the ingonrast", min_size=1, max_size=40))
def test_agenda_alone(text):
    """Without cuts and memory: the merges of a whole escaped text."""
    assert list(ENCODER.vocabulary.merge(q.BLANK + text.replace(" ", q.BLANK))) == LIBRARY.encode(text)


def test_a_wrong_word_is_corrected():
    e = q.Encoder(MODEL)
    e.known.learn = lambda key: (5,)
    ids, corrected = e.encode_batch(["some words, here", "", "some"])
    assert ids == [LIBRARY.encode(t, add_eos=True) for t in ("some words, here", "", "some")]
    assert corrected[0] >= 3 and corrected[1] == 0


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(q, "GENERATION", 5)
    e = q.Encoder(MODEL)
    texts = [f"word{i % 17} and, so on{i}." for i in range(60)] * 2
    assert [e.encode_batch([t])[0][0] for t in texts] == [LIBRARY.encode(t, add_eos=True) for t in texts]


def check(df):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = Counter()
    for r in df.select("doc_id", "text").collect():
        ids = LIBRARY.encode(r["text"] or "", add_eos=True)
        want[(r["doc_id"], len(ids), sha(" ".join(map(str, ids))), sha(LIBRARY.decode(ids)), 0)] += 1
    assert Counter(tuple(r) for r in q.digests(df, MODEL).collect()) == want


def test_documents(docs):
    check(docs)


def test_edge_cases(edge):
    check(edge)
    ids = {(r["doc_id"], tuple(r["ids"])) for r in q.encode(edge.filter("doc_id < 5"), MODEL).collect()}
    assert (0, (2,)) in ids and (1, (2,)) in ids


def test_empty_table(empty):
    assert q.digests(empty, MODEL).collect() == []


def test_very_long_texts_without_blanks():
    rng = random.Random(4)
    texts = ["".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(500_000)), "ab1," * 125_000]
    start = time.time()
    ids, corrected = q.Encoder(MODEL).encode_batch(texts)
    assert time.time() - start < 60 and corrected == [0, 0]
    assert ids == [LIBRARY.encode(t, add_eos=True) for t in texts]
