"""Memory of workers: bounded in bytes, and of one operator at a time."""

from panelcraft.llm import memo, piece_codec, word_ids


def test_generations_are_bounded_in_bytes():
    learned = []
    m = memo.Sized(lambda k: learned.append(k) or k.encode(), 5000, 10)
    for i in range(1000):
        assert m[f"k{i}"] == f"k{i}".encode()
        m.age()
        assert m.size <= 5000 + 200 and (len(m) + len(m.old)) * memo.Sized.ENTRY < 2 * 5400
    m["x" * 11]
    assert "x" * 11 not in m and learned[-1] == "x" * 11
    before = len(learned)
    m["k999"], m["k999"]
    assert len(learned) == before                       # the older generation is asked first


def test_another_operator_begins(monkeypatch):
    gone = []
    monkeypatch.setattr(memo, "_FORGET", {"a": lambda: gone.append("a"), "b": lambda: gone.append("b")})
    monkeypatch.setattr(memo, "_now", [""])
    for name in ("a", "a", "b", "", "a"):
        memo.begin(name)
    assert gone == ["b", "a", "a", "b", "b"]


def test_codecs_are_forgotten():
    assert {"word_ids", "piece_codec"} <= set(memo._FORGET)
    import public_tokenizers
    one = word_ids.encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert word_ids.encoder(public_tokenizers.path("word_bpe_49k.json")) is one
    piece_codec.encoder(public_tokenizers.path("piece_bpe_32k.model"))
    assert word_ids.encoder(public_tokenizers.path("word_bpe_49k.json")) is not one
