"""The masked model: distribution, learning, scores against plain Python."""

import math

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelcraft.llm import masked_lm as q


@pytest.fixture(scope="module")
def model(docs_):
    return q.train(docs_)


@pytest.fixture(scope="module")
def docs_(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def plain(text, m):
    """Sum of log P(word | words on both sides), word by word."""
    lex, net = m.lexicon, {k: v.astype(float) for k, v in m.network.items()}
    ids, total = lex.ids([text])[0], 0.0
    for i in range(len(ids)):
        rows = [lex.context[ids[j]] if 0 <= j < len(ids) else lex.boundary for j in (i - 2, i - 1, i + 1, i + 2)]
        h = np.tanh(np.concatenate([net["vectors"][r] for r in rows]) @ net["w1"] + net["b1"])
        group, member = lex.class_of[ids[i]] % q.GROUPS, lex.class_of[ids[i]] // q.GROUPS
        for z, own in ((h @ net["w2"] + net["b2"], group), (np.append(h, 1) @ net["w3"][group], member)):
            total += z[own] - math.log(np.exp(z).sum())
        total += lex.log_share[ids[i]]
    return len(ids), total


def test_scores_against_plain_python(spark, model, docs):
    rows = {r["doc_id"]: r for r in q.score(docs.limit(30), model).collect()}
    for r in docs.limit(30).collect():
        n, s = plain(r["text"], model)
        assert rows[r["doc_id"]]["n_tokens"] == n
        assert rows[r["doc_id"]]["log_likelihood"] == pytest.approx(s, rel=1e-4)


def test_word_itself_is_masked(model):
    lex = model.lexicon
    seen = []
    for text in ("of the and", "of zzzz and"):
        line, at = lex.line(*lex.ids([text]))
        seen.append(line[at[1] + q.SIDES].tolist())
    assert seen[0] == seen[1] and seen[0][0] == seen[0][3] == lex.boundary


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab éß日THE\n\t\x0b\x1c\x00\xa0", max_size=40) | st.none(), max_size=6))
def test_numbers_of_words(texts):
    words = ["a", "b", "the", "é", "日", "ab", "aa", "ba", "éß", "日日"]
    lex = q.Lexicon(words, np.ones(len(words)), np.zeros(q.CLASSES), np.zeros(q.CLASSES))
    ids, size = lex.ids(texts)
    cut = [(t or "").lower().encode().split() for t in texts]
    assert size.tolist() == [len(c) for c in cut]
    rank = {w.encode(): i for i, w in enumerate(words)}
    assert ids.tolist() == [rank.get(w, q.VOCABULARY + q.ending_class(w)) for c in cut for w in c]


def test_shares_sum_to_one_in_each_class(model, docs_):
    lex = model.lexicon
    share = np.exp(lex.log_share[:len(lex.vocabulary)])
    total = np.bincount(lex.class_of[:len(lex.vocabulary)], share, q.CLASSES)
    total += np.exp(lex.log_share[q.VOCABULARY:]) * (lex.types + 1)
    assert total == pytest.approx(np.ones(q.CLASSES))


def test_training_beats_the_classes_alone(docs_, model):
    lex = model.lexicon
    texts = [r["text"] for r in docs_.limit(200).collect()]
    flat = {**q.initial(lex), "w2": np.zeros(q.SHAPES["w2"], np.float32), "w3": np.zeros(q.SHAPES["w3"], np.float32)}
    ids, size = lex.ids(texts)
    mean = lambda net: q.Scorer(lex, net).log_likelihoods(ids, size).sum() / size.sum()
    assert mean(model.network) > mean(flat) + 0.1


def test_gradient_step_lowers_the_loss(model):
    rng = np.random.default_rng(1)
    net = {k: v.copy() for k, v in q.initial(model.lexicon).items()}
    squares = {k: np.zeros_like(v) for k, v in net.items()}
    context, target = rng.integers(0, 50, (256, 2 * q.SIDE)), rng.integers(0, 4, 256)
    losses = [q.step(net, squares, context, target, 0.05) for _ in range(60)]
    assert losses[-1] < 0.6 * losses[0]


def test_edge_cases(edge, model):
    rows = q.score(edge, model).collect()
    assert len(rows) == edge.count()
    for r in rows:
        assert (r["n_tokens"] == 0) == (r["mean_log_likelihood"] is None)
        assert r["log_likelihood"] <= 0 and math.isfinite(r["log_likelihood"])
    own = q.train_and_score(edge)
    assert own.count() == edge.count()


def test_empty_table(empty):
    assert q.train_and_score(empty).collect() == []


@pytest.mark.parametrize("most", [1, 7, 50, 10_000])
@pytest.mark.parametrize("parts", [2, 1024])
def test_least_count(spark, most, parts):
    n = [1] * 40 + [2] * 9 + [3, 3, 5, 8, 8, 100, 70_000, 70_001]
    df = spark.createDataFrame([(f"w{i}", k) for i, k in enumerate(n)], "word string, n long")
    least = q.least_count(df, most, parts)
    assert sum(k >= least for k in n) <= most
    below = max((k for k in n if k < least), default=None)
    assert below is None or sum(k >= below for k in n) > most
    assert q.least_count(df.limit(0), most, parts) >= 0


@pytest.mark.parametrize("rounds", [1, 2, 3, 8])
def test_rounds_cover_every_window_once(rounds):
    size = np.array([0, 1, 2, 3, 6, 7, 0, 20])
    seen = np.concatenate([q.windows(size, r, rounds) for r in range(rounds)])
    assert sorted(seen.tolist()) == list(range(size.sum()))


def test_short_texts_are_trained_on(spark):
    df = spark.createDataFrame([(i, ["one", "two words", "three short words"][i % 3]) for i in range(90)], "doc_id long, text string")
    m = q.train(df)
    assert all(not np.allclose(m.network[k], v) for k, v in q.initial(m.lexicon).items() if k in ("b2", "w2", "w3", "vectors"))


def test_words_beyond_the_vocabulary_have_their_own_counts(spark, docs):
    m = q.train(docs, vocabulary=300)
    lex, count = m.lexicon, {}
    texts = [r["text"] for r in docs.select("text").collect()]
    for t in texts:
        for w in (t or "").lower().encode().split():
            count[w] = count.get(w, 0) + 1
    assert len(lex.vocabulary) <= 300 < len(count)
    known = {w.encode() for w in lex.vocabulary}
    total = np.bincount([lex.class_of[lex.ids([w.decode()])[0][0]] for w in count], list(count.values()), q.CLASSES) + 1
    got = {r["doc_id"]: r["log_likelihood"] for r in q.score(docs, m).collect()}
    for r in docs.limit(30).collect():
        s = plain(r["text"], m)[1]
        for w in r["text"].lower().encode().split():
            if w not in known:
                i = lex.ids([w.decode()])[0][0]
                s += math.log(count[w] / total[lex.class_of[i]]) - lex.log_share[i]
        assert got[r["doc_id"]] == pytest.approx(s, rel=1e-4)


def test_counts_of_words(spark, edge, monkeypatch):
    monkeypatch.setattr(q, "COUNTED", 40)
    odd = spark.createDataFrame([(1, "A a\x0bb\x0cc\td\re\nf\x1cg\x85h\xa0i  J "), (2, " "), (3, None), (4, "İ ΑΣ ß")], "doc_id long, text string")
    for docs in (odd, edge, edge.limit(0)):
        count = {}
        for r in docs.collect():
            for w in (r["text"] or "").lower().encode().split():
                count[w.decode()] = count.get(w.decode(), 0) + 1
        assert {r["word"]: r["n"] for r in q.word_counts(docs).collect()} == count


def test_repeated_rows_stay_apart_beside_the_join(spark, edge):
    m = q.train(edge, vocabulary=3)
    whole = sorted((r["doc_id"] or -1, r["n_tokens"]) for r in q.score(edge, m).collect())
    assert whole == sorted((r["doc_id"] or -1, len((r["text"] or "").encode().split())) for r in edge.collect())


def test_classes_have_one_place_each():
    group, member = q.group_and_member(np.arange(q.CLASSES))
    assert len(set(zip(group.tolist(), member.tolist(), strict=True))) == q.CLASSES
    assert group.max() == q.GROUPS - 1 and member.max() == q.MEMBERS - 1


def test_probabilities_of_all_classes_sum_to_one(model):
    """One text of one word for each class: all have the same window."""
    scorer = q.Scorer(model.lexicon, model.network, np.zeros(q.VOCABULARY + q.CLASSES))
    got = scorer.log_likelihoods(q.VOCABULARY + np.arange(q.CLASSES), np.ones(q.CLASSES, dtype=int))
    assert np.exp(got).sum() == pytest.approx(1, abs=1e-4)


def test_gradients_against_differences(model):
    """A step of Adagrad from given squares moves each parameter by its numeric gradient."""
    rng = np.random.default_rng(3)
    net = {k: v.astype(float) for k, v in q.initial(model.lexicon).items()}
    context, target = rng.integers(0, 30, (40, 2 * q.SIDE)), rng.integers(0, q.CLASSES, 40)
    loss = lambda m: q.step({k: v.copy() for k, v in m.items()}, {k: np.ones_like(v) for k, v in m.items()}, context, target, 0.0)
    big = 1e12                                            # squares so large that a step is the gradient over 1e6
    moved = {k: v.copy() for k, v in net.items()}
    q.step(moved, {k: np.full_like(v, big) for k, v in net.items()}, context, target, 1e6)
    g, m = int(target[0]) % q.GROUPS, int(target[0]) // q.GROUPS
    for k, at in (("vectors", (context[0, 1], 3)), ("w1", (5, 7)), ("b1", (2,)), ("w2", (4, g)), ("b2", (g,)), ("w3", (g, 6, m)), ("w3", (g, q.HIDDEN, m))):
        up, down = ({n: v.copy() for n, v in net.items()} for _ in range(2))
        up[k][at] += 1e-5
        down[k][at] -= 1e-5
        assert net[k][at] - moved[k][at] == pytest.approx((loss(up) - loss(down)) / 2e-5, rel=1e-3, abs=1e-7)


@pytest.mark.parametrize("offset", [0, 3])
def test_numbers_of_the_table(offset, monkeypatch):
    monkeypatch.setattr(q, "WORDS", 5)
    own = [[], [1], [2, 3, 4], [], [5] * 12, [6, 7], [], [8]]
    column = pa.array([np.array(x, np.int32).tobytes() for x in own], pa.binary())[offset:]
    got = [(rows, ids.tolist(), size.tolist()) for rows, ids, size in q.numbers_of(column)]
    assert [i for r, _, _ in got for i in range(r.start, r.stop)] == list(range(len(own) - offset))
    assert [x for _, ids, _ in got for x in ids] == [x for o in own[offset:] for x in o]
    assert [n for _, _, size in got for n in size] == [len(o) for o in own[offset:]]
    assert list(q.numbers_of(pa.array([], pa.binary()))) == []


def test_arrays_are_kept_between_batches(model):
    rng = np.random.default_rng(1)
    net, other = ({k: v.copy() for k, v in model.network.items()} for _ in range(2))
    sums, more = ({k: np.zeros_like(v) for k, v in net.items()} for _ in range(2))
    room = q.Room(np.float32)
    for n in (50, 7, 64):                                   # a smaller batch uses a part, a larger one makes room
        context, target = rng.integers(0, q.CONTEXT, (n, 2 * q.SIDE)), rng.integers(0, q.CLASSES, n)
        assert q.step(net, sums, context, target, 0.1, room) == q.step(other, more, context, target, 0.1)
    assert all((net[k] == other[k]).all() for k in net)
    held = room("x", 5, 4)
    assert np.shares_memory(held, room("x", 3, 4)) and room("x", 3, 4).shape == (3, 4)


def test_counts_of_runs_are_added_up_in_a_task(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "a b b") for i in range(40)], "doc_id long, text string").coalesce(1)
    expected = {"a": 40, "b": 80}
    for added in (1, 3, 1 << 20):
        monkeypatch.setattr(q, "ADDED", added)
        monkeypatch.setattr(q, "COUNTED", 10)
        assert {r["word"]: r["n"] for r in q.word_counts(docs).collect()} == expected
