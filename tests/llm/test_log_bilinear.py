import math
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest

from txengine.llm import log_bilinear
from txengine.llm.log_bilinear import (
    BilinearOptions, Lexicon, Model, Scorer, Trainer, group_of, lexicon, score_texts, train, windows, word_counts,
)
from txengine.llm.common import words, written

SMALL = BilinearOptions(side=4, groups=4, dim=4, noise=3, batch=64, dictionary=8, first=2)
TEXTS = ["the cat sat", "The DOG sat\tdown", "", None, "the cat the cat", "zebra", "a\x0bb  c", "été été"]


def _score(spark, texts, opts=SMALL, held=lambda i: i % 4 == 3):
    rows = [(i, t, held(i), 1.0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean, score double")
    return {r.doc_id: r for r in score_texts(df, opts).collect()}


def test_counts_and_base_by_definition(spark):
    texts = TEXTS + [f"w{i % 23} w{i % 7} the" for i in range(60)]
    got = _score(spark, texts)
    toks = [[*words(t), b""] for t in texts]
    c = Counter(w for i, t in enumerate(toks) if i % 4 != 3 for w in t)
    n, v = sum(c.values()), len(c)
    for i, t in enumerate(toks):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(c[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), rel=1e-9)
        assert r.score < 0


def test_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS * 5)), "doc_id long, text string")
    lex = lexicon(written(word_counts(docs, SMALL), "t"), replace(SMALL, dictionary=1000))
    model = Scorer(Model(lex).load(train(docs, lex)))
    symbols = np.arange(SMALL.symbols)
    for context in ([0, 0, 0], [1, 2, 0], [5, 3, 1]):
        p = np.exp(model.log_probabilities(np.array([context] * SMALL.symbols), symbols))
        assert p.sum() == pytest.approx(1, abs=1e-5)
    # words of a group and the one share kept for words never seen
    counts = Counter(w for t in TEXTS * 5 for w in [*words(t), b""])
    head = set(sorted((w for w in counts if w), key=lambda w: (-counts[w], w))[: SMALL.symbols - SMALL.groups - 1])
    for g in range(SMALL.groups):
        rare = [counts[w] + 1 for w in counts if w and w not in head and group_of(w, SMALL.groups) == g]
        assert 10 ** lex.group_total[g] == pytest.approx(sum(rare) + 1)


def test_learns_what_follows_what(spark):
    texts = ["a b c d e f g h " * 40, "h g f e d c b a " * 40] * 12
    opts = BilinearOptions(side=4, groups=4, dim=8, noise=6, batch=128, first=2)
    got = _score(spark, texts, opts)
    held = [r for i, r in got.items() if i % 4 == 3]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def _tiny():
    o = BilinearOptions(side=4, groups=4, dim=3, noise=3, context=2)
    n = np.arange(16, 0, -1.0) * 5
    lex = Lexicon({b"": 0}, np.arange(16), n, np.zeros(16), np.zeros(4), n, 1, 1, o)
    rng, m = np.random.default_rng(3), Model(lex)
    m.load(m.flat() + rng.normal(0, 0.5, m.flat().size))
    return m, rng.integers(0, 16, (40, 2)), rng.integers(0, 16, 40)


def _plain(m, context, symbol, normalised):
    """Class and symbol scores of one token, written out."""
    q = sum(m.turn[i].T.astype(float) @ m.vec[c].astype(float) for i, c in enumerate(context))
    c, k = symbol % 4, symbol // 4
    s, t = m.cls.astype(float) @ q + m.cls_b, m.out[c].astype(float) @ q + m.out_b[c]
    return math.log(math.exp(s[c]) / np.exp(s).sum() * math.exp(t[k]) / np.exp(t).sum()) if normalised else (q, s, t, c, k)


def test_probabilities_by_definition():
    m, context, symbol = _tiny()
    got = Scorer(m).log_probabilities(context, symbol)
    assert np.allclose(got, [_plain(m, c, s, True) for c, s in zip(context, symbol)], atol=1e-5)
    m.cls_b[1] += 200  # out of float32's range
    got = Scorer(m).log_probabilities(context, symbol)
    assert np.allclose(got, [_plain(m, c, s, True) for c, s in zip(context, symbol)], rtol=1e-5, atol=1e-4)


def test_gradients_are_those_of_the_contrastive_loss(monkeypatch):
    m, context, symbol = _tiny()
    noise_cls, noise_out = np.array([[0, 2, 2]]), np.random.default_rng(1).integers(0, 4, (4, 3))
    monkeypatch.setattr(log_bilinear, "_draw", lambda probs, rng, k: (noise_cls if len(probs) == 1 else noise_out).copy())
    found = {}

    def step(self, name, at, grad):
        found.setdefault(name, np.zeros_like(getattr(m, name), dtype=float))
        found[name][at] += grad

    monkeypatch.setattr(Trainer, "_step", step)
    Trainer(m).learn(context, symbol)

    def loss():
        total, sig = 0.0, lambda x: 1 / (1 + math.exp(-x))
        for x, y in zip(context, symbol):
            _, s, t, c, k = _plain(m, x, y, False)
            total -= math.log(sig(s[c] - math.log(3 * m.p_cls[c]))) + math.log(sig(t[k] - math.log(3 * m.p_out[c, k])))
            total -= sum(math.log(1 - sig(s[j] - math.log(3 * m.p_cls[j]))) for j in noise_cls[0])
            total -= sum(math.log(1 - sig(t[j] - math.log(3 * m.p_out[c, j]))) for j in noise_out[c])
        return total / len(symbol)

    rng = np.random.default_rng(5)
    for name in Model.NAMES:
        kept = getattr(m, name).astype(np.float64)
        for _ in range(6):
            at, ends = tuple(rng.integers(0, d) for d in kept.shape), []
            for eps in (1e-4, -1e-4):
                moved = kept.copy()
                moved[at] += eps
                setattr(m, name, moved)
                ends.append(loss())
            setattr(m, name, kept)
            assert found[name][at] == pytest.approx((ends[0] - ends[1]) / 2e-4, rel=2e-3, abs=2e-5), (name, at)


def test_what_is_learnt_does_not_depend_on_the_input_parts(spark):
    """The same rows from one part and from eight, in another order."""
    rng = np.random.default_rng(8)
    follow = {i: rng.choice(40, 3) for i in range(40)}
    texts = []
    for _ in range(160):
        w = [int(rng.integers(40))]
        for _ in range(60):
            w.append(int(rng.choice(follow[w[-1]])))
        texts.append(" ".join(f"w{i}" for i in w))
    rows = [(i, t, i % 7 == 2) for i, t in enumerate(texts)]
    opts = BilinearOptions(side=8, groups=8, dim=8, noise=6, batch=128, first=4, part_tokens=3000)
    scores = []
    for rows_, parts in ((rows, 1), (rows[::-1], 8)):
        df = spark.createDataFrame(rows_, "doc_id long, text string, held_out boolean").repartition(parts)
        got = sorted(score_texts(df, opts).collect(), key=lambda r: r.doc_id)
        assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out) + 20
        scores.append([r.score for r in got])
    assert np.allclose(*scores, rtol=1e-4)


def test_edges(spark):
    assert _score(spark, []) == {}
    got = _score(spark, ["x y", None], held=lambda i: True)  # nothing to learn from
    assert got[0].train_tokens == 0 and got[0].n_known == 0 and got[1].n_tokens == 1
    assert math.isfinite(got[0].score) and math.isfinite(got[0].base_score)
    long = _score(spark, ["word other " * 60_000, "word"])
    assert long[0].n_tokens == 120_001


def test_windows_begin_with_ends():
    context, symbol = windows([np.array([5, 0]), np.array([0]), np.array([7, 8, 0])], 2)
    assert symbol.tolist() == [5, 0, 0, 7, 8, 0]
    assert context.tolist() == [[0, 0], [5, 0], [0, 0], [0, 0], [7, 0], [8, 7]]
    assert Lexicon  # the tasks' view of the counts
