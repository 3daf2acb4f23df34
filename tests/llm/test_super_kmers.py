import hashlib
import random

import numpy as np
import pytest

from txengine.llm.super_kmers import WINDOW, WindowOptions, first_of_windows, minimisers, without_repeats


def _brute(rows):
    split = [(i, t.encode().split() if t else []) for i, t in rows]
    first = {}
    for i, w in split:
        if i is not None:
            for s in range(len(w) - WINDOW + 1):
                k = tuple(w[s : s + WINDOW])
                first[k] = min(first.get(k, i), i)
    out = []
    for i, w in split:
        gone = set()
        if i is not None:
            for s in range(len(w) - WINDOW + 1):
                if first[tuple(w[s : s + WINDOW])] < i:
                    gone |= set(range(s, s + WINDOW))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return sorted(out, key=str)


def _texts(rng, n):
    passages = [[f"p{k}w{rng.randrange(50)}" for _ in range(rng.choice([13, 14, 25, 60]))] for k in range(6)]
    out = []
    for _ in range(n):
        t = []
        for _ in range(rng.randrange(0, 5)):
            t += rng.choice([*passages, ["the"] * rng.randrange(1, 40), [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 30))]])
        out.append(rng.choice([" ", "\n", "  \t"]).join(t))
    return out


def _check(spark, rows, opts=WindowOptions()):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as fp", "2 as block", "'x' as kept")
    got = without_repeats(df.repartition(4), opts)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == _brute(rows)


@pytest.mark.parametrize(
    "opts", [WindowOptions(), WindowOptions(mer=1, block=60, buckets=1), WindowOptions(mer=13, longest=3, buckets=5, held=10)]
)
def test_equals_brute_force(spark, opts):
    rng = random.Random(8)
    rows = list(zip(rng.sample(range(-50, 400), 120), _texts(rng, 120)))
    _check(spark, rows, opts)


def test_defined_results(spark):
    a, b = " ".join(f"a{i}" for i in range(20)), " ".join(f"b{i}" for i in range(13))
    long = " ".join(f"l{i % 977}" for i in range(120_000))
    rows = [(1, a), (1, a), (1, b), (2, a + "\x0b" + b), (None, a), (None, a), (3, None), (4, ""), (5, " \n "), (6, a[:-2]), (7, "x " * 50_000), (8, "x " * 30), (9, long), (10, "z " + long), (11, A_WORDS)]
    _check(spark, rows)
    assert without_repeats(spark.createDataFrame(rows[:1], "doc_id long, text string").limit(0)).count() == 0


A_WORDS = "A0 a1 A2 " + " ".join(f"a{i}" for i in range(20))  # words are compared as they are


def test_a_passage_in_a_third_of_all_documents(spark):
    rng = random.Random(1)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(600):
        own = [f"w{rng.randrange(10**6)}" for _ in range(20)]
        rows.append((i, " ".join(own[:10] + (passage if i % 3 == 1 else []) + own[10:])))
    _check(spark, rows, WindowOptions(block=500))


def test_equal_windows_have_equal_minimisers():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 2**63, 40).astype(np.uint64)
    for mer in (1, 3, 4, 13):
        m = minimisers(h, mer)
        assert len(m) == 28
        for s in range(28):
            assert minimisers(h[s : s + WINDOW].copy(), mer).tolist() == [m[s]]


def test_windows_are_counted_by_their_words():
    a, b = [f"w{i}".encode() for i in range(15)], [f"w{i}".encode() for i in range(2, 17)]
    got = first_of_windows([b" ".join(a), b" ".join(b)], np.array([9, 4]))
    assert [x.tolist() for x in got] == [[9, 9, 4], [4, 4, 4]]
