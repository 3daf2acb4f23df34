import random

import numpy as np
import pytest

from txengine.llm.bin_sketch import Sketcher, SketchOptions, keep_one, link_components
from txengine.llm.components import components


def _sets(texts, k=2):
    out = []
    for t in texts:
        w = t.encode().lower().split() if t else []
        n = min(k, len(w))
        out.append(frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset())
    return out


def _brute(ids, texts, k=2):
    sets, root = _sets(texts, k), {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(ids[a]), find(ids[b])
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in zip(ids, sets)}


def _noisy(rng, words, rate):
    return [rng.choice(["zz", "yy"]) + str(rng.randrange(999)) if rng.random() < rate else w for w in words]


@pytest.mark.parametrize("opts", [SketchOptions(), SketchOptions(direct=0, small=1, cell=3), SketchOptions(shingle=5)])
def test_components_equal_brute_force(spark, opts):
    """Copies, copies of copies and a star of copies that are close to the first only."""
    rng, texts = random.Random(5), []
    for g in range(4):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([12, 60, 90]))]
        texts += [" ".join(base)] * 2
        texts += [" ".join(_noisy(rng, base, rng.choice([0.01, 0.04, 0.06, 0.1]))) for _ in range(18)]
        last = base
        for _ in range(4):
            last = _noisy(rng, last, 0.03)
            texts.append(" ".join(last).upper())
    texts += [" ".join(f"w{rng.randrange(400)}" for _ in range(30)) for _ in range(10)]
    texts += ["", None, "one", "ONE", " one ", "two words", "words two", "  \t\n"]
    ids = list(range(1000, 1000 + len(texts)))
    rng.shuffle(ids)
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").selectExpr("*", "1 as component_id")
    got = {r.doc_id: r for r in link_components(df.repartition(7), opts).collect()}
    for i, want in _brute(ids, texts, opts.shingle).items():
        assert (got[i].n_shingles, got[i].component_id) == want
        assert got[i].kept == (want[1] == i)


def test_bridges_behind_one_prefix(spark):
    """One key holds 26 sets around a hub of 100 words. The bridges share words that are common
    where their own words are rare: they stand in one member's prefix and behind the other's."""
    opts = SketchOptions(shingle=1, bins=2, band=2)
    sk = Sketcher(opts)
    hub = [f"h{i}" for i in range(100)]
    key = sk.keys(sk.shingles(" ".join(hub)))[0]
    # a word that leaves the hub's key as it is leaves it so in any union
    fit = (w for w in (f"w{i}" for i in range(100_000)) if sk.keys(sk.shingles(" ".join([*hub, w])))[0] == key)

    def new(n):
        return [next(fit) for _ in range(n)]

    near_far, far_far = new(12), new(19)
    sets = [hub, *(hub + new(1) for _ in range(20))]
    sets += [hub + near_far + new(13), hub + near_far + new(14)]  # linked with the hub, just not
    sets += [hub + far_far + new(7), hub + far_far + new(21)]  # neither is linked with the hub
    sets += [hub + new(60)]
    texts = [" ".join(s) for s in sets]
    assert {sk.keys(sk.shingles(t))[0] for t in texts} == {key}
    ids = list(range(1, len(texts) + 1))
    want = _brute(ids, texts, 1)
    assert [want[i][1] for i in ids[21:]] == [1, 1, 24, 24, 26]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in link_components(df, opts).collect()}
    assert got == want


def test_a_large_group_is_joined_once_for_what_it_shares(spark, monkeypatch):
    """A few hundred copies with noise of their own and a few inserted passages, in one key: the
    rows that the join of difference keys makes stay far below the square of the group."""
    from txengine.llm import bin_sketch

    rng, made = random.Random(11), []
    base = [f"h{i}" for i in range(120)]
    inserted = [[f"p{k}x{i}" for i in range(9)] for k in range(3)]
    texts = []
    for k in range(400):
        w = _noisy(rng, base, rng.choice([0.01, 0.04, 0.08, 0.12]))
        if k % 3 == 0:
            at = rng.randrange(100)
            w = w[:at] + inserted[k % 9 // 3] + w[at:]
        texts.append(" ".join(w))
    plain = bin_sketch._may_meet
    monkeypatch.setattr(bin_sketch, "_may_meet", lambda *a: made.append(plain(*a)) or made[-1])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    # few bins and short bands: all copies share keys
    got = {r.doc_id: r.component_id for r in link_components(df, SketchOptions(bins=8, band=1)).collect()}
    assert got == {i: c for i, (_, c) in _brute(range(400), texts).items()}
    assert made and sum(m.count() for m in made) < 20 * 400


def test_defined_results(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "A b c d"), (None, "a b c d"), (3, None), (3, ""), (4, "x " * 200_000), (5, "x x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in link_components(df).collect()), key=str)
    assert (1, 3, 1, True) in got and (2, 3, 1, False) in got and (None, 3, None, True) in got
    assert (3, 0, 3, True) in got and (4, 1, 4, True) in got and (5, 1, 4, False) in got
    left = keep_one(df).collect()
    assert sorted(str(r.doc_id) for r in left) == ["1", "3", "4", "None"]
    assert link_components(df.limit(0)).count() == 0 and keep_one(df.limit(0)).count() == 0
    two = spark.createDataFrame([(1, "a b c"), (1, "q r s"), (2, "a b c"), (3, "q r s")], "doc_id long, text string")
    assert sorted(r.text for r in keep_one(two).collect()) in (["a b c", "q r s"], ["a b c", "q r s", "q r s"], ["a b c", "a b c", "q r s"])
    wide = two.unionByName(two).selectExpr("doc_id", "text", "doc_id as `__id`", "1 as `__own2`", "2 as component_id")
    assert {r.text for r in keep_one(wide.drop("__id")).collect()} == {"a b c", "q r s"}
    comps = {r.doc_id: r.component_id for r in link_components(two).collect()}
    assert comps[1] == 1 and (comps[2] == 1) != (comps[3] == 1)  # one of its texts stands for id 1


def test_sketch_estimates_similarity_and_fills_every_bin():
    sk, rng = Sketcher(SketchOptions()), np.random.default_rng(1)
    for size in (1, 3, 50, 500):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        assert (sk.sketch(a) == sk.sketch(a[::-1].copy())).all()
        assert len(sk.keys(a)) == 42
    same = []
    for _ in range(60):
        x = rng.integers(0, 2**63, 300).astype(np.uint64)
        same.append((sk.sketch(x[:250]) == sk.sketch(x[50:])).mean())
    assert abs(np.mean(same) - 200 / 300) < 0.02


def test_component_closure(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 140), rng.randrange(100, 140)) for _ in range(30)]
    root = {x: x for e in links for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
