import hashlib
import random
import zlib

import numpy as np
import pytest

from txengine.llm.euler_tour import jump_to_end, prefix_trie, rank_block

COLS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _digest(role, text):
    role, text = (x.encode() for x in (role, text))
    return hashlib.md5(str(len(role)).encode() + b":" + role + text).digest()


def _brute(rows):
    """The trie as a dictionary from sequences of turns to their members."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, _digest(role or "", text or ""), role or "", text or ""))
    convs = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in convs.items()}
    nodes, ends = {}, {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        home = c - int(np.fmod(c, 20))
        path = tuple(convs.get(home, [])[:h] + own[h:])
        ends.setdefault(path, []).append(c)
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    children, leaves, saved = {}, {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        own = (len(nodes[p]) - 1) * len(p[-1][1].encode().split()) if p else 0
        leaves[p] = leaves.get(p, 0) + (p not in children)
        saved[p] = saved.get(p, 0) + own
        if p:
            up = p[:-1]
            children[up] = children.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[p]
            saved[up] = saved.get(up, 0) + saved[p]
    return {
        (min(m), len(p)): (
            min(nodes[p[:-1]]) if p else None, len(m), children.get(p, 0), leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest(),
        )
        for p, m in nodes.items()
    }


def _rows(rng, n, words):
    rows = []
    for c in rng.sample(range(-30, 4 * n), n):
        for t in range(rng.choice([0, 1, 2, 3, 5, 9])):
            turn = rng.choice([t, t, t, None, 1])
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice([None, "", " ".join(rng.choices(words, k=rng.randrange(1, 3)))])))
    return rows


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield spark
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def _check(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as depth", "2 as chunk", "'x' as key")
    got = prefix_trie(df.repartition(5)).collect()
    want = _brute(rows)
    assert len(got) == len(want)
    for r in got:
        assert tuple(r[c] for c in COLS[2:]) == want[r.conv_id, r.depth], r
    # the tour: both arcs of every node, each at its own place, a subtree's within its top's
    places = sorted(x for r in got for x in (r.enter_left, r.exit_left))
    assert places == list(range(1, 2 * len(got) + 1))
    at = {(r.conv_id, r.depth): (r.enter_left, r.exit_left) for r in got}
    for r in got:
        if r.depth:
            (a, b), (c, d) = at[r.parent_conv_id, r.depth - 1], at[r.conv_id, r.depth]
            assert a > c > d > b


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(small_blocks, seed):
    rng = random.Random(seed)
    _check(small_blocks, _rows(rng, 90, ["a", "b", "a b"]))


def test_one_long_one_shared_and_many_equal(small_blocks):
    """A conversation of a third of all rows, many copies of another, one first turn for all."""
    rng = random.Random(9)
    rows = [(61, t, "user", f"turn {t}") for t in range(300)]
    rows += [(c, t, "user", ["hello there", "same", "copies", "all"][t]) for c in range(200, 300) for t in range(4)]
    rows += [(c, t, "user", "hello there" if t == 0 else rng.choice("xyz")) for c in range(400, 470) for t in range(5)]
    _check(small_blocks, rows)


def test_rows_that_repeat_and_empty_tables(spark):
    rows = [(1, 1, "user", "a b")] * 5 + [(None, 1, "user", "a")] * 2 + [(20, None, None, None), (3, 7, "user", "x " * 100_000)]
    _check(spark, rows)
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie(empty).count() == 0
    assert prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], empty.schema)).count() == 0


def test_list_ranking_of_a_random_list(spark):
    order = list(range(500))
    random.Random(4).shuffle(order)
    weight = {x: (1, x % 3, x) for x in order}
    rows = [(x, 0, y, None if y is None else 0, *weight[x]) for x, y in zip(order, [*order[1:], None])]
    df = spark.createDataFrame(rows, "conv long, arc long, next_conv long, next_arc long, steps long, leaves long, saved long")
    total, want = [0, 0, 0], {}
    for x in reversed(order):
        total = [a + b for a, b in zip(total, weight[x])]
        want[x] = tuple(total)
    assert {r.conv: (r.steps, r.leaves, r.saved) for r in jump_to_end(df).collect()} == want


def test_block_of_one_path():
    """root - a - b, all in one block: one way through, the tour ends in it."""
    node = {
        "conv_id": np.array([5, 5, 5]), "depth": np.array([0, 1, 2]), "parent_conv_id": np.array([0, 5, 5]),
        "n_children": np.array([1, 1, 0]), "first_child": np.array([5, 5, 0]), "next_sibling": np.array([0, 0, 0]),
        "has_next": np.array([False] * 3), "own": np.array([0, 7, 4]),
    }
    x = rank_block(node)
    assert x["steps"].tolist() == [6, 1, 5, 2, 4, 3]
    assert x["saved"].tolist() == [11, 0, 11, 0, 4, 0] and x["leaves"].tolist() == [1, 0, 1, 0, 1, 0]
    assert x["head"].tolist() == [True] + [False] * 5 and x["ends"].all()
