import random

from txengine.llm.edit_pieces import EditOptions, keep_unseen, matches, myers, normalised, pieces


def _best(item, window):
    """Smallest distance of the whole item to any part of the window, by the full table."""
    col, best = list(range(len(item) + 1)), len(item)
    for c in window:
        new = [0]
        for i, x in enumerate(item):
            new.append(min(col[i + 1] + 1, new[-1] + 1, col[i] + (x != c)))
        col = new
        best = min(best, col[-1])
    return best


def test_myers_equals_the_table():
    rng = random.Random(1)
    for _ in range(300):
        item = "".join(rng.choice("ab c") for _ in range(rng.randint(1, 70)))
        window = "".join(rng.choice("ab c") for _ in range(rng.randint(1, 60)))
        k, want = rng.randint(0, 40), _best(item, window)
        got = myers(item, window, k)
        assert (got is None) == (want > k) and (got is None or got[0] == want or want == len(item))


def test_pieces_make_up_the_item():
    for n, k in ((10, 0), (81, 4), (300, 15)):
        item = "x" * n
        assert len(pieces(item, k)) == k + 1 and "".join(p for _, p in pieces(item, k)) == item


def test_search_equals_brute_force(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(rng.randint(6, 30)))) for i in range(8)] + [(50, None), (51, ""), (52, "...")]
    items.append((60, items[0][1].upper() + "!"))  # the same item once more
    docs = []
    for d in range(60):
        w = [word() for _ in range(rng.randint(0, 60))]
        if d % 2:
            t = list(items[rng.randrange(8)][1])
            for _ in range(rng.randint(0, 9)):
                at = rng.randrange(len(t))
                t[at] = rng.choice(["", "z", t[at] + "q"])
            w.insert(rng.randint(0, len(w)), "".join(t))
        docs.append((d, "  ".join(w).title()))
    docs += [(100, None), (101, ""), (102, "abc " * 60_000), (1, docs[1][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "0 as item_id")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for opts in (EditOptions(), EditOptions(chars_per_edit=12, block_chars=200)):
        got = sorted((r.doc_id, r.item_id, r.distance) for r in matches(df, bench, opts).collect())
        want = []
        for d, t in docs[:60] + docs[63:]:
            for i, it in items:
                norm = normalised(it)
                if norm and (dist := _best(norm, normalised(t))) <= opts.budget(norm):
                    want.append((d, i, dist))
        assert got == sorted(want) and want
    held = {d for d, _, _ in want}
    left = keep_unseen(df, bench, EditOptions(chars_per_edit=12, block_chars=200))
    assert left.schema == df.schema
    assert sorted(r.doc_id for r in left.collect()) == sorted(d for d, _ in docs if d not in held)


def test_place_and_empty_tables(spark):
    bench = spark.createDataFrame([(7, "the quick brown fox jumps over the lazy dog today")], "item_id long, text string")
    df = spark.createDataFrame([(1, "So: The quick brown fox jumps over the lazy dog, today. End")], "doc_id long, text string")
    r = matches(df, bench).first()
    assert (r.doc_id, r.item_id, r.distance, r.first_word, r.last_word) == (1, 7, 0, 1, 10)
    assert matches(df, bench.limit(0)).count() == 0 and matches(df.limit(0), bench).count() == 0
    assert keep_unseen(df, bench.limit(0)).count() == 1


def test_items_without_an_id_and_blocks(spark):
    """They are searched too; blocks are searched one after another."""
    texts = ["the quick brown fox jumps over the lazy dog today", "pack my box with five dozen liquor jugs by noon", "sphinx of black quartz judge my solemn vow at once"]
    bench = spark.createDataFrame([(None, texts[0]), (2, texts[1]), (None, texts[2]), (4, None)], "item_id long, text string")
    docs = [(i, f"before {t} after") for i, t in enumerate(texts)] + [(9, "nothing of the kind")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for opts in (EditOptions(), EditOptions(block_chars=60)):
        got = sorted((r.doc_id, r.item_id) for r in matches(df, bench, opts).collect())
        assert got == [(0, None), (1, 2), (2, None)]
        assert [r.doc_id for r in keep_unseen(df, bench, opts).collect()] == [9]
