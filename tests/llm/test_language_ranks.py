from collections import Counter

from txengine.llm.language_ranks import Packer, RankOptions, identify, learn

TEXTS = [
    ("en", "the cat and the dog sat on the mat, and then the cat ran"),
    ("en", "that is the thing with the other one there"),
    ("de", "der hund und die katze sind auf der matte; über die straße"),
    ("de", "das ist nicht die sache, die ich meine"),
]


def _plain(text, n):
    """n-grams by the definition, most frequent first."""
    words, now = [], ""
    for c in text.lower() + " ":
        if c.isalpha():
            now += c
        elif now:
            words.append(f" {now} ")
            now = ""
    c = Counter()
    for w in words:
        for k in (1, 2, 3):
            c.update(g for i in range(len(w) - k + 1) if (g := w[i : i + k]) != " ")
    return [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], [ord(y) for y in x[0].ljust(3, chr(0))]))][:n]


def test_against_plain_lists(spark):
    opts = RankOptions(size=40)
    docs = spark.createDataFrame(TEXTS, "lang string, text string")
    model = learn(docs, opts)
    profile = {k: _plain("\n".join(t for x, t in TEXTS if x == k), 40) for k in ("de", "en")}
    for text in ["the hat", "die matte", "cat katze", "a", "Über-Straße 123", "ⅷ the"]:
        own = _plain(text, 40)
        far = {k: sum(abs(p.index(g) - i) if g in p else 40 for i, g in enumerate(own)) for k, p in profile.items()}
        best = min(far, key=lambda k: (far[k], k))
        got = model.predict(*Packer(opts).counts(text))
        assert got == (best, 1 - far[best] / (40 * len(own)))


def test_defined_results(spark):
    model = learn(spark.createDataFrame(TEXTS, "lang string, text string"))
    rows = [(1, None), (2, ""), (3, "12 34 !?"), (4, "the the the"), (None, "die die"), (4, "the the the"), (5, "der hund " * 40_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as score", "1 as lang_pred")
    got = identify(df, model, "doc_id").collect()
    assert [r.lang_pred for r in got] == ["und", "und", "und", "en", "de", "en", "de"]
    assert all(0 <= r.score <= 1 for r in got) and got[0].score == 0
    nothing = learn(spark.createDataFrame([(None, "x"), ("en", None), ("en", "12")], "lang string, text string"))
    assert nothing is None
    assert {r.lang_pred for r in identify(df, None, "doc_id").collect()} == {"und"}
    assert identify(df.limit(0), model, "doc_id").count() == 0


def test_long_texts_are_read_in_parts():
    text = "ab cd efg " * 50
    one, parts = Packer(RankOptions()).counts(text), Packer(RankOptions(held=7)).counts(text)
    assert one[0].tolist() == parts[0].tolist() and one[1].tolist() == parts[1].tolist()
