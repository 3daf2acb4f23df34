import re
from collections import Counter

from txengine.llm.quality_votes import COUNTS, judge, keep_good

PROSE = "It is a day for us to go out and be in the sun. We may eat by the sea, or so I am told by an old man of the sea. "
TEXTS = [
    None, "", " \t\n ", "one", "a a a a", "a b c a b c", "a b c d a b c", "x\nx\n\nx\n y", "#tag $1 | <b>", "naïve café 12 -- .",
    "a b a b a b a b a", PROSE * 3, "word " * 200, "a | b | c | d | e | f | g " * 30, "qq%%% rr### ss*** tt$$$ " * 40, "ab cd ef\n" * 50,
    "p q r s t u v w x y z " + PROSE * 200,
]


def _plain(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    wins = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i, x in enumerate(zip(w, w[1:], w[2:])) if wins[x] > 1 for k in range(3)}
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
        "n_unlettered": sum(not any(c.isalpha() for c in x) for x in w), "n_stops": sum(len(x) <= 3 for x in w),
        "n_ends": sum(x[-1] in ".!?" for x in w),
    }


def test_counts_by_definition(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").selectExpr("*", "'x' as q", "1 as n_words")
    got = {r.doc_id: r.asDict() for r in judge(df).collect()}
    for i, t in enumerate(TEXTS):
        want = _plain(t)
        assert {k: got[i][k] for k in COUNTS} == want, t
        failed = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
        assert got[i]["base_failed"] == failed and not (failed and got[i]["kept"])


def test_votes_find_the_junk_without_labels(spark):
    rows = [(i, f"{PROSE} on {i} we go to {i * 7} by bus. {PROSE.upper()}") for i in range(60)]
    rows += [(100 + i, " ".join(f"w{i}x{j}yyyy%%% z{j}qqqq###" for j in range(40))) for i in range(10)]
    out = {r.doc_id: r for r in judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(out[i].kept for i in range(60)) and not any(out[100 + i].kept for i in range(10))
    assert out[0].p_good > 0.9 > 0.1 > out[100].p_good


def test_stage_carries_columns_and_rows(spark):
    text = PROSE + PROSE.upper() + PROSE.title()  # windows are compared as they are written
    rows = [(1, text, "a"), (1, text, "a"), (None, text, None), (2, None, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, q string")
    kept = keep_good(df)
    assert kept.dtypes == df.dtypes
    assert sorted((str(r.doc_id), r.q) for r in kept.collect()) == [("1", "a"), ("1", "a"), ("None", None)]
    assert keep_good(df.limit(0)).count() == 0 and judge(df.limit(0)).count() == 0


def test_stage_keeps_clean_short_texts(spark):
    """Under 50 words, or repeated, is no verdict of its own: the posterior decides."""
    rows = [(i, f"{PROSE} on {i} we go to {i * 7} by bus.") for i in range(60)]
    rows += [(100 + i, " ".join(f"w{i}x{j}yyyy%%% z{j}qqqq###" for j in range(40))) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = judge(df).collect()
    assert all(r.base_failed and r.n_words < 50 for r in out if r.doc_id < 100)
    assert {r.doc_id for r in keep_good(df).collect()} == set(range(60)) == {r.doc_id for r in out if r.kept}
