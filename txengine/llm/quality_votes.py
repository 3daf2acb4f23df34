"""Quality by weak supervision: rules vote, their accuracies are estimated, and the posterior
decides.

Each rule looks at counts of one text and votes good (1) or bad (-1) or abstains (0); a rule
for a defect abstains where it sees none, since the lack of one defect says little about the
others. Nobody says which rule is right: expectation-maximisation over the votes of all
documents estimates the share of good texts and, for each rule, how often it speaks up on
good and on bad texts -- its accuracy on either. Each document gets the posterior probability
of being good, which weighs all votes and abstentions together instead of asking that every
rule be passed.

Only built-in expressions run: the counts come from array functions inside one row, the
documents meet once, as counts per vote pattern (at most 3^9 rows, whatever the corpus), and
every round of the estimation is one aggregate over that table.

Defined results: NULL and empty texts have no words, all counts 0. Repeated rows are judged
(and counted) each. With no documents the start values stay. Extra columns are ignored by
:func:`judge` and carried by :func:`keep_good`. Windows of three words are compared by
64-bit hashes within one text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txengine.llm.common import SPACE_CLASS, table, written

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Words without any letter.
NO_LETTER_WORD = r"(?<![^\x20\x09-\x0D])[^\p{L}\x20\x09-\x0D]+(?![^\x20\x09-\x0D])"

SENTENCE_END = r"[.!?](?=[\x20\x09-\x0D]|\z)"

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_unlettered", "n_stops", "n_ends",
)

#: Rule name -> (SQL over the counts in whole numbers, vote where it holds).
RULES = {
    "short": ("n_words < 20", -1),
    "symbols": ("100 * n_symbols > 6 * word_chars", -1),
    "unlettered": ("100 * n_unlettered > 15 * n_words", -1),
    "dup_lines": ("n_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines", -1),
    "repeats": ("100 * n_repeat_words > 25 * n_words", -1),
    "few_stops": ("n_words >= 20 AND 100 * n_stops < 8 * n_words", -1),
    "word_length": ("word_chars > 12 * n_words OR word_chars < 2 * n_words", -1),
    "prose": (
        "n_words >= 20 AND 100 * n_stops BETWEEN 15 * n_words AND 60 * n_words"
        " AND 100 * n_unlettered <= 5 * n_words",
        1,
    ),
    "sentences": ("n_words >= 20 AND 100 * n_ends BETWEEN 2 * n_words AND 40 * n_words", 1),
}


def vote_sql(rule: str) -> str:
    holds, vote = RULES[rule]
    return f"CASE WHEN {holds} THEN {vote} ELSE 0 END"


BASE_FAILED = "(n_words < 50 OR 100 * n_repeat_words > 50 * n_words)"


@dataclass(frozen=True)
class VoteOptions:
    """``rounds`` of the estimation; ``threshold`` of the posterior; ``good``: first share of
    good texts; ``against`` and ``for_``: for rules that vote bad or good, the first chance of
    speaking up on a (good, bad) text. Estimates stay within the bounds, so that no rule is
    turned round, made infallible, or decides by never being heard."""

    rounds: int = 10
    threshold: float = 0.5
    good: float = 0.8
    good_bounds: tuple[float, float] = (0.05, 0.95)
    against: tuple[float, float] = (0.02, 0.3)
    against_bounds: tuple[tuple[float, float], ...] = ((0.001, 0.09), (0.1, 0.95))
    for_: tuple[float, float] = (0.9, 0.4)
    for_bounds: tuple[tuple[float, float], ...] = ((0.5, 0.99), (0.05, 0.49))

    def start(self, rule: str, bad: int) -> float:
        return (self.for_ if RULES[rule][1] > 0 else self.against)[bad]

    def bounds(self, rule: str, bad: int) -> tuple[float, float]:
        return (self.for_bounds if RULES[rule][1] > 0 else self.against_bounds)[bad]


# --------------------------------------------------------------------------- counts
def _windows(words: Column) -> Column:
    """(hash, place) of every three-word window, sorted."""
    m = F.greatest(F.size(words) - 2, F.lit(0))
    pair = F.zip_with(F.slice(words, 1, m), F.slice(words, 2, m), lambda a, b: F.xxhash64(a, b))
    window = F.zip_with(pair, F.slice(words, 3, m), lambda p, c: F.xxhash64(p, c))
    return F.sort_array(F.transform(window, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))


def _repeated_at(ranked: Column) -> Column:
    """Places, ascending, of the windows that occur twice or more."""
    pairs = F.zip_with(
        ranked,
        F.slice(ranked, 2, F.greatest(F.size(ranked), F.lit(1))),
        lambda p, q: F.when(p["h"] == q["h"], F.array(p["i"], q["i"])),
    )
    return F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))


def _covered_words(at: Column) -> Column:
    """Words under three-word windows at these places, overlaps counted once."""
    step = F.zip_with(at, F.slice(at, 2, F.greatest(F.size(at), F.lit(1))), lambda p, q: F.least(F.coalesce(q - p, F.lit(3)), F.lit(3)))
    return F.aggregate(step, F.lit(0).cast("bigint"), lambda s, x: s + x)


def with_counts(docs: DataFrame, out: str) -> DataFrame:
    """``docs`` with a struct column ``out`` of :data:`COUNTS` (long) for its ``text``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = F.btrim(text, F.lit(SPACES))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_CLASS))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    # Generate keeps the planner from folding the arrays into each expression that uses them
    with_arrays = docs.withColumn(out, F.explode(F.array(F.struct(words.alias("w"), lines.alias("l")))))
    ws, ls = F.col(out)["w"], F.col(out)["l"]
    n_stops = F.size(F.filter(ws, lambda x: F.length(x) <= 3))
    counts = F.struct(
        *(c.cast("bigint").alias(n) for n, c in {
            "n_words": F.size(ws),
            "word_chars": F.length(F.regexp_replace(text, SPACE_CLASS, "")),
            "n_symbols": F.length(text) - F.length(F.translate(text, SYMBOLS, "")),
            "n_dup_lines": F.size(ls) - F.size(F.array_distinct(ls)),
            "n_lines": F.size(ls),
            "n_unlettered": F.regexp_count(text, F.lit(NO_LETTER_WORD)),
            "n_stops": n_stops,
            "n_ends": F.regexp_count(text, F.lit(SENTENCE_END)),
        }.items()),
        _windows(ws).alias("windows"),
    )
    ranked = with_arrays.withColumn(out, F.explode(F.array(counts)))
    s = F.col(out)
    places = F.struct(
        *(s[n].alias(n) for n in COUNTS if n != "n_repeat_words"),
        _repeated_at(s["windows"]).alias("at"),
    )
    return ranked.withColumn(out, F.explode(F.array(places))).withColumn(
        out,
        F.struct(
            *(
                (_covered_words(s["at"]) if n == "n_repeat_words" else s[n]).alias(n)
                for n in COUNTS
            )
        ),
    )


def with_votes(counted: DataFrame, at: str) -> DataFrame:
    """The struct ``at`` widened by one vote per rule (``v_<rule>``)."""
    s = F.col(at)
    # the rules name bare counts; inside the struct they are fields
    votes = {f"v_{k}": F.expr(_in_struct(vote_sql(k), at)).cast("int") for k in RULES}
    return counted.withColumn(
        at, F.struct(*(s[n].alias(n) for n in COUNTS), *(c.alias(k) for k, c in votes.items()))
    )


def _in_struct(sql: str, at: str) -> str:
    for n in COUNTS:
        sql = sql.replace(n, f"`{at}`.{n}")
    return sql


# ----------------------------------------------------------------------- estimation
@dataclass(frozen=True)
class Accuracies:
    """Share of good texts, and per rule the chance that it speaks up on a good and on a bad
    text."""

    good: float
    on_good: dict[str, float]
    on_bad: dict[str, float]

    def posterior(self, prefix: str = "") -> Column:
        odds = f"ln({self.good!r}D) - ln({1 - self.good!r}D)"
        for k in RULES:
            g, b = self.on_good[k], self.on_bad[k]
            odds += (
                f" + CASE WHEN {prefix}v_{k} <> 0 THEN ln({g!r}D) - ln({b!r}D)"
                f" ELSE ln({1 - g!r}D) - ln({1 - b!r}D) END"
            )
        return 1 / (1 + F.exp(-F.expr(odds)))


def estimate(patterns: DataFrame, opts: VoteOptions = VoteOptions()) -> Accuracies:
    """Expectation-maximisation over (v_<rule>..., n); ``rounds`` aggregates of a table whose
    size is bounded by the number of vote patterns."""

    def within(x: float, bounds: tuple[float, float]) -> float:
        return min(max(x, bounds[0]), bounds[1])

    now = Accuracies(opts.good, *({k: opts.start(k, bad) for k in RULES} for bad in (0, 1)))
    for _ in range(opts.rounds):
        good = F.col("n") * F.col("p")
        sums = [F.sum(good).alias("good"), F.sum("n").alias("all")]
        for k in RULES:
            spoke = F.col(f"v_{k}") != 0
            sums += [
                F.sum(F.when(spoke, good).otherwise(0.0)).alias(f"g_{k}"),
                F.sum(F.when(spoke, F.col("n") - good).otherwise(0.0)).alias(f"b_{k}"),
            ]
        s = patterns.withColumn("p", now.posterior()).agg(*sums).first()
        if not s["all"]:
            return now
        n_good, n_bad = s["good"], s["all"] - s["good"]
        now = Accuracies(
            within(n_good / s["all"], opts.good_bounds),
            {k: within(s[f"g_{k}"] / max(n_good, 1e-9), opts.bounds(k, 0)) for k in RULES},
            {k: within(s[f"b_{k}"] / max(n_bad, 1e-9), opts.bounds(k, 1)) for k in RULES},
        )
    return now


def _judged(docs: DataFrame, at: str, opts: VoteOptions) -> tuple[DataFrame, Column, Column]:
    """(written ``docs`` with struct ``at``, posterior, kept)."""
    rows = written(with_votes(with_counts(docs, at), at), "quality_votes")
    votes = [f"v_{k}" for k in RULES]
    patterns = written(
        rows.groupBy(*(F.col(at)[v].alias(v) for v in votes)).agg(F.count(F.lit(1)).alias("n")),
        "vote_patterns",
    )
    post = estimate(patterns, opts).posterior(f"`{at}`.")
    return rows, post, post >= opts.threshold


def judge(docs: DataFrame, opts: VoteOptions = VoteOptions()) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, p_good and kept, which the
    posterior alone decides."""
    rows, post, kept = _judged(docs.select("doc_id", "text"), "q", opts)
    return rows.select(
        "doc_id", *(F.col("q")[n].alias(n) for n in COUNTS),
        F.expr(_in_struct(BASE_FAILED, "q")).alias("base_failed"), post.alias("p_good"), kept.alias("kept"),
    )


def keep_good(docs: DataFrame, opts: VoteOptions = VoteOptions()) -> DataFrame:
    """The rows of ``docs`` that the posterior keeps, with their own columns."""
    at = "q"
    while at.lower() in [c.lower() for c in docs.columns]:
        at += "_"
    rows, _, kept = _judged(docs, at, opts)
    return rows.where(kept).select(*(F.col(f"`{c}`") for c in docs.columns))


def op6_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    kept = ~F.col("base_failed") & F.col("kept")
    return judge(docs).select(*base, "base_failed", kept.alias("kept"))


def _em_sql(opts: VoteOptions) -> tuple[str, str, str]:
    """The estimation unrolled, two common table expressions a round; the last posterior;
    the name of the last estimates."""

    def posterior(e: str) -> str:
        odds = f"ln({e}.good) - ln(1 - {e}.good)"
        for k in RULES:
            g, b = f"{e}.g_{k}", f"{e}.b_{k}"
            odds += f" + CASE WHEN v_{k} <> 0 THEN ln({g}) - ln({b}) ELSE ln(1 - {g}) - ln(1 - {b}) END"
        return f"1 / (1 + exp(-({odds})))"

    def bound(x: str, bounds: tuple[float, float]) -> str:
        return f"least(greatest({x}, {bounds[0]}), {bounds[1]})"

    def rate(k: str, bad: int) -> str:
        weight = "(n - n * p)" if bad else "n * p"
        spoke = f"sum(CASE WHEN v_{k} <> 0 THEN {weight} ELSE 0 END)"
        return bound(f"{spoke} / greatest(sum({weight}), 1e-9)", opts.bounds(k, bad))

    start = ", ".join(f"{opts.start(k, 0)}::DOUBLE AS g_{k}, {opts.start(k, 1)}::DOUBLE AS b_{k}" for k in RULES)
    ctes = [f"e0 AS (SELECT {opts.good}::DOUBLE AS good, {start})"]
    for t in range(opts.rounds):
        cols = ", ".join(f"{rate(k, 0)} AS g_{k}, {rate(k, 1)} AS b_{k}" for k in RULES)
        share = bound("sum(n * p) / sum(n)", opts.good_bounds)
        ctes.append(f"x{t} AS MATERIALIZED (SELECT patterns.*, {posterior(f'e{t}')} AS p FROM patterns, e{t})")
        ctes.append(f"e{t + 1} AS MATERIALIZED (SELECT {share} AS good, {cols} FROM x{t})")
    return ",\n".join(ctes), posterior(f"e{opts.rounds}"), f"e{opts.rounds}"


def _op6_sql(opts: VoteOptions = VoteOptions()) -> str:
    em, post, last = _em_sql(opts)
    votes = ", ".join(f"{vote_sql(k)} AS v_{k}" for k in RULES)
    names = ", ".join(f"v_{k}" for k in RULES)
    return rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
g AS (SELECT *, list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2]) AS win FROM t),
u AS (SELECT doc_id, i, win FROM (SELECT doc_id, unnest(range(1, len(win) + 1)) AS i, unnest(win) AS win FROM g)),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM u) WHERE c > 1),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM d, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
c AS (
  SELECT t.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         len(l)::BIGINT AS n_lines, len(list_filter(w, lambda x: NOT regexp_matches(x, '\p{{L}}')))::BIGINT AS n_unlettered,
         len(list_filter(w, lambda x: length(x) <= 3))::BIGINT AS n_stops,
         len(list_filter(w, lambda x: regexp_matches(x, '[.!?]$')))::BIGINT AS n_ends
  FROM t LEFT JOIN r USING (doc_id)),
v AS MATERIALIZED (SELECT *, {votes} FROM c),
patterns AS MATERIALIZED (SELECT {names}, count(*) AS n FROM v GROUP BY ALL),
{em}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {BASE_FAILED} AS base_failed,
       NOT {BASE_FAILED} AND {post} >= {opts.threshold} AS kept
FROM v, {last}
"""


OP6_SQL = _op6_sql()
