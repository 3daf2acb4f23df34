"""URL filter by Empirical-Bayes host reputation.

Every labelled page is a trial of its host: *bad* or not. Bad rates are shrunk down the
name tree. A suffix starts from the overall rate, a registered domain from its suffix, a
host from its domain; the weight of each step (the beta prior's pseudo-count) is fitted from
how much the children of that level really differ (method of moments on beta-binomial
counts). A host without labelled pages has no trials of its own: it takes the posterior of its
domain, else of its suffix, else the overall rate, with the weight fitted for the step below
that level. A host is blocked when even the lower bound of its posterior bad rate lies above the
tolerated rate. Hand-written rules (host plus path prefix) are consulted first.

Only counts per host meet. The posteriors are written before the pages are joined with them, so
the pages are not shuffled unless the host table is too large for Spark to broadcast, and then
both sides are plain shuffles, of which Spark splits a hot host's pages.

Defined results: a NULL url, or one without ``://``, has empty host and path, matches no rule
and takes the overall rate. Repeated pages count as often as they occur. Without any labelled
page nothing is known and everything unruled is allowed. Columns other than the named ones
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txengine.llm.common import lower_ascii, table, written

URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """``host/path`` and what to do; fits the host, all its subdomains and longer paths."""

    pattern: str
    verdict: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


RULES = (
    Rule("net/", "block"),
    Rule("example.net/en/", "allow"),
    Rule("example.com/de/", "block"),
    Rule("org/fr/", "allow"),
)


@dataclass(frozen=True)
class ReputationOptions:
    """``z``: one-sided normal quantile of the bound (1.645: 95 %). ``tolerated``: bad rate a
    host may have; None takes the overall rate of the labelled pages. ``max_strength``: upper
    end of a fitted pseudo-count (children that do not differ at all). ``suffixes``: public
    suffixes of more than one label, the last label being the default."""

    z: float = 1.645
    tolerated: float | None = None
    max_strength: float = 1000.0
    suffixes: tuple[str, ...] = ("co.uk", "com.au", "co.jp")


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, URL_PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def match_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """(pattern, verdict) of the longest fitting rule, NULL without one. The rule list is a
    parameter of a few entries and becomes one CASE."""
    ranked = sorted(rules, key=lambda r: (-len(r.pattern), r.pattern))

    def pick(value) -> Column:
        out = F.lit(None).cast("string")
        for r in reversed(ranked):
            fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
            out = F.when(fits, F.lit(value(r))).otherwise(out)
        return out

    return pick(lambda r: r.pattern), pick(lambda r: r.verdict)


def suffix_of(host: Column, opts: ReputationOptions) -> Column:
    out = F.substring_index(host, ".", -1)
    for s in opts.suffixes:
        out = F.when((host == s) | host.endswith("." + s), F.lit(s)).otherwise(out)
    return out


def domain_of(host: Column, suffix: Column) -> Column:
    """The registered domain: the suffix and one label more (the host itself if shorter)."""
    labels = F.size(F.split(suffix, r"\.")) + 1
    parts = F.split(host, r"\.")
    return F.array_join(
        F.slice(parts, F.greatest(F.size(parts) - labels + 1, F.lit(1)), labels), "."
    )


def _strength(level: DataFrame, prior: Column, opts: ReputationOptions) -> DataFrame:
    """One row ``strength``: pseudo-count of the beta prior that explains the spread of
    (n, k) around ``prior``. With intra-class correlation rho,
    E(k - n m)^2 = n m (1-m) (1 + (n-1) rho), and the pseudo-count is 1/rho - 1."""
    v = prior * (1 - prior)
    spread = F.sum(F.pow(F.col("k") - F.col("n") * prior, 2) - F.col("n") * v)
    room = F.sum(F.col("n") * (F.col("n") - 1) * v)
    rho = F.when(room > 0, spread / room).otherwise(F.lit(0.0))
    low, high = 1.0 / (1.0 + opts.max_strength), 0.5
    rho = F.greatest(F.lit(low), F.least(F.lit(high), rho))
    return level.agg((1 / rho - 1).alias("strength"))


def _shrunk(level: DataFrame, prior: Column, opts: ReputationOptions, out: str) -> DataFrame:
    """``level`` with the posterior mean of each row under its parent's mean."""
    s = F.col("strength")
    fitted = level.withColumn("strength", _strength(level, prior, opts).scalar())
    return fitted.withColumn(out, (F.col("k") + s * prior) / (F.col("n") + s))


def _named(hosts: DataFrame, opts: ReputationOptions) -> DataFrame:
    return hosts.withColumn("suffix", suffix_of(F.col("host"), opts)).withColumn(
        "domain", domain_of(F.col("host"), F.col("suffix"))
    )


def reputations(
    outcomes: DataFrame,
    opts: ReputationOptions = ReputationOptions(),
    hosts: DataFrame | None = None,
) -> DataFrame:
    """(host, n, k, bad_rate, bad_low, overall): the posterior of every host of ``hosts``
    (distinct), without them of every host with a labelled page. ``outcomes`` holds
    (url, bad 0/1)."""
    host = host_of(F.col("url"))
    counts = (
        outcomes.where(F.col("bad").isNotNull())
        .groupBy(host.alias("host"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("n"),
            F.sum(F.col("bad").cast("double")).alias("k"),
        )
    )
    # one row per host: every level below reads this small table, not the pages again
    per_host = _named(written(counts, "host_counts"), opts)
    per_domain = per_host.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    per_suffix = per_domain.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    total = per_suffix.agg((F.sum("k") / F.sum("n")).alias("overall"))

    suffix = _shrunk(
        per_suffix.withColumn("overall", total.scalar()), F.col("overall"), opts, "suffix_rate"
    ).select("suffix", "suffix_rate", "overall", F.col("strength").alias("suffix_strength"))
    domain = _shrunk(
        per_domain.join(suffix, "suffix"), F.col("suffix_rate"), opts, "domain_rate"
    ).select("domain", "domain_rate", F.col("strength").alias("domain_strength"))
    strength = _strength(per_host.join(domain, "domain"), F.col("domain_rate"), opts).scalar()
    # one row: the strengths of all levels, for hosts whose own levels have no labelled page
    fitted = (
        suffix.agg(F.first("suffix_strength")).scalar(),
        domain.agg(F.first("domain_strength")).scalar(),
    )
    asked = per_host.select("host", "domain", "suffix") if hosts is None else _named(hosts, opts)
    level = (
        asked.join(per_host.select("host", "n", "k"), "host", "left")
        .join(domain.select("domain", "domain_rate"), "domain", "left")
        .join(suffix.select("suffix", "suffix_rate"), "suffix", "left")
        .withColumns({
            "overall": total.scalar(), "n": F.coalesce("n", F.lit(0.0)), "k": F.coalesce("k", F.lit(0.0)),
            "of_suffix": fitted[0], "of_domain": fitted[1], "of_host": strength,
        })
    )
    prior = F.coalesce("domain_rate", "suffix_rate", "overall")
    s = F.when(F.col("domain_rate").isNotNull(), F.col("of_host"))
    s = s.when(F.col("suffix_rate").isNotNull(), F.col("of_domain")).otherwise(F.col("of_suffix"))
    hosts = level.withColumn("strength", s).withColumn(
        "bad_rate", (F.col("k") + F.col("strength") * prior) / (F.col("n") + F.col("strength"))
    )
    weight = F.col("n") + F.col("strength")
    sd = F.sqrt(F.col("bad_rate") * (1 - F.col("bad_rate")) / (weight + 1))
    return hosts.select(
        "host", "n", "k", "bad_rate",
        F.greatest(F.lit(0.0), F.col("bad_rate") - F.lit(opts.z) * sd).alias("bad_low"),
        "overall",
    )


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    opts: ReputationOptions = ReputationOptions(),
) -> DataFrame:
    """One row per page: (page_id, host, path, rule, verdict, bad_rate, bad_low)."""
    parts = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    tolerated = F.col("overall") if opts.tolerated is None else F.lit(opts.tolerated)
    known = reputations(outcomes, opts, parts.select("host").distinct()).select(
        "host", "bad_rate", "bad_low", (F.col("bad_low") > tolerated).alias("worse")
    )
    # one row per host, written: Spark knows its size, and either broadcasts it or splits the
    # pages of a hot host
    known = written(known, "host_posteriors")
    rule, verdict = match_rule(F.col("host"), F.col("path"), rules)
    by_method = F.when(F.col("worse"), F.lit("block")).otherwise(F.lit("allow"))
    return parts.join(known, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, by_method).alias("verdict"), "bad_rate", "bad_low",
    )


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, bad) of the labelled pages. A page shows the document whose number is the last
    number of its path; it is bad if that document is labelled low quality or toxic."""
    doc_id = F.regexp_extract(path_of(F.col("url")), r"([0-9]{1,18})(?:\.html|/)?$", 1)
    linked = (
        pages.select("url", doc_id.alias("d"))
        .where(F.col("d") != "")
        .select("url", F.col("d").cast("bigint").alias("doc_id"))
    )
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    return linked.join(labels.select("doc_id", bad.alias("bad")), "doc_id").select("url", "bad")


def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    out = judge_urls(pages, page_outcomes(pages, table(spark, sf_dir, "labels")))
    return out.select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = r"""
WITH parts AS (
  SELECT page_id, url,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
outcomes AS (
  SELECT p.host, CASE WHEN l.quality = 0 OR l.toxic = 1 THEN 1.0 ELSE 0.0 END AS bad
  FROM parts p JOIN labels l
    ON l.doc_id = TRY_CAST(regexp_extract(p.path, '([0-9]{1,18})(?:\.html|/)?$', 1) AS BIGINT)),
suffixes AS (
  SELECT host, string_split(host, '.') AS labels,
         CASE WHEN host = 'co.uk' OR ends_with(host, '.co.uk') THEN 'co.uk'
              WHEN host = 'com.au' OR ends_with(host, '.com.au') THEN 'com.au'
              WHEN host = 'co.jp' OR ends_with(host, '.co.jp') THEN 'co.jp'
              ELSE string_split(host, '.')[-1] END AS suffix
  FROM (SELECT DISTINCT host FROM parts)),
names AS (
  SELECT host, suffix, array_to_string(
    list_slice(labels, greatest(len(labels) - len(string_split(suffix, '.')), 1), len(labels)), '.') AS domain
  FROM suffixes),
per_host AS (
  SELECT host, domain, suffix, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS k
  FROM outcomes JOIN names USING (host) GROUP BY ALL),
per_domain AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM per_host GROUP BY ALL),
per_suffix AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM per_domain GROUP BY ALL),
total AS (SELECT sum(k) / sum(n) AS overall FROM per_suffix),
s0 AS (SELECT *, overall AS prior FROM per_suffix, total),
s1 AS (SELECT 1 / greatest(1 / 1001.0, least(0.5, CASE WHEN sum(n * (n - 1) * prior * (1 - prior)) > 0
         THEN sum(pow(k - n * prior, 2) - n * prior * (1 - prior))
              / sum(n * (n - 1) * prior * (1 - prior)) ELSE 0 END)) - 1 AS m FROM s0),
s2 AS (SELECT suffix, overall, (k + m * prior) / (n + m) AS rate FROM s0, s1),
d0 AS (SELECT d.*, s2.rate AS prior FROM per_domain d JOIN s2 USING (suffix)),
d1 AS (SELECT 1 / greatest(1 / 1001.0, least(0.5, CASE WHEN sum(n * (n - 1) * prior * (1 - prior)) > 0
         THEN sum(pow(k - n * prior, 2) - n * prior * (1 - prior))
              / sum(n * (n - 1) * prior * (1 - prior)) ELSE 0 END)) - 1 AS m FROM d0),
d2 AS (SELECT domain, (k + m * prior) / (n + m) AS rate FROM d0, d1),
h0 AS (SELECT h.*, d2.rate AS prior FROM per_host h JOIN d2 USING (domain)),
h1 AS (SELECT 1 / greatest(1 / 1001.0, least(0.5, CASE WHEN sum(n * (n - 1) * prior * (1 - prior)) > 0
         THEN sum(pow(k - n * prior, 2) - n * prior * (1 - prior))
              / sum(n * (n - 1) * prior * (1 - prior)) ELSE 0 END)) - 1 AS m FROM h0),
level AS (
  SELECT host, coalesce(n, 0) AS n, coalesce(k, 0) AS k, coalesce(d2.rate, s2.rate, total.overall) AS prior,
         CASE WHEN d2.rate IS NOT NULL THEN h1.m WHEN s2.rate IS NOT NULL THEN d1.m ELSE s1.m END AS m
  FROM names LEFT JOIN (SELECT host, n, k FROM per_host) USING (host) LEFT JOIN d2 USING (domain)
       LEFT JOIN s2 USING (suffix), total, h1, d1, s1),
h2 AS (SELECT host, n + m AS w, (k + m * prior) / (n + m) AS rate FROM level),
known AS (SELECT host, greatest(0, rate - 1.645 * sqrt(rate * (1 - rate) / (w + 1))) > overall AS worse
          FROM h2, total),
ruled AS (
  SELECT page_id, host, path,
    CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN worse THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN known USING (host)
"""
