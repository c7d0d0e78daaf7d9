"""URL filter: explicit host/path rules, else empirical-Bayes host reputation.

A labelled page is bad when its document is of low quality or toxic.  Bad
rates are shrunk down a tree: the whole corpus is the prior of each public
suffix, the suffix that of its registered domains, the domain that of its
hosts.  At every level the prior is a beta distribution whose mean is the
parent's posterior mean and whose strength (pseudo-count) is estimated by
the method of moments of the beta-binomial model from that level's groups.
A page is blocked when the lower posterior bound of its host's bad rate is
above ``limit``.

All steps are DataFrame operations.  Labels meet pages on the page id
before any grouping, and only counts per host go on (partial aggregation
reduces a host that holds a third of all pages to one row per task).  The
per-host result is written once, so that the final join has plain shuffles
on both sides and Spark may broadcast or split it by measured size.

The suffix is the host's last label, or its last two where ``SUFFIXES`` names
them (a fixed table: suffixes beyond it count by their last label); the
registered domain has one label more.  A port belongs to the host, not to its
domain and suffix.

Defined results
  * null url, or one without ``://``: host and path are empty, no rule fits;
    such pages form the host ``''`` and share its reputation;
  * null label columns: the page counts as unlabelled;
  * several label rows for a page: each row is one outcome;
  * repeated page rows: each is judged and counted on its own;
  * no labels at all: every bound is that of the uniform prior, so nothing
    is blocked by reputation;
  * two rules of the same length fit: the smaller string wins;
  * empty pages: empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimforge.llm._common import Scratch, ascii_lower, read

#: (verdict, rule): host, a slash, and the path the url's path must start with.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: Two-label public suffixes; any other host's suffix is its last label.
SUFFIXES = tuple(f"{second}.{top}" for top, seconds in (
    ("uk", "co org ac gov me net ltd plc sch nhs"), ("au", "com net org edu gov id asn"), ("nz", "co net org ac govt school"),
    ("jp", "co ne or ac go ad ed gr lg"), ("kr", "co ne or ac go re pe"), ("in", "co net org ac gov gen firm ind"),
    ("za", "co net org ac gov web"), ("br", "com net org edu gov"), ("ar", "com net org edu gob"), ("mx", "com net org edu gob"),
    ("co", "com net org edu gov"), ("cn", "com net org edu gov ac"), ("tw", "com net org edu gov"), ("hk", "com net org edu gov"),
    ("sg", "com net org edu gov"), ("my", "com net org edu gov"), ("tr", "com net org edu gov"), ("il", "co net org ac gov"),
    ("id", "co net or ac go web"), ("th", "co net or ac go in"), ("ua", "com net org edu gov"), ("pl", "com net org edu gov"),
) for second in seconds.split())
LIMIT = 0.5
Z = 1.6448536269514722  # one-sided 95 %
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1000.0


def split_url(pages: DataFrame) -> DataFrame:
    """page_id, host, path, domain, suffix of every page."""
    url = F.coalesce(F.col("url"), F.lit(""))
    host = ascii_lower(F.regexp_extract(url, r"://([^/?#]*)", 1))
    path = F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1)
    return (pages.select("page_id", host.alias("host"), path.alias("path"))
            .withColumn("name", F.regexp_replace("host", r":[0-9]*$", ""))
            .withColumn("two", F.substring_index("name", ".", -2))
            .select("page_id", "host", "path",
                    F.when(F.col("two").isin(*SUFFIXES), F.substring_index("name", ".", -3)).otherwise(F.col("two")).alias("domain"),
                    F.when(F.col("two").isin(*SUFFIXES), F.col("two")).otherwise(F.substring_index("name", ".", -1)).alias("suffix")))


def match_rule(rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null when none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        at = text.index("/")
        host, path = text[:at], text[at:]
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, text).otherwise(rule)
        verdict = F.when(fits, what).otherwise(verdict)
    return rule, verdict


def outcomes(labels: DataFrame) -> DataFrame:
    """page_id and bad (0/1) of every fully labelled row."""
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)
    return (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
            .select(F.col("doc_id").alias("page_id"), bad.cast("long").alias("bad")))


def _strength(groups: DataFrame, name: str) -> DataFrame:
    """One row: corpus mean ``mu`` and the prior strength of this level."""
    g = groups.filter("n > 0")
    a = g.agg(F.count("*").cast("double").alias("c"), F.sum("n").cast("double").alias("m"),
              F.sum("k").cast("double").alias("s"),
              F.sum((F.col("n") * F.col("n")).cast("double")).alias("n2"),
              F.sum(F.col("k").cast("double") * F.col("k") / F.col("n")).alias("q"))
    mu = F.coalesce(F.col("s") / F.nullif(F.col("m"), F.lit(0.0)), F.lit(0.5))
    spread = F.nullif(mu * (1 - mu), F.lit(0.0))
    room = F.nullif(F.col("m") - F.col("n2") / F.nullif(F.col("m"), F.lit(0.0)), F.lit(0.0))
    rho = ((F.col("q") - F.col("m") * mu * mu) / spread - (F.col("c") - 1)) / room
    strength = F.when(rho > 0, F.least(F.greatest(1 / rho - 1, F.lit(MIN_STRENGTH)), F.lit(MAX_STRENGTH))) \
        .otherwise(F.lit(MAX_STRENGTH))
    return a.select(mu.alias(f"mu_{name}"), strength.alias(f"m_{name}"))


def reputation(urls: DataFrame, labelled: DataFrame, scratch: Scratch, z: float = Z) -> DataFrame:
    """host, n, k, alpha, beta, lower: posterior of each host's bad rate."""
    hosts = (urls.join(labelled, "page_id", "left").groupBy("host", "domain", "suffix")
             .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k")))
    hosts = scratch.write(hosts, "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))

    def shrink(level: DataFrame, parent: str, m: str, out: str) -> DataFrame:
        return level.withColumn(out, (F.col("k") + F.col(m) * F.col(parent)) / (F.col("n") + F.col(m)))

    # one-row tables: the priors' parameters
    s = shrink(suffixes.join(_strength(suffixes, "s")), "mu_s", "m_s", "p_suffix").select("suffix", "p_suffix")
    d = shrink(domains.join(s, "suffix").join(_strength(domains, "d")), "p_suffix", "m_d", "p_domain")
    d = scratch.write(d.select("domain", "p_domain"), "domains")
    h = hosts.join(d, "domain").join(_strength(hosts, "h"))
    h = h.withColumn("alpha", F.col("k") + F.col("m_h") * F.col("p_domain")) \
        .withColumn("beta", F.col("n") - F.col("k") + F.col("m_h") * (1 - F.col("p_domain")))
    t = F.col("alpha") + F.col("beta")
    lower = F.col("alpha") / t - z * F.sqrt(F.col("alpha") * F.col("beta") / (t * t * (t + 1)))
    return scratch.write(h.select("host", "n", "k", "alpha", "beta", lower.alias("lower")), "reputation")


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, limit: float = LIMIT) -> DataFrame:
    """page_id, host, path, rule, verdict of every page, and its host's
    evidence: n labelled pages, k of them bad, ``lower`` bound of the bad rate (six decimals)."""
    urls = split_url(pages)
    rep = reputation(urls, outcomes(labels), Scratch(pages.sparkSession, "url-reputation"))
    rule, verdict = match_rule(rules)
    mine = F.when(F.col("lower") > limit, "block").otherwise("allow")
    return (urls.join(rep.select("host", "n", "k", "lower"), "host", "left")
            .select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, mine).alias("verdict"),
                    "n", "k", F.round("lower", 6).alias("lower")))


def op4_url_filters(spark, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels"))


ORACLE_SQL = f"""
WITH u AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), p AS (
  SELECT *, array_to_string(string_split(host, '.')[-2:], '.') AS domain,
         string_split(host, '.')[-1] AS suffix FROM u
), l AS (
  SELECT doc_id AS page_id, CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END AS bad
  FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL
), h AS (
  SELECT host, domain, suffix, count(bad) AS n, coalesce(sum(bad), 0) AS k
  FROM p LEFT JOIN l USING (page_id) GROUP BY ALL
), d AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM h GROUP BY ALL
), s AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM d GROUP BY ALL
), m AS (
  SELECT lv, count(*) AS c, sum(n)::DOUBLE AS m, sum(k)::DOUBLE AS s, sum(n * n)::DOUBLE AS n2,
         sum(k::DOUBLE * k / n) AS q
  FROM (SELECT 'h' AS lv, n, k FROM h UNION ALL SELECT 'd', n, k FROM d UNION ALL SELECT 's', n, k FROM s)
  WHERE n > 0 GROUP BY lv
), r AS (
  SELECT lv, s / m AS mu, ((q - m * (s / m) * (s / m)) / nullif((s / m) * (1 - s / m), 0) - (c - 1))
         / nullif(m - n2 / m, 0) AS rho FROM m
), e AS (
  SELECT lv, mu, CASE WHEN rho > 0 THEN least(greatest(1 / rho - 1, {MIN_STRENGTH}), {MAX_STRENGTH})
                      ELSE {MAX_STRENGTH} END AS w
  FROM (SELECT coalesce(mu, 0.5) AS mu, rho, x.lv FROM (VALUES ('h'), ('d'), ('s')) x(lv) LEFT JOIN r USING (lv))
), ps AS (SELECT suffix, (k + w * mu) / (n + w) AS p FROM s, e WHERE lv = 's'
), pd AS (SELECT domain, (d.k + w * ps.p) / (d.n + w) AS p FROM d JOIN ps USING (suffix), e WHERE lv = 'd'
), ph AS (
  SELECT host, CAST(n AS BIGINT) AS n, CAST(k AS BIGINT) AS k, k + w * pd.p AS a, n - k + w * (1 - pd.p) AS b FROM h JOIN pd USING (domain), e WHERE lv = 'h'
), v AS (
  SELECT host, n, k, a / (a + b) - {Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS lower FROM ph
), f AS (
  SELECT page_id, host, path, lower, n, k,
    [x FOR x IN [
      {{'rule': 'www.example.com/en/', 'verdict': 'allow', 'host': 'www.example.com', 'path': '/en/'}},
      {{'rule': 'example.com/en/', 'verdict': 'block', 'host': 'example.com', 'path': '/en/'}},
      {{'rule': 'net/es/', 'verdict': 'block', 'host': 'net', 'path': '/es/'}},
      {{'rule': 'net/fr/', 'verdict': 'block', 'host': 'net', 'path': '/fr/'}},
      {{'rule': 'com/', 'verdict': 'allow', 'host': 'com', 'path': '/'}}]
     IF (p.host = x.host OR ends_with(p.host, '.' || x.host)) AND starts_with(p.path, x.path)][1] AS hit
  FROM p LEFT JOIN v USING (host)
)
SELECT page_id, host, path, hit.rule AS rule,
       coalesce(hit.verdict, CASE WHEN lower > {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
       n, k, round(lower, 6) AS lower
FROM f
"""
