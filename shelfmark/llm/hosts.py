"""URL filtering by empirical-Bayes host reputation.

Labelled page outcomes (bad or not) are counted per host and shrunk through a chain of beta
priors: the host towards its registered domain, that towards its suffix, that towards all pages.
The weight of a prior is fitted by moments of the beta-binomial over all hosts.  A host is blocked
if the lower posterior bound of its rate of bad pages is above a limit, so a host with little
evidence is judged by what stands above it and rarely blocked.  Explicit rules go first.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import cut

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"

# (verdict, host, path) of the production rules; fixed values.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
LIMIT = 0.5
Z = 1.645


def url_host(url: Column) -> Column:
    """The part after the first ``://``, A-Z lower-cased; empty without one."""
    host = F.coalesce(F.regexp_extract(url, URL, 1), F.lit(""))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, else nulls.  Rules become one CASE."""
    rule = verdict = F.lit(None).cast("string")
    for says, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def registered_domain(host: Column, second_level: Sequence[str] = ("co", "com", "org", "net", "gov", "edu", "ac")) -> Column:
    """The last two labels; three where the last but one only divides a country's suffix."""
    last2 = F.substring_index(host, ".", -2)
    divides = F.substring_index(last2, ".", 1).isin(*second_level) & (F.length(F.substring_index(host, ".", -1)) == 2)
    return F.when(divides, F.substring_index(host, ".", -3)).otherwise(last2)


def suffix(domain: Column) -> Column:
    """What follows the first label; the domain itself if it has one label."""
    return F.when(F.instr(domain, ".") > 0, F.substring(domain, F.instr(domain, ".") + 1, F.length(domain))).otherwise(domain)


def host_reputation(pages: DataFrame, outcomes: DataFrame, limit: float = LIMIT, z: float = Z) -> DataFrame:
    """One row per host: pages labelled and bad, posterior mean, lower bound, blocked.

    ``pages`` has (page_id, host), ``outcomes`` (page_id, bad 0/1), one row per page; outcomes
    without a page or with a null do not count.  Without any outcome nothing is blocked.
    """
    labels = outcomes.where("page_id IS NOT NULL AND bad IS NOT NULL").groupBy("page_id").agg(F.max("bad").alias("bad"))
    hosts = (
        pages.join(labels, "page_id", "left")
        .groupBy("host")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("k"))
        .withColumn("domain", registered_domain(F.col("host")))
        .withColumn("suffix", suffix(F.col("domain")))
    )
    hosts = cut(hosts)
    p, m = prior_of(hosts)
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("dn"), F.sum("k").alias("dk"))
    suffixes = domains.groupBy("suffix").agg(F.sum("dn").alias("sn"), F.sum("dk").alias("sk"))
    suffix_rate = (F.col("sk") + F.lit(m * p)) / (F.col("sn") + F.lit(m))
    domain_rate = (F.col("dk") + F.lit(m) * F.col("suffix_rate")) / (F.col("dn") + F.lit(m))
    mean = (F.col("k") + F.lit(m) * F.col("domain_rate")) / (F.col("n") + F.lit(m))
    bound = F.col("bad_rate") - F.lit(z) * F.sqrt(F.col("bad_rate") * (1 - F.col("bad_rate")) / (F.col("n") + F.lit(m + 1)))
    return (
        hosts.join(domains, ["suffix", "domain"])
        .join(suffixes, "suffix")
        .withColumn("suffix_rate", suffix_rate)
        .withColumn("domain_rate", domain_rate)
        .withColumn("bad_rate", mean)
        .withColumn("lower_bound", F.greatest(bound, F.lit(0.0)))
        .select("host", "n", "k", "bad_rate", "lower_bound", (F.col("lower_bound") > limit).alias("blocked"))
    )


def prior_of(hosts: DataFrame) -> tuple[float, float]:
    """(rate over all, weight of a prior in pages) from (n, k) per host; one row reaches the driver.

    Of all pairs of labelled pages of one host, the share that is bad twice exceeds p * p by
    p (1 - p) / (weight + 1) in a beta-binomial.  The weight stays within 1 and 1000 pages.
    """
    n, k = F.col("n"), F.col("k")
    total = hosts.agg(F.sum(n).alias("n"), F.sum(k).alias("k"), F.sum(n * (n - 1)).alias("pairs"), F.sum(k * (k - 1)).alias("both")).first()
    p = total["k"] / total["n"] if total["n"] else 0.0
    if not total["pairs"] or not 0 < p < 1:
        return p, 1000.0
    alike = (total["both"] / total["pairs"] - p * p) / (p * (1 - p))
    return p, max(1.0, min(1 / alike - 1, 1000.0)) if alike > 0 else 1000.0


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, **options) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's reputation, for every (page_id, url)."""
    split = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    reputation = host_reputation(split, outcomes, **options)
    rule, says = matching_rule(F.col("host"), F.col("path"), rules)
    by_method = F.when(F.col("blocked"), "block").otherwise("allow")
    return split.join(reputation, "host").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(says, by_method).alias("verdict"), "bad_rate", "lower_bound"
    )


SQL = r"""
WITH split AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
outcomes AS (
  SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
hosts AS (
  SELECT host, count(bad) AS n, coalesce(CAST(sum(bad) AS BIGINT), 0) AS k,
         array_to_string(list_slice(string_split(host, '.'), greatest(1, len(string_split(host, '.')) - 1), len(string_split(host, '.'))), '.') AS last2,
         array_to_string(list_slice(string_split(host, '.'), greatest(1, len(string_split(host, '.')) - 2), len(string_split(host, '.'))), '.') AS last3
  FROM split LEFT JOIN outcomes USING (page_id) GROUP BY host),
named AS (
  SELECT host, n, k,
         CASE WHEN split_part(last2, '.', 1) IN ('co', 'com', 'org', 'net', 'gov', 'edu', 'ac')
                   AND length(split_part(host, '.', -1)) = 2 THEN last3 ELSE last2 END AS domain
  FROM hosts),
suffixed AS (
  SELECT *, CASE WHEN instr(domain, '.') > 0 THEN substr(domain, instr(domain, '.') + 1) ELSE domain END AS suffix FROM named),
total AS (SELECT sum(n) AS n, sum(k) AS k, sum(n * (n - 1)) AS pairs, sum(k * (k - 1)) AS both_bad FROM suffixed),
rate AS (SELECT *, CASE WHEN n > 0 THEN CAST(k AS DOUBLE) / n ELSE 0.0 END AS p FROM total),
alike AS (
  SELECT *, CASE WHEN pairs > 0 AND p > 0 AND p < 1
            THEN (CAST(both_bad AS DOUBLE) / pairs - p * p) / (p * (1 - p)) END AS alike FROM rate),
prior AS (
  SELECT p, CASE WHEN alike > 0 THEN greatest(1.0::DOUBLE, least(1 / alike - 1, 1000.0::DOUBLE)) ELSE 1000.0::DOUBLE END AS m FROM alike),
sums AS (
  SELECT s.*, p, m, sum(n) OVER (PARTITION BY suffix, domain) AS dn, sum(k) OVER (PARTITION BY suffix, domain) AS dk,
         sum(n) OVER (PARTITION BY suffix) AS sn, sum(k) OVER (PARTITION BY suffix) AS sk
  FROM suffixed s, prior),
domains AS (SELECT *, (dk + m * ((sk + m * p) / (sn + m))) / (dn + m) AS domain_rate FROM sums),
means AS (SELECT *, (k + m * domain_rate) / (n + m) AS bad_rate FROM domains),
judged AS (
  SELECT host, greatest(bad_rate - 1.645::DOUBLE * sqrt(bad_rate * (1 - bad_rate) / (n + (m + 1))), 0.0) > 0.5 AS blocked FROM means),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM split)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN blocked THEN 'block' ELSE 'allow' END AS verdict
FROM ruled JOIN judged USING (host)
"""
