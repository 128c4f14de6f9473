"""URL filter: rules, and for the rest the reputation of hosts by empirical Bayes.

Labelled pages of a host are a beta-binomial sample. A host is shrunk towards its registered domain, a domain towards its
suffix, a suffix towards all pages; how strongly is estimated at each level from how much the groups differ beyond chance.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.rows import fresh_name, join_on_counted
from broadsheet.session import durable

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LONG_SUFFIXES = ("ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "co.jp", "com.br", "co.nz")  # of two labels; a parameter
Z = 1.645  # bound of the posterior: about 95 %
LEAST_GOOD = 0.5
LEAST_RHO, MOST_RHO = 1e-3, 0.5  # correlation of two pages of one group


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest fitting ``(verdict, host, path)`` rule; null without one."""
    rule = verdict = F.lit(None).cast("string")
    for says, at, prefix in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:], r[0])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(prefix)
        rule, verdict = F.when(fits, F.lit(at + prefix)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def suffix_of(host: Column, long_suffixes: Sequence[str] = LONG_SUFFIXES) -> Column:
    last_two = F.substring_index(host, ".", -2)
    return F.when(last_two.isin(*long_suffixes), last_two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, long_suffixes: Sequence[str] = LONG_SUFFIXES) -> Column:
    long_ = F.substring_index(host, ".", -2).isin(*long_suffixes)
    return F.when(long_, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def _strength(groups: DataFrame) -> float:
    """Prior size of a level from ``(n, good, m)`` rows, ``m`` being the mean of the group above.

    Good pages of a group vary by ``n m (1 - m) (1 + (n - 1) rho)``; ``rho`` follows from the sums over all groups, and
    the prior is worth ``(1 - rho) / rho`` pages.
    """
    m, n = F.col("m"), F.col("n")
    row = groups.where("m > 0 AND m < 1").agg(
        F.sum(F.pow(F.col("good") - n * m, 2) / (m * (1 - m))).alias("x"), F.sum("n").alias("n"), F.sum(n * (n - 1)).alias("pairs")
    ).first()
    rho = (row.x - row.n) / row.pairs if row.pairs else LEAST_RHO
    rho = min(MOST_RHO, max(LEAST_RHO, round(rho, 9)))
    return (1 - rho) / rho


def reputations(outcomes: DataFrame, hosts: DataFrame) -> DataFrame:
    """``(host, mean, upper)``: posterior mean share of good pages and its upper bound for each row of ``hosts(host)``.

    ``outcomes`` has ``host`` and ``good`` (1 or 0). Hosts without labelled pages have what their domain has, and so on up.
    Without any outcome the mean is a half and nothing can be said against a host.
    """
    suffix, domain = suffix_of(F.col("host")).alias("suffix"), domain_of(F.col("host")).alias("domain")
    labelled = outcomes.groupBy("host").agg(F.count("*").alias("n"), F.sum("good").alias("good"))
    rows = durable(hosts.join(labelled, "host", "left").fillna(0, ["n", "good"]).select("host", domain, suffix, "n", "good"))
    whole = rows.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    top = ((whole.good or 0) + 1) / ((whole.n or 0) + 2)

    def level(key: str, above: DataFrame | None) -> DataFrame:
        sums = rows.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good")) if key == "domain" else rows.groupBy(key).agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
        at = durable(sums.withColumn("m", F.lit(top)) if above is None else sums.join(above, "suffix"))
        k = _strength(at)
        return at.select(key, ((F.col("good") + k * F.col("m")) / (F.col("n") + k)).alias("m"))

    domains = level("domain", level("suffix", None))
    counts = rows.groupBy("domain").agg(F.count("*").alias("n_hosts"))
    at = durable(join_on_counted(rows, domains.join(counts, "domain"), ["domain"], "n_hosts"))
    k = _strength(at)
    a, b = F.col("good") + k * F.col("m"), F.col("n") - F.col("good") + k * (1 - F.col("m"))
    mean = a / (a + b)
    return at.select("host", mean.alias("mean"), (mean + Z * F.sqrt(mean * (1 - mean) / (a + b + 1))).alias("upper"))


def filter_urls(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] = (), least_good: float = LEAST_GOOD
) -> DataFrame:
    """All columns of ``pages`` with ``host, path, rule, verdict, good_mean, good_upper`` (lengthened by ``_`` if taken).

    ``outcomes(url, good)`` are labelled pages; null labels do not count. A rule decides where one fits; otherwise a page
    is blocked when the upper bound of its host's share of good pages is below ``least_good``. Null urls and urls without
    ``://`` have an empty host and path, and are judged like any host. One host may hold any share of the pages.
    """
    names = {}
    for name in ("host", "path", "rule", "verdict", "good_mean", "good_upper"):
        names[name] = fresh_name([*pages.columns, *names.values()], name)
    host, path = names["host"], names["path"]
    parsed = pages.withColumn(host, host_of(F.col("url"))).withColumn(path, path_of(F.col("url")))
    counts = parsed.groupBy(host).agg(F.count("*").alias("n_pages")).withColumnRenamed(host, "host")
    labelled = outcomes.where("good IS NOT NULL").select(host_of(F.col("url")).alias("host"), F.col("good").cast("bigint").alias("good"))
    n_pages = fresh_name([*pages.columns, *names.values()], "n_pages")
    known = reputations(labelled, counts.select("host")).join(counts, "host")
    known = known.select(F.col("host").alias(host), F.col("mean").alias(names["good_mean"]), F.col("upper").alias(names["good_upper"]), F.col("n_pages").alias(n_pages))
    joined = join_on_counted(parsed, known, [host], n_pages).drop(n_pages)
    rule, says = rule_of(F.col(host), F.col(path), rules)
    method = F.when(F.col(names["good_upper"]) < least_good, "block").otherwise("allow")
    out = joined.withColumn(names["rule"], rule).withColumn(names["verdict"], F.coalesce(says, method))
    return out.select(*pages.columns, *names.values())
