"""URL filters: longest-rule lists, and an empirical-Bayes host reputation.

Rules are (host, path) pairs; a rule fits its host and all subdomains when the
path starts with the rule's path, and the longest fitting one wins.  Pages
without a rule are judged by their host's reputation: labelled outcomes (bad or
good) are shrunk through beta-binomial priors along suffix, registered domain
and host.  The overall rate is the prior of a suffix, the posterior mean of the
suffix that of its domains, and that of a domain the prior of its hosts.  What a
prior is worth, in observations, is estimated from the outcomes at each level by
moments: how much more the rates of suffixes, of domains within their suffix and
of hosts within their domain differ than chance would make them (Kleinman's
estimate, pooled over parents; ``STRENGTHS`` bounds it, ``STRENGTH`` stands in
where no parent has two labelled children).  A host is blocked when its beta
posterior puts ``confidence`` or more on rates above ``limit``, that is when the
lower bound of its rate at that confidence is above it.  The posterior's share
is integrated over the log-odds, where the density has no poles, by Simpson's
rule on both sides of the limit.  The suffix is the last label of the host, the
registered domain its last two (no public suffix list is shipped).

All counts are partial aggregates; the tables are joined by key and pages meet
their host's verdict in a shuffle join, which can be split when skewed.

Defined cases: null urls and urls without ``://`` have empty host and path and
get no rule; they share the reputation of the empty host; pages without a label
count nowhere; label rows that repeat an id count as often; null labels are not
counted; without any label every host gets the neutral prior 1/2.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portrait.session import scratch_path

STRENGTH = 10.0
STRENGTHS = (0.5, 10_000.0)
CONFIDENCE = 0.95
LIMIT = 0.5
STEPS = 128            # of Simpson's rule, on each side of the limit


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def domain_of(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest fitting rule, null without one;
    ``rules`` are (verdict, host, path), at equal length the first wins."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _posterior(n: Column, bad: Column, mean: Column, strength: Column) -> Column:
    return (bad + strength * mean) / (n + strength)


def _strength(groups: DataFrame, *parent: str) -> Column:
    """What the prior of ``groups`` (n, bad; children of ``parent``) is worth, in
    observations: a scalar subquery."""
    per = groups.filter("n > 0").groupBy(*parent).agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("w"), F.sum(F.col("n") * F.col("n")).alias("q"), F.sum("bad").alias("b"),
        F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("s"))
    pq = F.col("b") / F.col("w") * (1 - F.col("b") / F.col("w"))
    spare = F.col("s") - F.col("b") * F.col("b") / F.col("w") - pq * (F.col("k") - 1)
    room = pq * (F.col("w") - F.col("q") / F.col("w") - (F.col("k") - 1))
    low, high = (1 / (1 + m) for m in reversed(STRENGTHS))
    within = F.greatest(F.least(F.col("spare") / F.col("room"), F.lit(high)), F.lit(low))
    return per.agg(F.sum(spare).alias("spare"), F.sum(room).alias("room")).select(
        F.when(F.col("room") > 0, 1 / within - 1).otherwise(F.lit(STRENGTH))).scalar()


def share_above(a: Column, b: Column, limit: float, steps: int = STEPS) -> Column:
    """The share of a beta distribution above ``limit``."""
    cut = math.log(limit / (1 - limit))
    mode, wide = F.log(a / b), 8 * F.sqrt(1 / a + 1 / b)
    low, high = mode - wide - 30 / a, mode + wide + 30 / b       # beyond them nothing is left
    height = lambda y: a * y - (a + b) * (F.greatest(y, F.lit(0.0)) + F.log(1 + F.exp(-F.abs(y))))
    top = height(mode)

    def side(start: Column, stop: Column) -> Column:
        step = (stop - start) / steps
        weight = lambda i: F.when((i == 0) | (i == steps), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
        return step * F.aggregate(F.sequence(F.lit(0), F.lit(steps)), F.lit(0.0),
                                  lambda s, i: s + weight(i) * F.exp(height(start + i * step) - top))
    below, above = side(low, F.lit(cut)), side(F.lit(cut), high)
    return F.when(low >= cut, 1.0).when(high <= cut, 0.0).otherwise(above / (below + above))


def host_reputation(hosts: DataFrame, confidence: float = CONFIDENCE, limit: float = LIMIT) -> DataFrame:
    """``hosts``: host, n and bad (labelled pages, bad ones), one row a host.
    Returns host, n, bad, mean, above (the posterior's share above the limit) and blocked."""
    h = hosts.select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"),
                     F.col("n").cast("double").alias("n"), F.col("bad").cast("double").alias("bad"))
    counts = lambda *by: h.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains, suffixes = counts("domain", "suffix"), counts("suffix")
    rate = h.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).select(
        F.when(F.col("n") > 0, (F.col("bad") + 0.5) / (F.col("n") + 1)).otherwise(0.5)).scalar()
    worth = [_strength(suffixes), _strength(domains, "suffix"), _strength(h, "domain")]
    suffix = suffixes.select("suffix", _posterior(F.col("n"), F.col("bad"), rate, worth[0]).alias("suffix_mean"))
    domain = domains.join(suffix, "suffix").select(
        "domain", _posterior(F.col("n"), F.col("bad"), F.col("suffix_mean"), worth[1]).alias("prior"))
    out = h.join(domain, "domain").withColumn("worth", worth[2])
    out = out.select("host", "n", "bad", _posterior(F.col("n"), F.col("bad"), F.col("prior"), F.col("worth")).alias("mean"),
                     (F.col("bad") + F.col("worth") * F.col("prior")).alias("a"),
                     (F.col("n") - F.col("bad") + F.col("worth") * (1 - F.col("prior"))).alias("b"))
    return out.withColumn("above", share_above(F.col("a"), F.col("b"), limit)).select(
        "host", "n", "bad", "mean", "above", (F.col("above") >= confidence).alias("blocked"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id",
          url_col: str = "url", outcome_id_col: str = "page_id", bad_col: str = "bad", confidence: float = CONFIDENCE,
          limit: float = LIMIT) -> DataFrame:
    """One row per page: host, path, rule, verdict and the host's posterior.
    ``outcomes``: page id and whether the page is bad (boolean)."""
    p = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"),
                     path_of(F.col(url_col)).alias("path"))
    o = (outcomes.filter(F.col(bad_col).isNotNull())
         .groupBy(F.col(outcome_id_col).alias("page_id"))
         .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(bad_col).cast("long")).alias("bad")))
    seen = _stored(p.join(o, "page_id", "left").groupBy("host").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                                                                    F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")), "hosts")
    known = _stored(host_reputation(seen, confidence, limit), "host-reputation")
    ruled = p.withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    return ruled.join(known, "host").select(
        "page_id", "host", "path", F.col("r.rule").alias("rule"),
        F.coalesce("r.verdict", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"),
        F.col("mean").alias("bad_mean"), F.col("above").alias("bad_above"))


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
