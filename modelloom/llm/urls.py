"""Verdicts on URLs: rules for hosts and paths, and trust carried along links between hosts.

Trust is a personalised PageRank from the hosts that rules allow, distrust one on the reversed
links from the hosts that rules block. Only DataFrame functions are used.
"""

from __future__ import annotations

import string
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modelloom.llm.common import Workspace


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?`` or ``#``, A-Z in lower case; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null if none does.

    A rule is (``allow`` or ``block``, host and path in one string); it fits its host and all
    subdomains where the path starts with its own. Of rules of one length the first listed wins.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(reversed(rules), key=lambda r: len(r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def host_links(df: DataFrame, html: str = "html") -> DataFrame:
    """(src, dst, n): how many links of the pages of one host lead to another host.

    ``df`` has a column ``host``. Links without a host stay within theirs and are left out.
    """
    found = F.regexp_extract_all(F.col(html), F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""), F.lit(1))
    target = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link")).otherwise(F.col("link"))
    return (
        df.select(F.col("host").alias("src"), F.explode(found).alias("link"))
        .select("src", host_of(target).alias("dst")).where("src <> dst and src <> '' and dst <> ''")
        .groupBy("src", "dst").agg(F.count("*").alias("n"))
    )


def personalised_rank(
    links: DataFrame, seeds: DataFrame, work: Workspace, name: str, damping: float = 0.85, tolerance: float = 1e-6
) -> DataFrame:
    """(host, rank) by power iteration from ``seeds`` (host, weight); the ranks add up to 1 at most.

    A host passes its rank along its links by their share. What hosts without links hold is
    not passed on. Each step is written, so a lost executor repeats one step. What changes falls by
    ``damping`` a step at least, so it ends, after about 100 steps with the values given, when all
    later steps together would change less than ``tolerance``.
    """
    total = seeds.agg(F.sum("weight")).first()[0]
    start = seeds.select("host", (F.col("weight") / (total or 1.0)).alias("seed"))
    start = work.keep(start, f"{name}seed")
    out = links.groupBy("src").agg(F.sum("n").alias("all"))
    shares = work.keep(links.join(out, "src").select("src", "dst", (F.col("n") / F.col("all")).alias("share")), f"{name}share")
    rank = start.select("host", F.col("seed").alias("rank"))
    if shares.isEmpty() or not total:
        return rank
    for step in count():
        passed = rank.join(shares, F.col("host") == F.col("src")).groupBy("dst").agg(F.sum(F.col("rank") * F.col("share")).alias("got"))
        new = start.join(passed, F.col("host") == F.col("dst"), "full").select(
            F.coalesce("host", "dst").alias("host"),
            ((1 - damping) * F.coalesce("seed", F.lit(0.0)) + damping * F.coalesce("got", F.lit(0.0))).alias("rank"),
        )
        new = work.keep(new, f"{name}rank{step}")
        old = rank.select(F.col("host").alias("_h"), F.col("rank").alias("_r"))
        change = new.join(old, F.col("host") == F.col("_h"), "full").agg(
            F.sum(F.abs(F.coalesce("rank", F.lit(0.0)) - F.coalesce("_r", F.lit(0.0))))
        ).first()[0]
        rank = new
        work.drop(f"{name}rank{step - 1}")
        if change is None or change * damping < tolerance * (1 - damping):
            return rank


def judge_urls(
    spark: SparkSession, df: DataFrame, rules: list[tuple[str, str]], work: Workspace, url: str = "url", html: str = "html",
    margin: float = 1.0, least: float = 1e-6,
) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``verdict``, ``trust`` and ``distrust`` to the rows of ``df``.

    The verdict is the longest fitting rule's. Without one it is ``block`` where the host's
    distrust is at least ``least`` and more than ``margin`` times its trust, else ``allow``. Seeds
    of trust are the hosts with pages that a rule allows, seeds of distrust those with pages that
    a rule blocks and none that one allows or that no rule fits, so a rule for one part of a host
    does not condemn the rest. Null URLs and those without ``://`` have empty host and path, fit no
    rule and are allowed. Columns of these names are replaced, others stay.
    """
    new = ("host", "path", "rule", "verdict", "trust", "distrust")
    mine = [c for c in df.columns if c.lower() not in new]
    base = df.select(*mine, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    ruled = base.withColumns({"rule": rule, "verdict": verdict})

    hosts = work.keep(ruled.where("host <> ''").groupBy("host").agg(
        F.count_if(F.col("verdict") == "allow").alias("allowed"), F.count_if(F.col("verdict") == "block").alias("blocked"),
        F.count("*").alias("pages"),
    ), "hosts")
    links = work.keep(host_links(ruled.select("host", F.col(html).alias("html"))), "links")
    trusted = hosts.where("allowed > 0").select("host", F.col("allowed").cast("double").alias("weight"))
    blocked = hosts.where("blocked = pages").select("host", F.col("blocked").cast("double").alias("weight"))
    back = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    trust = personalised_rank(links, trusted, work, "trust").withColumnRenamed("rank", "trust")
    distrust = personalised_rank(back, blocked, work, "distrust").withColumnRenamed("rank", "distrust")
    ranks = trust.join(distrust, "host", "full").select(
        F.col("host").alias("_host"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")
    )
    ranks = work.keep(ranks, "ranks")
    bad = (F.col("distrust") >= least) & (F.col("distrust") > margin * F.col("trust"))
    joined = ruled.join(ranks, F.col("host") == F.col("_host"), "left")
    return joined.select(
        *mine, "host", "path", "rule", F.coalesce("verdict", F.when(bad, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
