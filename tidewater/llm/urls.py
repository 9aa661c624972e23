"""URL filters: rules, then trust and distrust spread over links between hosts."""

from __future__ import annotations

import string
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import table, written

# Verdict, host and path of the rules of the query.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
DAMPING = 0.85
# Steps go on until all further ones together move no value by more.
TOLERANCE = 0.01
# A host whose distrust is above its trust by this is blocked. A host that a rule blocks
# as a whole has a distrust of 1 or more.
THRESHOLD = 0.5
# What a page judged by a rule for a part of its host says of the whole host, against a
# page judged by a rule for all of it: too little to block the host by itself.
PART_WEIGHT = 0.25
# Hosts whose rules or verdicts may be sent to every executor.
BROADCAST_HOSTS = 200_000


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _if_small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_HOSTS else df


def rules_of_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """host with ``rules``, those for it or a domain above it, the longest first.

    ``rules`` has verdict, host and path. A host is looked up under each of its
    suffixes, so the join is on equality, whatever the number of rules.
    """
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    found = hosts.select("host", F.explode(suffixes).alias("suffix")).join(
        rules.select(
            F.col("host").alias("suffix"),
            F.struct(
                (-F.length(F.concat("host", "path"))).alias("order"),
                F.concat("host", "path").alias("rule"), "path", "verdict",
            ).alias("r"),
        ),
        "suffix",
    )
    return found.groupBy("host").agg(F.sort_array(F.collect_set("r")).alias("rules"))


def host_links(pages: DataFrame, content: str = "html") -> DataFrame:
    """src, dst and n: links from ``pages`` (host, content) to other hosts."""
    targets = F.regexp_extract_all(
        F.coalesce(content, F.lit("")),
        F.lit(r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""),
        F.lit(1),
    )
    links = pages.select(F.col("host").alias("src"), F.explode(targets).alias("dst"))
    return (
        links.select("src", F.translate("dst", string.ascii_uppercase, string.ascii_lowercase).alias("dst"))
        .where("src <> '' AND dst <> src")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("n"))
    )


def spread(links: DataFrame, seeds: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """host, trust and distrust: personalised PageRank from ``seeds`` (host, trust, distrust).

    Trust goes along the links and distrust against them, a share to each neighbour by
    its number of links. Values are in units of a seed's own: a seed without links
    keeps its value. What a step hands on, all hosts together, is at most DAMPING times
    what the step before did; steps end once all that could follow sums to ``tolerance``,
    so their number grows with the logarithm of the seeds and not with the graph. Hosts
    of equal names are one; null or negative seeds count as none.
    """
    both = links.select("src", "dst", "n", F.lit("trust").alias("kind")).unionByName(
        links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n", F.lit("distrust").alias("kind"))
    )
    out = both.groupBy("src", "kind").agg(F.sum("n").alias("all"))
    edges = written(both.join(out, ["src", "kind"]).select("src", "dst", "kind", (F.col("n") / F.col("all")).alias("w")), "url-links")
    seeded = seeds.select("host", F.explode(F.create_map(
        F.lit("trust"), F.col("trust"), F.lit("distrust"), F.col("distrust")
    )).alias("kind", "value")).where("value > 0")
    # A table a step: what each host was handed by it.
    handed = [written(seeded.groupBy("host", "kind").agg(F.sum("value").alias("value")), "url-seeds")]
    while not edges.isEmpty():
        before = handed[-1].select(F.col("host").alias("src"), "kind", "value")
        step = (
            edges.join(before, ["src", "kind"])
            .groupBy(F.col("dst").alias("host"), "kind")
            .agg(F.sum(F.col("w") * F.col("value") * DAMPING).alias("value"))
        )
        handed.append(written(step, "url-step"))
        total = handed[-1].agg(F.sum("value")).first()[0] or 0.0
        if total * DAMPING / (1 - DAMPING) <= tolerance:
            break
    whole = reduce(DataFrame.unionByName, handed)
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("value"))), F.lit(0.0))
    return whole.groupBy("host").agg(of("trust").alias("trust"), of("distrust").alias("distrust"))


def url_verdicts(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages`` (page_id, url, html).

    The longest rule that fits decides; of equally long ones the first in the order of
    host and path, then an allowing one. Other pages go by their host: a host is a seed of trust and distrust by the
    shares of its pages that rules allow and block, those of rules for a part of the host
    weighed by PART_WEIGHT. Both are spread over the links, and a host is blocked where
    distrust is above trust by THRESHOLD. A url that is null or has no ``://`` has an
    empty host and path and is allowed unless a rule fits. A null html has no links.
    Repeated rows are judged each; other columns are not read.
    """
    spark = pages.sparkSession
    wanted = pages.select("page_id", "html", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule_rows = spark.createDataFrame(list(rules), "verdict string, host string, path string")
    hosts = written(wanted.groupBy("host").agg(F.count("*").alias("pages")), "url-hosts")
    n_hosts = hosts.count()
    of_host = written(rules_of_hosts(hosts, rule_rows), "url-rules")
    fitting = F.filter("rules", lambda r: F.col("path").startswith(r["path"]))
    judged = (
        wanted.drop("html")
        .join(_if_small(of_host, n_hosts), "host", "left")
        .withColumn("_rule", F.get(fitting, F.lit(0)))
        .select("page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.col("_rule.verdict").alias("by_rule"),
            F.when(F.col("_rule.path") == "/", 1.0).otherwise(PART_WEIGHT).alias("weight"))
    )
    says = lambda verdict: F.sum(F.when(F.col("by_rule") == verdict, F.col("weight")).otherwise(0.0)) / F.count("*")
    seeds = judged.groupBy("host").agg(says("allow").alias("trust"), says("block").alias("distrust")).where("host <> ''")
    ranks = spread(host_links(wanted.select("host", "html")), seeds)
    blocked = written(ranks.where(F.col("distrust") - F.col("trust") >= THRESHOLD).select("host", F.lit(True).alias("bad")), "url-bad")
    return judged.join(_if_small(blocked, n_hosts), "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("by_rule", F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict"),
    )


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"))
