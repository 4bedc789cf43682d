"""URL filter: rules first, then trust and distrust over the link graph of hosts.

A url takes the verdict of the longest rule that fits its host and path.  For the other
urls a host's verdict comes from two personalised PageRanks over edges between hosts: trust
starts at hosts whose pages the rules allow and follows links, distrust starts at hosts
whose pages the rules block and follows links backwards, as who links to a blocked host is
suspect.  A host's seed is the share of its pages with such a verdict.  A host is blocked
when its distrust is at least ``MIN_DISTRUST`` and exceeds its trust; a host that neither
reaches is allowed; equal trust and distrust allow.

Edges are distinct pairs of hosts with the number of links, so the iteration works on
hosts, not pages; each step is a join and a sum of what the last step moved, and the ranks
are written to the shared folder every few steps.  Steps end when what still moves is less
than ``RESIDUAL`` of the seeds, so a chain of links is followed as far as it matters.

A url that is null or has no ``://`` has an empty host and path, no rule, and is allowed.
Null pages have no links.  Repeated rows each count as a page.  An empty table gives an
empty result; further columns are ignored.  A very long page is searched for links as a whole, in its row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.llm.common import rows_with
from lodestat.session import materialize

#: (verdict, host and path).  A rule holds for its host and all subdomains, for paths that begin with its path.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
DAMPING = 0.85
#: Part of the seeds that may still be on its way at the end.
RESIDUAL = 1e-6
#: Ranks are written out, and the rest is looked at, after so many steps.
CUT_EVERY = 6
#: In parts of what a host gets whose own pages are all blocked.
MIN_DISTRUST = 0.5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def apply_rules(rows: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``rows`` (with ``host`` and ``path``) plus ``rule`` and ``rule_verdict`` of the longest rule that fits."""
    best = F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    for verdict, rule in rules:
        host, _, path = rule.partition("/")
        path = "/" + path
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(path))
        best = F.greatest(best, F.when(fits, F.struct(F.lit(len(rule)).alias("size"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return rows.withColumn("best", best).select(*rows.columns, "best.rule", F.col("best.verdict").alias("rule_verdict"))


def host_edges(pages: DataFrame) -> DataFrame:
    """``a``, ``b``, ``links``: links from pages of host ``a`` to other hosts ``b``, from the whole pages."""
    links = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(r"""(?i)href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""), F.lit(1))
    # A page's links are counted by host before they leave its row.
    found = pages.where("host != ''").select(F.col("host").alias("a"), F.explode(links).alias("b"))
    found = found.select("a", F.translate("b", _UPPER, _LOWER).alias("b")).where("a != b")
    return found.groupBy("a", "b").agg(F.count(F.lit(1)).alias("links"))


def propagate(seeds: DataFrame, edges: DataFrame, residual: float = RESIDUAL) -> DataFrame:
    """``host`` and ``rank``: a random walk from the seeds (``host``, ``seed``) along ``a`` to ``b``, damped.

    ``rank`` is a seed's own value plus damped shares of the ranks that link to it.  A host
    without links keeps nothing for others.
    """
    out = edges.groupBy("a").agg(F.sum("links").alias("all"))
    weighted = edges.join(out.withColumnRenamed("a", "of"), F.col("a") == F.col("of")).select(
        "a", "b", (F.col("links") / F.col("all")).alias("share"))
    weighted = materialize(weighted, "edges")
    ranks = seeds.select("host", F.col("seed").alias("rank"), F.col("seed").alias("moved"))
    start = seeds.agg(F.sum("seed")).first()[0] or 0.0
    if not start or weighted.isEmpty():
        return ranks.drop("moved")
    while True:  # what moves shrinks by the damping at least, so this ends
        for _ in range(CUT_EVERY):
            sent = ranks.where("moved > 0").join(weighted, F.col("host") == F.col("a")).select(
                F.col("b").alias("host"), F.lit(0.0).alias("rank"), (F.col("moved") * F.col("share") * DAMPING).alias("moved"))
            known = ranks.select("host", "rank", F.lit(0.0).alias("moved")).unionByName(sent)
            ranks = known.groupBy("host").agg((F.sum("rank") + F.sum("moved")).alias("rank"), F.sum("moved").alias("moved"))
        ranks = materialize(ranks, "ranks")
        if (ranks.agg(F.sum("moved")).first()[0] or 0.0) <= residual * start:
            return ranks.drop("moved")


def judge_hosts(ruled: DataFrame, edges: DataFrame) -> DataFrame:
    """``host``, ``trust``, ``distrust`` and ``blocked`` of every host of the pages or their links."""
    hosts = ruled.where("host != ''").groupBy("host").agg(
        (F.count_if(F.col("rule_verdict") == "allow") / F.count(F.lit(1))).alias("good"),
        (F.count_if(F.col("rule_verdict") == "block") / F.count(F.lit(1))).alias("bad"))
    hosts = materialize(hosts, "hosts")
    edges = materialize(edges, "links")
    trust = propagate(hosts.where("good > 0").select("host", F.col("good").alias("seed")), edges)
    backwards = edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "links")
    distrust = propagate(hosts.where("bad > 0").select("host", F.col("bad").alias("seed")), backwards)
    both = trust.select("host", F.col("rank").alias("trust"), F.lit(0.0).alias("distrust")).unionByName(
        distrust.select("host", F.lit(0.0).alias("trust"), F.col("rank").alias("distrust")))
    return both.groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")).withColumn(
        "blocked", (F.col("distrust") >= MIN_DISTRUST) & (F.col("distrust") > F.col("trust")))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``trust`` and ``distrust`` of every row."""
    rows = rows_with(pages, page_id=id_col, url=url_col, html=html_col)
    rows = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    ruled = materialize(apply_rules(rows.drop("html"), rules), "ruled")
    hosts = judge_hosts(ruled, host_edges(rows)).withColumnRenamed("host", "of")
    joined = ruled.join(hosts, F.col("host") == F.col("of"), "left")
    verdict = F.coalesce("rule_verdict", F.when(F.col("blocked"), "block").otherwise("allow"))
    return joined.select("page_id", "host", "path", "rule", verdict.alias("verdict"),
                         F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
