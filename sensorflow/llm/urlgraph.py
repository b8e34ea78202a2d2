"""URL filters: block and allow rules, and trust that spreads over the link graph between hosts.

*Rules.* A rule ``host/path`` fits its host and all subdomains if the url's path starts with the rule's path;
the longest wins (of equally long ones the first in text order).

*Graph.* Hosts are joined by the absolute links in the pages' html (relative links stay on their host and say
nothing) and, with ``domain_edges``, by an edge in each direction between a host and its parent domain.
Personalised PageRank starts from the hosts of allowed pages and follows links; distrust starts from the hosts
of blocked pages and follows links backwards. Both spread in one iteration over (kind, host) rows.

*Threshold.* Pages that no rule fits are blocked if their host's distrust is at least ``min_distrust`` of the
uniform share and exceeds ``ratio`` times its trust.

*Scale.* Pages are read once; links are counted per (page host, link host) with partial sums before any
shuffle, so a host with a third of all pages is a few rows. Each iteration joins ranks to edges by host, with
hot hosts split by adaptive execution. Ranks are checkpointed in the shared folder. Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import ascii_lower, col, pick, salted_join, staged
from sensorflow.session import checkpoint_root

#: The rules of the registered query (fixed values).
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))
    return ascii_lower(F.coalesce(rest, F.lit("")))


def path_of(url: Column) -> Column:
    """From behind the host up to ``?``, ``#`` or the end; else empty."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1))
    return F.coalesce(rest, F.lit(""))


def rule_for(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """The struct (verdict, rule) of the longest rule that fits, else null."""
    out = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        domain, _, tail = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + tail)
        found = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))
        out = F.when(fits, found) if out is None else out.when(fits, found)
    return out if out is not None else F.lit(None).cast("struct<verdict:string,rule:string>")


def host_edges(hosts: DataFrame, links: DataFrame, domain_edges: bool) -> DataFrame:
    """``src, dst, n`` between different hosts, counted; ``links`` has src, dst, n."""
    edges = links.filter("src <> dst and src <> '' and dst <> ''").groupBy("src", "dst").agg(F.sum("n").alias("n"))
    if domain_edges:
        labels = F.split("host", r"\.")
        chain = F.transform(F.sequence(F.lit(1), F.size(labels) - 1),
                            lambda k: F.struct(F.array_join(F.slice(labels, k, F.size(labels)), ".").alias("low"),
                                               F.array_join(F.slice(labels, k + 1, F.size(labels)), ".").alias("high")))
        up = hosts.filter("host like '%.%'").select(F.explode(chain).alias("e")).select("e.low", "e.high").distinct() \
            .filter("low <> '' and high <> ''")
        both = up.select(F.col("low").alias("src"), F.col("high").alias("dst")) \
            .unionByName(up.select(F.col("high").alias("src"), F.col("low").alias("dst")))
        edges = edges.unionByName(both.withColumn("n", F.lit(1).cast("bigint"))).groupBy("src", "dst").agg(F.sum("n").alias("n"))
    return edges


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, rounds: int = 12, every: int = 4) -> DataFrame:
    """``host, trust, distrust``: PageRank of ``seeds`` (kind, host, weight) over ``edges`` (src, dst, n).

    Kind ``trust`` follows links, ``distrust`` follows them backwards. Seed weights are scaled to 1 per kind;
    rank at a host without onward edges ends there.
    """
    checkpoint_root(edges.sparkSession)
    steps = edges.select(F.lit("trust").alias("kind"), "src", "dst", "n") \
        .unionByName(edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n"))
    out = steps.groupBy("kind", "src").agg(F.sum("n").alias("total"))
    steps = staged(steps.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("total")).alias("share")), "url-steps")
    total = seeds.groupBy("kind").agg(F.sum("weight").alias("total"))
    start = staged(seeds.groupBy("kind", "host").agg(F.sum("weight").alias("weight")).join(total, "kind")
                   .select("kind", "host", (F.col("weight") / F.col("total")).alias("base")), "url-seeds")
    rank = start.select("kind", "host", F.col("base").alias("score"))
    for k in range(rounds):
        moved = rank.withColumnRenamed("host", "src").join(steps, ["kind", "src"]) \
            .select("kind", F.col("dst").alias("host"), (F.col("score") * F.col("share") * damping).alias("score"))
        rank = moved.unionByName(start.select("kind", "host", (F.col("base") * (1.0 - damping)).alias("score"))) \
            .groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if (k + 1) % every == 0:
            rank = rank.checkpoint()
    side = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(0.0))
    return rank.groupBy("host").agg(side("trust").alias("trust"), side("distrust").alias("distrust"))


def url_filter(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules: tuple = RULES,
               domain_edges: bool = True, damping: float = 0.85, rounds: int = 12, ratio: float = 1.5,
               min_distrust: float = 0.01) -> DataFrame:
    """``id, host, path, rule, verdict, trust, distrust``, one row per row of ``pages``.

    A null url or one without ``://`` has an empty host and path and is allowed: no rule fits it and it has no
    place in the graph. Null html has no links. Repeated rows keep a row each and count as often in the seeds.
    An empty table gives an empty result; extra columns are ignored. Scores are rounded to 9 digits before
    they are compared, so the order in which tasks add up does not matter.
    """
    p = pick(pages, id=id_col, url=url_col, html=html_col)
    href = r"""(?i)href\s*=\s*["']?(?:https?:)?//([^/?#"'\s>]+)"""
    read = staged(p.select("id", host_of(col("url")).alias("host"), path_of(col("url")).alias("path"),
                           F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(href), F.lit(1)).alias("links"))
                  .withColumn("found", rule_for(col("host"), col("path"), rules)), "url-pages")
    links = read.select(F.col("host").alias("src"), F.explode("links").alias("dst")) \
        .select("src", ascii_lower(F.regexp_replace("dst", r"^[^@]*@", "")).alias("dst")) \
        .groupBy("src", "dst").agg(F.count("*").alias("n"))
    per_host = staged(read.filter("host <> ''").groupBy("host").agg(
        F.count("*").alias("n"), *[F.count(F.when(F.col("found.verdict") == v, 1)).alias(v) for v in ("allow", "block")]), "url-hosts")
    edges = staged(host_edges(per_host.select("host"), links, domain_edges), "url-edges")
    seeds = per_host.select(F.lit("trust").alias("kind"), "host", F.col("allow").alias("weight")) \
        .unionByName(per_host.select(F.lit("distrust").alias("kind"), "host", F.col("block").alias("weight"))).filter("weight > 0")
    score = propagate(edges, seeds, damping, rounds)
    scored = per_host.select("host").join(score, "host", "left") \
        .select("host", *[F.round(F.coalesce(c, F.lit(0.0)), 9).alias(c) for c in ("trust", "distrust")])
    n = max(1, per_host.count())
    bad = (F.col("distrust") * n >= min_distrust) & (F.col("distrust") > ratio * F.col("trust"))
    return salted_join(read.drop("links"), scored, ["host"], F.col("id")) \
        .select("id", "host", "path", F.col("found.rule").alias("rule"),
                F.coalesce(F.col("found.verdict"), F.when(bad, "block").otherwise("allow")).alias("verdict"),
                F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
