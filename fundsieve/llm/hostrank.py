"""URL verdicts: path rules first, then link-graph propagation over hosts.

Trust is a personalised PageRank from hosts with allowed pages along links; distrust is one from hosts with blocked
pages along reversed links. A host whose distrust exceeds `threshold` times its trust is blocked; a page without a rule
gets its host's verdict, and so does a host that neither reaches: allow.

Cases: a null url, or one without `://`, has empty host and path and no rule; its host is '' like any other host; a
null html has no links; repeated rows repeat; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundsieve.llm.tables import cut

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


def ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(url, URL, 1)), F.regexp_extract(url, URL, 2)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest (verdict, host, path) rule that fits, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block", r[1:])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst): hosts whose pages link to another host."""
    host, _ = host_and_path(F.col("url"))
    links = pages.select(host.alias("src"), F.explode(F.array_distinct(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1)))).alias("dst"))
    return links.select("src", ascii_lower(F.col("dst")).alias("dst")).where("src <> dst").distinct()


def propagate(edges: DataFrame, seeds: DataFrame, damping: float, tolerance: float, rounds: int) -> DataFrame:
    """(kind, host, rank): PageRank of each kind of edges(kind, src, dst) from seeds(kind, host, seed). Ranks of hosts without links go back to the seeds, which scales all ranks alike.

    Ranks only grow from round to round, so the growth of their sum is their summed change. Rounds end when it is within
    the tolerance and no new host was reached; more than `rounds` of them fail.
    """
    # Written tables on both sides of a join: adaptive execution can then split the rows of a hub.
    edges = cut(edges)
    degree = cut(edges.groupBy("kind", "src").agg(F.count(F.lit(1)).alias("links")))
    edges = cut(edges.join(degree, ["kind", "src"]).select("kind", F.col("src").alias("host"), "dst", (damping / F.col("links")).alias("share")))
    start = seeds.select("kind", "host", ((1 - damping) * F.col("seed")).alias("rank"))
    ranks = start
    if not edges.isEmpty():
        size = lambda r: r.agg(F.count(F.lit(1)).alias("hosts"), F.coalesce(F.sum("rank"), F.lit(0.0)).alias("total")).first()
        before = size(start)
        for _ in range(rounds):
            moved = ranks.join(edges, ["kind", "host"]).select("kind", F.col("dst").alias("host"), (F.col("rank") * F.col("share")).alias("rank"))
            ranks = cut(start.unionByName(moved).groupBy("kind", "host").agg(F.sum("rank").alias("rank")))
            now = size(ranks)
            if now.hosts == before.hosts and now.total - before.total <= tolerance:
                break
            before = now
        else:
            raise RuntimeError(f"ranks still changed after {rounds} rounds")
    total = ranks.groupBy("kind").agg(F.sum("rank").alias("total"))
    return ranks.join(F.broadcast(total), "kind").select("kind", "host", (F.col("rank") / F.col("total")).alias("rank"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], threshold: float = 1.0, damping: float = 0.85, tolerance: float = 1e-6, rounds: int = 1000) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every row."""
    host, path = host_and_path(F.col("url"))
    named = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    named = named.select("*", rule.alias("rule"), verdict.alias("by_rule"))
    kinds = named.groupBy("host").agg(F.count_if(F.col("by_rule") == "allow").alias("trust"), F.count_if(F.col("by_rule") == "block").alias("distrust"))
    seeds = kinds.select("host", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("n")) for k in ("trust", "distrust")])).alias("e")).select("host", "e.*").where("n > 0")
    seeds = cut(seeds)
    total = seeds.groupBy("kind").agg(F.sum("n").alias("total"))
    seeds = seeds.join(F.broadcast(total), "kind").select("kind", "host", (F.col("n") / F.col("total")).alias("seed"))
    links = host_edges(pages)
    edges = links.select(F.lit("trust").alias("kind"), "src", "dst").union(links.select(F.lit("distrust"), F.col("dst"), F.col("src")))
    ranks = propagate(edges, seeds, damping, tolerance, rounds)
    of = lambda k: F.coalesce(F.max(F.when(F.col("kind") == k, F.col("rank"))), F.lit(0.0)).alias(k)
    hosts = cut(ranks.groupBy("host").agg(of("trust"), of("distrust")))
    trust, distrust = (F.coalesce(k, F.lit(0.0)) for k in ("trust", "distrust"))
    by_host = F.when(distrust > threshold * trust, "block").otherwise("allow")
    return named.join(hosts, "host", "left").select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_host).alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))
