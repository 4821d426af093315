"""URL filter: path rules, and trust and distrust propagated over the host link graph.

A page's rule is the longest (host, path) rule that fits.  Pages without a rule get the verdict of
their host: trust flows from the hosts of allowed pages along links (personalised PageRank),
distrust flows from the hosts of blocked pages against the links (a page that links to a
blocked host is suspect), and a host whose distrust share exceeds ``max_distrust`` is blocked.

Links are the href and src attributes of a page; a relative link stays on its host and carries nothing.  Links are
counted per host pair before any iteration, and an iteration joins ranks and edges by host.
A host without links passes nothing on; mass is not redistributed, as only the ratio counts.

Defined cases: a null url or one without ``://`` has empty host and path, no rule, and is allowed (there is nothing to
distrust); a null html has no links; a host that neither seed reaches is allowed; repeated pages count
as often as they occur; an empty table gives an empty table.  DataFrame functions only.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordforge.llm.common import ascii_lower, cut
from recordforge.operators.link import spread_join

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"(?i)\b(?:href|src)\s*=\s*[\"']?\s*([^\"'\s>]+)"


def url_host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def match_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, else null.  Rules: (verdict, host, path)."""
    out = None
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def host_edges(pages: DataFrame, host: Column, html: Column) -> DataFrame:
    """(src, dst, n): links between different hosts, counted."""
    return (pages.select(host.alias("src"), F.explode(F.regexp_extract_all(html, F.lit(LINK), F.lit(1))).alias("link"))
            .withColumn("link", F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link")).otherwise(F.col("link")))
            .withColumn("dst", url_host(F.when(F.col("link").rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), F.col("link"))))
            .where((F.col("dst") != "") & (F.col("src") != "") & (F.col("src") != F.col("dst")))
            .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, rounds: int | None = None, tolerance: float = 1e-6) -> DataFrame:
    """Ranks (kind, host, rank): ``trust`` along the edges, ``distrust`` against them.

    ``seeds`` holds (kind, host, seed) with seeds of a kind adding up to 1.  Stops when no
    rank changes by more than the share ``tolerance`` of itself, so every host that a seed reaches has its rank, however
    small.  Rounds: the longest way from a seed, and about log(tolerance) / log(damping) more (85 by default) where links run in
    rings.  Ranks are doubles: at a damping of 0.85 what a single link passes on vanishes after some 4,300 links (earlier
    where hosts have many links), which also ends the rounds; hosts beyond count as not reached.  ``rounds`` may set a limit.
    """
    walk = edges.select(F.lit("trust").alias("kind"), F.col("src").alias("from"), F.col("dst").alias("to"), "n").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("from"), F.col("src").alias("to"), "n"))
    out = walk.groupBy("kind", "from").agg(F.sum("n").alias("all"))
    walk = cut(spread_join(walk, out, ["kind", "from"]).select("kind", "from", "to", (F.col("n") / F.col("all")).alias("share")), "edges")
    written = ranks = cut(seeds.select("kind", "host", F.col("seed").alias("rank"), "seed"), "ranks")
    for _ in range(rounds) if rounds is not None else itertools.count():
        moved = (ranks.where("rank > 0").join(walk, (ranks.kind == walk.kind) & (F.col("host") == F.col("from")))
                 .select(walk.kind, F.col("to").alias("host"), (damping * F.col("rank") * F.col("share")).alias("rank"),
                         F.lit(0.0).alias("seed"), F.lit(0.0).alias("old")))
        stay = ranks.select("kind", "host", ((1 - damping) * F.col("seed")).alias("rank"), "seed", F.col("rank").alias("old"))
        ranks = written = cut(stay.unionByName(moved).groupBy("kind", "host").agg(
            F.sum("rank").alias("rank"), F.sum("seed").alias("seed"), F.sum("old").alias("old")), "ranks", replaces=(written,))
        change = ranks.where("rank > 0").agg(F.max(F.abs(F.col("rank") - F.col("old")) / F.col("rank"))).first()[0] or 0.0
        ranks = ranks.drop("old")
        if change < tolerance:
            break
    return ranks.select("kind", "host", "rank")


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", max_distrust: float = 0.5, damping: float = 0.85) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, distrust (share of the host, null if not reached)."""
    host, path = url_host(F.col(url_col)), url_path(F.col(url_col))
    judged = pages.select(F.col(id_col).alias("__id"), host.alias("__host"), path.alias("__path")).withColumn(
        "__rule", match_rule(F.col("__host"), F.col("__path"), rules))
    seen = (judged.where("__rule is not null and __host != ''")
            .groupBy(F.when(F.col("__rule.verdict") == "allow", "trust").otherwise("distrust").alias("kind"),
                     F.col("__host").alias("host")).agg(F.count(F.lit(1)).alias("n")))
    sums = seen.groupBy("kind").agg(F.sum("n").alias("all"))  # two rows
    seeds = seen.join(F.broadcast(sums), "kind").select("kind", "host", (F.col("n") / F.col("all")).alias("seed"))
    ranks = propagate(host_edges(pages, host, F.col(html_col)), seeds, damping)
    trust = F.sum(F.when(F.col("kind") == "trust", F.col("rank")).otherwise(0.0))
    distrust = F.sum(F.when(F.col("kind") == "distrust", F.col("rank")).otherwise(0.0))
    hosts = cut(ranks.groupBy(F.col("host").alias("__h")).agg((distrust / (trust + distrust)).alias("__distrust")), "hosts")
    own = F.when(F.col("__distrust") > max_distrust, "block").otherwise("allow")
    return (judged.join(hosts, F.col("__host") == F.col("__h"), "left")
            .select(F.col("__id").alias(id_col), F.col("__host").alias("host"), F.col("__path").alias("path"),
                    F.col("__rule.rule").alias("rule"), F.coalesce(F.col("__rule.verdict"), own).alias("verdict"),
                    F.col("__distrust").alias("distrust")))
