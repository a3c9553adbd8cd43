"""URL rules, and for urls without one a verdict per host from links: trust forwards, distrust backwards."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.session import pin

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """Lower-cased text after the first ``://`` up to a slash, question mark, hash sign or the end; else empty."""
    host = F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark, hash sign or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Name of the longest rule that fits, else null. Of equally long ones, the one listed first."""
    found = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(rule.name)).otherwise(found)
    return found


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Links between different hosts as (src, dst, n). A link that begins with ``//`` names a host too; other relative links
    stay on their host and are left out."""
    link = F.lit("(?i)href\\s*=\\s*[\"']?(//[^\"'\\s>]+|[^\"'\\s>]*://[^\"'\\s>]+)")
    hrefs = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), link, 1)
    pairs = pages.select(host_of(F.col(url)).alias("src"), F.explode(hrefs).alias("to"))
    whole = F.when(F.col("to").startswith("//"), F.concat(F.lit("http:"), "to")).otherwise(F.col("to"))
    pairs = pairs.select("src", host_of(whole).alias("dst"))
    return pairs.filter("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(
    edges: DataFrame, seeds: DataFrame, owner: str, damping: float = 0.85, rounds: int = 20, every: int = 5
) -> DataFrame:
    """Personalised PageRank with given start values: (host, seed) to (host, rank).

    rank(h) = (1 - damping) * seed(h) + damping * sum over edges src -> h of share * rank(src). ``owner`` names the end
    of an edge to which its share belongs, by which the shares of a host sum to 1; a host that owns no edge keeps its
    rank to itself. Lineage is cut every few rounds by a written table, which a lost executor reads again.
    """
    owners = edges.select(F.col(owner).alias("host"), F.lit(True).alias("owns")).distinct()
    hosts = pin(
        seeds.join(owners, "host", "left").select("host", "seed", F.coalesce("owns", F.lit(False)).alias("owns")), "hosts"
    )
    rank = hosts.select("host", F.col("seed").alias("rank"))
    for k in range(1, rounds + 1):
        arrived = (
            edges.join(rank, edges.src == rank.host)
            .groupBy("dst").agg(F.sum(F.col("rank") * F.col("share")).alias("got"))
            .withColumnRenamed("dst", "host")
        )
        kept = F.when(F.col("owns"), F.lit(0.0)).otherwise(F.col("rank"))
        rank = hosts.join(rank, "host").join(arrived, "host", "left").select(
            "host",
            ((1 - damping) * F.col("seed") + damping * (kept + F.coalesce("got", F.lit(0.0)))).alias("rank"),
        )
        if k % every == 0 or k == rounds:
            rank = pin(rank, "rank")
    return rank


def host_verdicts(
    pages: DataFrame, rules: list[Rule], url: str = "url", html: str = "html", damping: float = 0.85, rounds: int = 20,
    threshold: float = 0.25,
) -> DataFrame:
    """Trust, distrust and verdict of each host: (host, trust, distrust, verdict).

    Seeds are the shares of a host's pages that rules allow or block. Trust flows along links (personalised
    PageRank); distrust flows against them, so that a host is as suspect as the hosts it links to. Each host divides
    its rank by its number of links: outgoing for trust, and for distrust what a host takes over is the mean over the
    hosts it links to. A host is blocked where distrust exceeds trust by ``threshold``.
    """
    found = pages.select(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    name, allowed = rule_for(F.col("host"), F.col("path"), rules), [r.name for r in rules if r.verdict == "allow"]
    blocked = [r.name for r in rules if r.verdict != "allow"]
    seeds = found.filter("host <> ''").withColumn("rule", name).groupBy("host").agg(
        F.avg(F.coalesce(F.col("rule").isin(allowed), F.lit(False)).cast("double")).alias("trusted"),
        F.avg(F.coalesce(F.col("rule").isin(blocked), F.lit(False)).cast("double")).alias("suspect"),
    )
    edges = pin(links(pages, url, html), "links")
    named = edges.select(F.col("src").alias("host")).union(edges.select("dst")).distinct()
    seeds = pin(named.join(seeds, "host", "full_outer").na.fill(0.0), "seeds")
    out = edges.groupBy("src").agg(F.sum("n").alias("all"))
    shares = pin(edges.join(out, "src").select("src", "dst", (F.col("n") / F.col("all")).alias("share")), "shares")
    trust = propagate(shares, seeds.select("host", F.col("trusted").alias("seed")), "src", damping, rounds)
    back = shares.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "share")
    distrust = propagate(back, seeds.select("host", F.col("suspect").alias("seed")), "dst", damping, rounds)
    both = trust.withColumnRenamed("rank", "trust").join(distrust.withColumnRenamed("rank", "distrust"), "host")
    # sums of doubles arrive in any order: compare what all orders agree on
    far = F.round(F.col("distrust") - F.col("trust"), 9) >= threshold
    return both.withColumn("verdict", F.when(far, "block").otherwise("allow"))


def judge_urls(
    pages: DataFrame, rules: list[Rule], id: str = "page_id", url: str = "url", html: str = "html", **settings
) -> DataFrame:
    """One row per page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``.

    The longest fitting rule decides; a page without one gets its host's verdict from the link graph. A null url or
    one without ``://`` has an empty host and path, fits no rule and is allowed, as no host speaks against it. A null
    html has no links. Repeated rows are judged each; extra columns are ignored.
    """
    hosts = host_verdicts(pages, rules, url, html, **settings).select("host", F.col("verdict").alias("by_links"))
    found = pages.select(
        F.col(id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")
    ).withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce("by_links", F.lit("allow"))
    for rule in rules:
        verdict = F.when(F.col("rule") == rule.name, F.lit(rule.verdict)).otherwise(verdict)
    return found.join(hosts, "host", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))
