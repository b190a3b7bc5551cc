"""URL filter: explicit rules first, then link-graph propagation per host.

A rule (host, path prefix) fits its host and all subdomains; the longest fitting rule decides. For pages without a rule,
trust flows from hosts with allowed pages along links (personalised PageRank), distrust flows from hosts with blocked
pages against the links' direction (who links to blocked hosts is distrusted), and each host is judged by its two scores.

Only DataFrame operations are used. Host edges are summed before they move; each superstep is one written table in the
shared folder, so lost executors cost no more than a step. Unless a number of steps is asked for, they go on until the
scores have converged.

Edge cases: a null url or one without ``://`` has empty host and path, fits no rule and is allowed unless its (empty) host
is distrusted, which cannot happen as it never gets a seed or a link; null html has no links; repeated pages are judged
alike and count as often as they occur; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formflow.llm.columns import lower_ascii
from formflow.session import materialise


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Propagation:
    """``steps`` supersteps with the given damping; a host is blocked from ``threshold`` on, if distrust outweighs trust.

    With a ``tolerance`` there are as many supersteps as it takes, whatever ``steps`` is: the last one adds less than it
    to all hosts together. Each adds at most ``damping`` times what the one before added, so no score lacks more than
    tolerance * damping / (1 - damping).
    """

    steps: int = 8
    damping: float = 0.85
    threshold: float = 0.01
    tolerance: float | None = None

    def __post_init__(self) -> None:
        if self.tolerance is not None and not (self.tolerance > 0 and 0 <= self.damping < 1):
            raise ValueError("a tolerance must be positive and needs a damping from 0 to below 1")


CONVERGED = Propagation(tolerance=1e-5)


_LINK = r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.-]{0,31}:)?//([^/?#"'\s<>]+)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty if there is no host part."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, else null. ``rules`` is a short configured list."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): pages of host src that link to the other host dst."""
    links = pages.select(host_of(F.col("url")).alias("src"), F.explode(F.array_distinct(F.transform(
        F.regexp_extract_all(F.coalesce(F.col("html").cast("string"), F.lit("")), F.lit(_LINK), 1), lower_ascii))).alias("dst"))
    return links.where("src <> dst and src <> '' and dst <> ''").groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, how: Propagation = CONVERGED) -> DataFrame:
    """(host, trust, distrust) after the supersteps. ``seeds``: one row (host, trust, distrust) per host with a seed.

    Trust of a host goes to the hosts it links to, in proportion to the weights; distrust goes to the hosts that link to
    it. A host without further edges passes nothing on. A superstep passes on what the one before added.
    """
    sent = edges.groupBy("src").agg(F.sum("weight").alias("sent"))
    got = edges.groupBy("dst").agg(F.sum("weight").alias("got"))
    shares = materialise(edges.join(sent, "src").join(got, "dst").select(
        "src", "dst", (F.col("weight") / F.col("sent")).alias("forward"), (F.col("weight") / F.col("got")).alias("backward")), "host-shares")
    none, d = F.lit(0.0), how.damping
    named = lambda host, trust, distrust, more, worse: (
        host.alias("host"), trust.alias("trust"), distrust.alias("distrust"), more.alias("more"), worse.alias("worse"))
    host, trust, distrust = F.col("host"), F.col("trust"), F.col("distrust")
    scores = seeds.select(*named(host, (1 - d) * trust, (1 - d) * distrust, (1 - d) * trust, (1 - d) * distrust))
    step = 0
    while how.tolerance is not None or step < how.steps:
        more, worse = d * F.col("more") * F.col("forward"), d * F.col("worse") * F.col("backward")
        forth = shares.join(scores.where("more > 0"), shares.src == scores.host).select(*named(F.col("dst"), more, none, more, none))
        back = shares.join(scores.where("worse > 0"), shares.dst == scores.host).select(*named(F.col("src"), none, worse, none, worse))
        scores = materialise(scores.select(*named(host, trust, distrust, none, none)).unionByName(forth).unionByName(back).groupBy("host").agg(
            *[F.sum(c).alias(c) for c in ("trust", "distrust", "more", "worse")]), "host-scores")
        step += 1
        if how.tolerance is not None:
            added = scores.agg(F.greatest(F.sum("more"), F.sum("worse")).alias("added")).first().added
            if added is None or added < how.tolerance:
                break
    return scores.select("host", "trust", "distrust")


def judge_pages(pages: DataFrame, rules: list[Rule], how: Propagation = CONVERGED) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, trust, distrust.

    A host's seed is the share of its pages that a rule allows (trust) or blocks (distrust).
    """
    url = F.col("url").cast("string")
    parsed = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    parsed = parsed.withColumn("found", fitting_rule(F.col("host"), F.col("path"), rules))
    parsed = parsed.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("ruled"))
    share = lambda verdict: F.avg(F.coalesce((F.col("ruled") == verdict).cast("double"), F.lit(0.0)))
    seeds = parsed.where("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    seeds = materialise(seeds.where("trust > 0 or distrust > 0"), "host-seeds")
    scores = propagate(host_edges(pages), seeds, how).withColumnRenamed("host", "__host")
    trust, distrust = (F.round(F.coalesce(F.col(c), F.lit(0.0)), 9) for c in ("trust", "distrust"))
    own = F.when((distrust >= how.threshold) & (distrust > trust), "block").otherwise("allow")
    return parsed.join(scores, parsed.host == scores["__host"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))
