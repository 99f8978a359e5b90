"""URL filter: rules where they fit, trust and distrust that spread along links between hosts elsewhere.

Trust is a personalised PageRank that starts at hosts with allowed pages and follows links. Distrust
starts at hosts with blocked pages and follows links backwards: who links to a blocked host is
suspect. A host's pages without a rule are blocked when its distrust exceeds its trust.

Ranks shrink as a web grows, since those of a kind sum to at most 1. So all limits are relative: of
trust to distrust, and of distrust to the mean over all hosts that any rank reaches.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import ascii_lower, stage

DAMPING = 0.85
ROUNDS = 15
LEAST_SHARE = 1e-6  # of the mean distrust: what lies below counts as none
_MARGIN = 1e-9  # by which distrust must exceed trust, so that the order of additions can't matter
_WRITTEN = 5  # rounds between two writes, which bound what a lost executor can cost
_LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    own = (host == rule.host) | host.endswith(f".{rule.host}")
    return own & path.startswith(rule.path)


def matched(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, or NULLs. Of equally long ones the blocking one."""
    order = sorted(rules, key=lambda r: (-len(r.text), r.verdict != "block", r.text))
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in reversed(order):
        fits = _fits(rule, host, path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def host_links(pages: DataFrame, host: Column, html: Column) -> DataFrame:
    """(src, dst, weight): links from host to host, counted; links without a host stay on their own."""
    links = pages.select(host.alias("src"), F.explode(F.regexp_extract_all(html, F.lit(_LINK), F.lit(1))).alias("to"))
    to = F.when(F.col("to").startswith("//"), F.concat(F.lit(":"), F.col("to"))).otherwise(F.col("to"))
    links = links.select("src", host_of(to).alias("dst"))
    return (
        links.filter("src <> '' AND dst <> '' AND src <> dst")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("weight"))
    )


def propagate(
    edges: DataFrame, seeds: DataFrame, *, damping: float = DAMPING, rounds: int = ROUNDS
) -> DataFrame:
    """(kind, host, rank): personalised PageRank over edges (kind, src, dst, weight) from seeds (kind, host, seed).

    Kinds are graphs of their own that are ranked side by side. Seeds of a kind are scaled to sum to
    1. In each round a host passes on ``damping`` of its rank by the weight of its links, and every
    seed gets its share of the rest. Rank that a host without links can't pass on ends there.
    Without seeds there are no ranks; hosts that nothing reaches are left out.
    """
    totals = seeds.groupBy("kind").agg(F.sum("seed").alias("all"))
    start = stage(seeds.join(totals, "kind").select("kind", "host", (F.col("seed") / F.col("all")).alias("seed")), "seeds")
    out = stage(edges.groupBy("kind", "src").agg(F.sum("weight").alias("total")), "out-links")
    shares = edges.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("weight") / F.col("total")).alias("share"))
    shares = stage(shares, "shares")
    kept = start.select("kind", "host", (F.col("seed") * (1 - damping)).alias("rank"))
    ranks = start.select("kind", "host", F.col("seed").alias("rank"))
    for done in range(1, rounds + 1):
        passed = shares.join(ranks.withColumnRenamed("host", "src"), ["kind", "src"]).select(
            "kind", F.col("dst").alias("host"), (F.col("rank") * F.col("share") * damping).alias("rank")
        )
        ranks = passed.union(kept).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if done % _WRITTEN == 0 or done == rounds:
            ranks = stage(ranks, "ranks")
    return ranks


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    damping: float = DAMPING,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, trust, distrust.

    The longest rule that fits decides. Pages without one go by their host: block when its distrust
    is above both its trust and a millionth of the mean, else allow; so a host that nothing reaches is allowed. NULL
    urls and urls without ``://`` have empty host and path and are allowed; NULL pages have no
    links; repeated rows count as often as they occur, for seeds and links too; an empty table gives
    no rows. Other columns are not read.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
    )
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = matched(rules, F.col("host"), F.col("path"))
    judged = rows.select("page_id", host.alias("host"), path.alias("path"))
    judged = judged.select("*", rule.alias("rule"), verdict.alias("ruled"))
    edges = stage(host_links(rows, host, F.col("html")), "host-links")
    seeds = judged.filter("ruled IS NOT NULL").groupBy(F.col("ruled").alias("kind"), "host").agg(F.count("*").alias("seed"))
    both = edges.select(F.lit("allow").alias("kind"), "src", "dst", "weight").union(
        edges.select(F.lit("block"), F.col("dst"), F.col("src"), F.col("weight"))
    )
    ranks = propagate(both, stage(seeds, "seed-pages"), damping=damping, rounds=rounds)
    rank_of = lambda kind: F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0))
    hosts = ranks.groupBy(F.col("host").alias("of")).agg(rank_of("allow").alias("trust"), rank_of("block").alias("distrust"))
    hosts = stage(hosts, "host-ranks")
    least = (hosts.agg(F.avg("distrust").alias("mean")).first()["mean"] or 0.0) * LEAST_SHARE
    joined = judged.join(hosts, F.col("host") == F.col("of"), "left")
    trusted, suspect = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    by_host = F.when((suspect > trusted * (1 + _MARGIN)) & (suspect > least), "block").otherwise("allow")
    return joined.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", by_host).alias("verdict"),
        trusted.alias("trust"), suspect.alias("distrust"),
    )
