"""URL filter: rules first, then trust and distrust spread over the host graph.

A page's url is judged by the longest rule that fits. Where none fits, its host is
judged by two personalised PageRanks over links between hosts, where a host passes on
its rank along its links, by their weights, with restarts at the seeds. Trust goes
along the links: the rank that reaches a host from the trusted ones. Distrust goes
against them, from the blocked hosts: the rank that a walk from a host brings to
the blocked ones. Both are in units of one restart, so a seed without links has 1.
So distrust is about where a host's own links lead, and does not shrink with the number of
hosts that link to the same place; one bad link among many good ones is little. A host
with more distrust than trust, and enough of it, is blocked.

Edges are links between hosts found in the pages (weight: number of links), and
between a host and its parent domain, both ways (weight 1), so that hosts of one
domain share their standing even where pages link only within their site. Names
of one label (``org``) are no parents: their hosts have nothing to do with each other.
Everything is joins and sums over one row per edge, in rounds until what is still to come
is under a tolerance; a few rounds at a time are written down.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import discard, join_hot, settle

#: Trust and distrust as near as this are alike: sums are not exact.
ROUNDING = 1e-9
#: Rounds between two written tables.
STEPS = 4
#: Pages of a host beyond which they are dealt over several tasks.
HOT_HOST = 1000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """A verdict for the urls of a host and its subdomains whose path begins so."""

    verdict: str
    host: str
    path: str


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(rule: Rule) -> Column:
    host = F.col("host")
    return ((host == rule.host) | host.endswith("." + rule.host)) & F.col("path").startswith(rule.path)


def _longest(rules: Sequence[Rule], value) -> Column:
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.host + r.path), r)):
        out = F.when(_fits(rule), F.lit(value(rule))).otherwise(out)
    return out


def _host_edges(pages: DataFrame, html_col: str) -> DataFrame:
    """(src, dst, weight) between different hosts."""
    linked = F.regexp_extract_all(F.col(html_col).cast("string"), F.lit("(?i)href\\s*=\\s*[\"']?(?:[a-z][a-z0-9+.-]*:)?//([^/\"'?#\\s>]+)"), F.lit(1))
    links = (pages.select("host", F.explode(linked).alias("dst")).select(F.col("host").alias("src"), F.translate("dst", _UPPER, _LOWER).alias("dst"))
             .filter("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight")))
    hosts = pages.select("host").filter("host <> ''").union(links.select("dst")).distinct()
    # A host and all its parent domains, each with the next one.
    labels = F.split("host", "\\.")
    chain = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    up = (hosts.select(chain.alias("c")).filter("size(c) > 2")
          .select(F.explode(F.expr("transform(sequence(1, size(c) - 2), i -> struct(c[i - 1] as low, c[i] as high))")).alias("e"))
          .select("e.low", "e.high").filter("low <> ''").distinct())
    both = up.select(F.col("low").alias("src"), F.col("high").alias("dst")).union(up.select("high", "low"))
    return (links.unionByName(both.withColumn("weight", F.lit(1.0)))
            .groupBy("src", "dst").agg(F.sum("weight").alias("weight")))


def _undecided(state: DataFrame, steps: int, damping: float, margin: float, least: float) -> int:
    """Hosts, seeds left out, whose verdict the steps to come may change.

    A host that no step has reached stays at 0 once a step reaches no new one."""
    is_kind = lambda k: F.col("kind") == k
    now = state.agg(*(F.max(F.when(is_kind(k), F.col("since"))).alias(k) for k in ("trust", "distrust")),
                    F.max(F.when(is_kind("distrust"), F.col("more"))).alias("most"), F.sum(F.when(is_kind("trust"), F.col("more"))).alias("all")).first()
    if (now.distrust or 0) >= steps > 0:
        return 1  # still spreading
    more_bad, more_good = ((x or 0.0) * damping / (1 - damping) for x in (now.most, now["all"]))
    reached = F.lit(True) if (now.trust or 0) >= steps else F.max(is_kind("trust"))
    hosts = state.groupBy("host").agg(F.max("seed").alias("seed"), F.max(is_kind("distrust")).alias("bad"), reached.alias("good"),
                                      *(F.sum(F.when(is_kind(k), F.col("value")).otherwise(0.0)).alias(k) for k in ("trust", "distrust")))
    low, high = F.col("distrust"), F.col("distrust") + more_bad
    most_trust = F.col("trust") + F.when(F.col("good"), F.lit(more_good)).otherwise(0.0)
    sure = (high < least) | (high <= F.col("trust") * margin) | ((low >= least) & (low > most_trust * margin + ROUNDING))
    return hosts.filter(F.col("bad") & ~F.col("seed") & ~sure).count()


def _spread(ways: DataFrame, seeds: DataFrame, damping: float, tolerance: float, decision: tuple[float, float] | None = None) -> DataFrame:
    """The ranks (kind, host, seed, value) with value = 1 at seeds (kind, host), plus ``damping`` times
    the sum over ways (kind, host, via, share) of share times the value at ``via``: the sum
    of what a restart brings after 0, 1, 2, ... steps. ``more`` is what the last
    step brought. Where shares sum to 1 per host (distrust), the steps to come add at most
    damping / (1 - damping) times the largest of it; where they do per via (trust), that times
    the sum of it. The steps end where both are under ``tolerance``, or, with ``decision``
    (margin, least), where no verdict can change any more."""
    state = settle(seeds.select("kind", "host", F.lit(True).alias("seed"), F.lit(0).alias("since"), F.lit(1.0).alias("value"), F.lit(1.0).alias("more")))
    steps = 0

    def step(state: DataFrame, number: int) -> DataFrame:
        got = (ways.join(state.filter("more > 0").select("kind", F.col("host").alias("via"), "more"), ["kind", "via"])
               .select("kind", "host", F.lit(False).alias("seed"), F.lit(number).alias("since"), F.lit(0.0).alias("value"), (F.col("share") * F.col("more") * damping).alias("more")))
        return (got.union(state.select("kind", "host", "seed", "since", "value", F.lit(0.0))).groupBy("kind", "host")
                .agg(F.max("seed").alias("seed"), F.min("since").alias("since"), F.sum("value").alias("value"), F.sum("more").alias("more"))
                .select("kind", "host", "seed", "since", (F.col("value") + F.col("more")).alias("value"), "more"))

    def to_come() -> float:
        left = state.agg(F.max(F.when(F.col("kind") == "distrust", F.col("more"))).alias("most"),
                         F.sum(F.when(F.col("kind") == "trust", F.col("more"))).alias("all")).first()
        return max(left["most"] or 0.0, left["all"] or 0.0) * damping / (1 - damping)

    while to_come() >= tolerance:
        old, new = state, state
        for _ in range(STEPS):
            steps += 1
            new = step(new, steps)
        state = settle(new)
        discard(old)
        if decision and not _undecided(state, steps, damping, *decision):
            break
    return state.select("kind", "host", "seed", "value")


def judge_urls(pages: DataFrame, rules: Sequence[Rule], trusted: Sequence[str] | None = None, blocked: Sequence[str] | None = None,
               damping: float = 0.85, tolerance: float = 1e-3, margin: float = 1.0, least: float = 0.1,
               id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A verdict per row of ``pages``: page_id, host, path, rule, verdict.

    The longest fitting rule decides; ``rule`` is its host and path, else null.
    Else the host decides: blocked where distrust exceeds ``margin`` times trust and is at
    least ``least``, allowed otherwise; both are known up to ``tolerance``. (A host whose
    links all lead to blocked ones has ``damping``; the default takes one such link in
    eight, or a chain of 14 hosts.) Trust and distrust are spread until they settle or no
    verdict can change. The hosts they come from keep their standing: trusted ones are allowed, others
    that are in the blocked list are blocked. ``trusted`` and ``blocked`` are the
    hosts that trust and distrust come from, with all their subdomains that pages
    name; by default those of the allowing rules, and of the blocking rules
    that cover a whole host (path ``/``). Null urls and
    urls without :// have an empty host and path and are allowed unless a rule
    fits. Null html has no links. Repeated pages count their links again. Null
    ids are returned as they are; no rows give no rows; other columns are not read.
    """
    pages = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"),
                         F.col(html_col).alias("html"))
    trusted = sorted({r.host for r in rules if r.verdict == "allow"}) if trusted is None else list(trusted)
    blocked = sorted({r.host for r in rules if r.verdict == "block" and r.path == "/"}) if blocked is None else list(blocked)

    edges = settle(_host_edges(pages, "html"))
    # A host's rank goes along its links by weight: trust to where they lead, distrust back from there.
    sums = edges.groupBy("src").agg(F.sum("weight").alias("all"))
    shared = edges.join(sums, "src").select("src", "dst", (F.col("weight") / F.col("all")).alias("share"))
    ways = settle(shared.select(F.lit("trust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("via"), "share")
                  .union(shared.select(F.lit("distrust"), "src", "dst", "share")))
    of_pages = pages.groupBy("host").agg(F.count("*").alias("pages"))
    known = settle(ways.select("host", F.lit(0).cast("long").alias("pages")).union(of_pages).groupBy("host").agg(F.sum("pages").alias("pages")))

    def seeds_of(kind: str, hosts: Sequence[str]) -> DataFrame:
        under = functools.reduce(lambda a, h: a | (F.col("host") == h) | F.col("host").endswith("." + h), hosts, F.lit(False))
        return known.filter(under).select(F.lit(kind).alias("kind"), "host")

    values = _spread(ways, seeds_of("trust", trusted).union(seeds_of("distrust", blocked)), damping, tolerance, (margin, least))
    of = lambda kind, value, none: F.when(F.col("kind") == kind, value).otherwise(none)
    standing = values.groupBy("host").agg(*(F.sum(of(k, F.col("value"), 0.0)).alias(k) for k in ("trust", "distrust")),
                                          *(F.max(of(k, F.col("seed"), False)).alias(f"{k}_seed") for k in ("trust", "distrust")))
    linked = (F.col("distrust") >= least) & (F.col("distrust") > F.col("trust") * margin + ROUNDING)
    bad = ~F.col("trust_seed") & (F.col("distrust_seed") | linked)
    hosts = known.filter("pages > 0").join(standing, "host", "left").select("host", "pages", F.coalesce(bad, F.lit(False)).alias("bad"))

    judged = pages.select("page_id", "host", "path", _longest(rules, lambda r: r.host + r.path).alias("rule"),
                          _longest(rules, lambda r: r.verdict).alias("ruled"))
    return (join_hot(judged, settle(hosts), ["host"], f"pages > {HOT_HOST}")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("ruled", F.when(F.col("bad"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict")))
