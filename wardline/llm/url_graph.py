"""URL filters: rules by host and path, and trust that spreads over links between hosts.

Column expressions, joins and aggregates only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from wardline.sources.tables import materialise

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Absolute and protocol-relative links; the rest stay on their host.
LINK = r"""(?i)(?:href|src)\s*=\s*["']?(?:https?:)?//([^/?#"'\s<>]+)"""
DAMPING = 0.85
ROUNDS = 8
# A host falls when its distrust is over its trust and over this multiple of an even share.
LEAST_DISTRUST = 0.5
# Longer ones are no host names (RFC 1035) and have no ancestors.
LONGEST_HOST = 253
NUMERIC = r"(^|\.)[0-9]*(:[0-9]*)?$"
# Scores are compared to this many places, so that equal ones stay equal whatever the order of their sums.
PLACES = 12


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith(f".{self.host}")) & path.startswith(self.path)


def with_host(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path``; both empty for a null url or one without ``://``."""
    raw = F.coalesce(F.col(url), F.lit(""))
    return pages.withColumns(
        {
            "host": F.translate(F.regexp_extract(raw, "://([^/?#]*)", 1), CAPITALS, SMALL),
            "path": F.regexp_extract(raw, "://[^/?#]*([^?#]*)", 1),
        }
    )


def with_rule(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``rule`` and ``ruled``, the text and verdict of the longest rule that fits; null where none does.

    Of rules of equal length the one with the longer host wins. Rules are configuration: a few
    dozen, held in the plan.
    """
    host, path = F.col("host"), F.col("path")
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host))):
        text = F.when(r.fits(host, path), r.text).otherwise(text)
        verdict = F.when(r.fits(host, path), r.verdict).otherwise(verdict)
    return pages.withColumns({"rule": text, "ruled": verdict})


def kinship(hosts: DataFrame) -> DataFrame:
    """``(host, parent)``: each host and each of its ancestors with the name above it, of two labels or more.

    An ancestor is a node of the graph though no page is on it, so hosts of one domain are kin. Numeric addresses have none.
    """
    named = hosts.filter((F.length("host") <= LONGEST_HOST) & ~F.col("host").rlike(NUMERIC))
    labels = named.select(F.split("host", r"\.").alias("l"))
    deep = labels.filter(F.size("l") > 2).select("l", F.explode(F.expr("sequence(1, size(l) - 2)")).alias("i"))
    from_label = "array_join(slice(l, {0}, size(l)), '.')"
    return deep.select(
        F.expr(from_label.format("i")).alias("host"), F.expr(from_label.format("i + 1")).alias("parent")
    ).distinct()


def host_edges(pages: DataFrame, hosts: DataFrame, html: str = "html") -> DataFrame:
    """``(source, target, weight)`` between hosts: counted links, and one either way between a host and its parent.

    The parent is the host less its first label, see ``kinship``. Links are counted
    per task before they are shuffled; links that stay on a host are none.
    """
    linked = pages.filter(F.col(html).contains("//") & (F.col("host") != "")).select(
        "host", F.explode(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1))).alias("to")
    )
    links = linked.select(F.col("host").alias("source"), F.translate("to", CAPITALS, SMALL).alias("target"))
    links = links.filter("source <> target").groupBy("source", "target").agg(F.count(F.lit(1)).alias("weight"))
    kin = kinship(hosts).withColumn("weight", F.lit(1).cast("long"))
    up = kin.select(F.col("host").alias("source"), F.col("parent").alias("target"), "weight")
    down = kin.select(F.col("parent").alias("source"), F.col("host").alias("target"), "weight")
    every = links.unionByName(up).unionByName(down)
    return every.groupBy("source", "target").agg(F.sum("weight").alias("weight"))


def host_scores(hosts: DataFrame, edges: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """``(host, trust, distrust)`` of hosts that get any.

    ``hosts`` has ``host, pages, allowed, blocked``. Trust starts at hosts with more allowed than blocked
    pages and follows links; distrust starts at hosts most of whose pages are blocked and runs
    against links, towards hosts that point at them. Both are personalised PageRank with a fixed
    number of rounds; a round is one join with the edges and one aggregate.
    """
    marked = hosts.select(
        "host",
        F.when(F.col("allowed") > F.col("blocked"), 1.0).alias("trust"),
        F.when(2 * F.col("blocked") > F.col("pages"), 1.0).alias("distrust"),
    )
    kinds = F.expr("stack(2, 'trust', trust, 'distrust', distrust) as (kind, mass)")
    seeds = marked.select("host", kinds).filter("mass is not null")
    whole = seeds.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    seeds = materialise(seeds.join(whole, "kind").select("host", "kind", (F.col("mass") / F.col("n")).alias("mass")), "seeds")
    out_of = edges.groupBy(F.col("source").alias("_s")).agg(F.sum("weight").alias("_out"))
    into = edges.groupBy(F.col("target").alias("_t")).agg(F.sum("weight").alias("_in"))
    forward = edges.join(out_of, edges["source"] == out_of["_s"]).select(
        F.lit("trust").alias("_kind"), F.col("source").alias("_from"), F.col("target").alias("_to"),
        (F.col("weight") / F.col("_out")).alias("_part"),
    )
    backward = edges.join(into, edges["target"] == into["_t"]).select(
        F.lit("distrust").alias("_kind"), F.col("target").alias("_from"), F.col("source").alias("_to"),
        (F.col("weight") / F.col("_in")).alias("_part"),
    )
    steps = materialise(forward.unionByName(backward), "steps")
    restart = seeds.select("host", "kind", (F.col("mass") * (1 - damping)).alias("mass"))
    now = seeds
    if steps.isEmpty():
        now, rounds = restart, 0
    for turn in range(rounds):
        moved = now.join(steps, (now["host"] == steps["_from"]) & (now["kind"] == steps["_kind"])).select(
            F.col("_to").alias("host"), "kind", (F.col("mass") * F.col("_part") * damping).alias("mass")
        )
        now = moved.unionByName(restart).groupBy("host", "kind").agg(F.sum("mass").alias("mass"))
        if turn % 4 == 3:
            now = materialise(now, "scores")
    by_kind = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("mass"))), F.lit(0.0)).alias(k) for k in ("trust", "distrust")]
    return now.groupBy("host").agg(*by_kind)


def judge(pages: DataFrame, rules: Sequence[Rule], page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page.

    The longest rule that fits decides. Elsewhere the host does: it is blocked when its distrust is over its trust and
    over ``LEAST_DISTRUST`` times an even share of all hosts, and allowed otherwise. A page without
    a host takes no part in the graph and is allowed where no rule fits; a null html has no links; repeated rows each
    come back and count as pages; an empty table gives no rows; other columns are not read.
    """
    slim = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    ruled = with_rule(with_host(slim), rules)
    hosts = materialise(
        ruled.filter("host <> ''").groupBy("host").agg(
            F.count(F.lit(1)).alias("pages"),
            F.count_if(F.col("ruled") == "allow").alias("allowed"),
            F.count_if(F.col("ruled") == "block").alias("blocked"),
        ),
        "hosts",
    )
    edges = materialise(host_edges(ruled, hosts), "edges")
    scores = host_scores(hosts, edges)
    count = hosts.count()
    share = F.col("distrust") * F.lit(float(max(1, count)))
    fallen = scores.filter(
        (F.round(F.col("distrust") - F.col("trust"), PLACES) > 0) & (F.round(share - LEAST_DISTRUST, PLACES) >= 0)
    ).select(F.col("host").alias("_host"))
    fallen = materialise(fallen, "fallen")
    met = ruled.drop("url", "html").join(fallen, ruled["host"] == fallen["_host"], "left")
    by_host = F.when(F.col("_host").isNotNull(), "block").otherwise("allow")
    return met.select("page_id", "host", "path", "rule", F.coalesce("ruled", by_host).alias("verdict"))
