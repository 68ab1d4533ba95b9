"""URL filtering: host and path rules, then link-graph propagation for the urls that no rule covers.

A host graph has an edge from a page's host to every host its HTML links to, weighted by the links, and edges both ways
between a host and the domain above it. Trust is a personalised PageRank from hosts whose pages a rule allows; distrust
is the same on the reversed edges from hosts whose pages a rule blocks, so that whoever links to blocked hosts is doubted.
Both seeds, and so both ranks, have a mass of one. Links carry a host's rank but for a small share, ``FAMILY``, that goes
over its edges to the domains above and below; what a host has no edges for returns to the seeds. Returned mass only
scales all ranks of a kind alike, so ranks are propagated without it and divided by their sum at the end. A host is blocked
if its distrust is over its trust by more than rounding noise. Ranks are propagated until none changes by more than a small
share of itself, so every host that can be reached has one.

A host with more than ``HUB`` edges has them dealt to slices, and its rank is sent to each slice, so that no task has all
of a hub's edges.

Edge cases: a null url, or one without ``://``, has empty host and path, no rule, and the method's verdict on
the empty host, which is ``allow``; so is that of a host that nothing reaches, and a tie. Null HTML has no
links. Repeated rows count as often as they occur. Other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import named, stored

#: The rules of the registered query, as (action, host and path).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
DAMPING = 0.85
#: The share of a host's rank that goes to the domains above and below it.
FAMILY = 0.05
#: Edges of a host in one slice.
HUB = 1 << 16
#: Ranks have settled when the largest change of a round is below this share of the rank.
TOLERANCE = 1e-10
#: Scores closer than this share of each other are a tie: well over what rounds and the order of sums leave open.
TIE = 1e-8
#: Rounds between two tests of change, each of which stores the ranks; and rounds after which it is an error not to have settled.
STRIDE = 8
ROUNDS = 10_000
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)href\s*=\s*["']?[a-z][a-z0-9+.-]*://([^/?#"'\s<>]*)"""


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    return F.coalesce(_ascii_lower(F.regexp_extract(url, _URL, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """The longest rule that fits, as text; null if none. Rules are configuration: a few, held in the plan."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the last one added is asked first
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit(f".{domain}"))) & F.startswith(path, F.lit(slash + rest))
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _parents(hosts: DataFrame) -> DataFrame:
    """(host, parent) for each host and every domain above it of two or more labels."""
    labels = F.split("host", r"\.")
    n = F.size(labels)
    chain = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.array_join(F.slice(labels, i, n - i + 1), "."))
    pairs = F.arrays_zip(F.slice(chain, 1, n - 2).alias("host"), F.slice(chain, 2, n - 2).alias("parent"))
    return hosts.where((n > 2) & (F.col("host") != "")).select(F.explode(pairs).alias("p")).select("p.*").distinct()


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, family, n): links between different hosts, and both ways between a host and the domain above it."""
    links = (
        pages.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(_LINK), F.lit(1))).alias("dst"))
        .select("src", _ascii_lower(F.col("dst")).alias("dst"))
        .where("src <> dst AND src <> '' AND dst <> ''")
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("src", "dst", F.lit(False).alias("family"), "n")
    )
    hosts = pages.select("host").union(links.select(F.col("dst").alias("host"))).distinct()
    above = stored(_parents(hosts), "parents")
    both = above.select(F.col("host").alias("src"), F.col("parent").alias("dst")).union(above.select(F.col("parent").alias("src"), F.col("host").alias("dst")))
    return links.union(both.select("src", "dst", F.lit(True).alias("family"), F.lit(1).cast("long").alias("n")))


def _weighted(edges: DataFrame, family: float, hub: int) -> tuple[DataFrame, DataFrame | None]:
    """(kind, src, dst, slice, w) of edges, and (kind, host, slices) of hubs, None if there are none."""
    out = stored(edges.groupBy("kind", "src", "family").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("edges")), "degrees")
    share = F.when(F.col("family"), family).otherwise(1 - family)
    joined = edges.join(out, ["kind", "src", "family"]).withColumn("w", share * F.col("n") / F.col("all"))
    hubs = out.groupBy("kind", F.col("src").alias("host")).agg(F.sum("edges").alias("edges")).where(F.col("edges") > hub)
    hubs = stored(hubs.select("kind", "host", F.ceil(F.col("edges") / hub).cast("int").alias("slices")), "hubs")
    if hubs.isEmpty():
        return stored(joined.select("kind", "src", "dst", F.lit(0).alias("slice"), "w"), "hosts"), None
    dealt = joined.join(hubs.select("kind", F.col("host").alias("src"), "slices"), ["kind", "src"], "left")
    part = F.coalesce(F.pmod(F.xxhash64("dst"), F.col("slices")), F.lit(0)).cast("int")
    return stored(dealt.select("kind", "src", "dst", part.alias("slice"), "w"), "hosts"), hubs


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS, tolerance: float = TOLERANCE, family: float = FAMILY, hub: int = HUB) -> DataFrame:
    """Personalised PageRank in several kinds at once.

    edges (kind, src, dst, family, n), seeds (kind, host, seed) -> (kind, host, rank); the ranks of a kind sum to one.
    """
    weighted, hubs = _weighted(edges, family, hub)
    seeds = stored(seeds, "seeds")
    rank = seeds.withColumnRenamed("seed", "rank")
    start = seeds.select("kind", "host", (F.col("seed") * (1 - damping)).alias("part"), F.lit(0.0).alias("old"))
    for i in range(1, rounds + 1):
        if hubs is None:
            sent = rank.withColumn("slice", F.lit(0))
        else:
            sent = rank.join(hubs, ["kind", "host"], "left").withColumn("slice", F.explode(F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1)))
        over = (sent["kind"] == weighted["kind"]) & (sent["host"] == weighted["src"]) & (sent["slice"] == weighted["slice"])
        moved = sent.join(weighted, over).select(sent["kind"], F.col("dst").alias("host"), (F.col("rank") * F.col("w") * damping).alias("part"), F.lit(0.0).alias("old"))
        if i % STRIDE:
            rank = moved.union(start).groupBy("kind", "host").agg(F.sum("part").alias("rank"))
            continue
        held = rank.select("kind", "host", F.lit(0.0).alias("part"), F.col("rank").alias("old"))
        both = stored(moved.union(start).union(held).groupBy("kind", "host").agg(F.sum("part").alias("rank"), F.sum("old").alias("old")), "ranks")
        rank = both.select("kind", "host", "rank")
        if both.where(F.abs(F.col("rank") - F.col("old")) > tolerance * F.col("rank")).isEmpty():
            mass = rank.groupBy("kind").agg(F.sum("rank").alias("mass"))  # a row for each kind
            return rank.join(F.broadcast(mass), "kind").select("kind", "host", (F.col("rank") / F.col("mass")).alias("rank"))
    raise RuntimeError(f"ranks did not settle in {rounds} rounds")


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules: tuple[tuple[str, str], ...] = RULES, family: float = FAMILY, hub: int = HUB) -> DataFrame:
    """One row per row of pages: id, host, path, rule, verdict, trust, distrust."""
    url = named(url_col)
    read = pages.select(named(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"), named(html_col).alias("html"))
    action = F.coalesce(*[F.when(F.col("rule") == rule, F.lit(said)) for said, rule in rules]) if rules else F.lit(None).cast("string")
    ruled = read.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("action", action)
    tally = ruled.groupBy("host").agg(F.count_if(F.col("action") == "allow").alias("good"), F.count_if(F.col("action") == "block").alias("bad"), F.count(F.lit(1)).alias("n"))
    shares = F.array(F.struct(F.lit("trust").alias("kind"), (F.col("good") / F.col("n")).alias("seed")), F.struct(F.lit("distrust").alias("kind"), (F.col("bad") / F.col("n")).alias("seed")))
    seeds = tally.where("host <> ''").select("host", F.explode(shares).alias("s")).select("s.kind", "host", "s.seed").where("seed > 0")
    edges = stored(host_edges(read.select("host", "html")), "edges")
    back = edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "family", "n")
    ranks = propagate(edges.select(F.lit("trust").alias("kind"), "src", "dst", "family", "n").union(back), seeds, family=family, hub=hub)
    score = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0)).alias(kind)
    hosts = stored(ranks.groupBy("host").agg(score("trust"), score("distrust")), "scores")  # so that a hub host's pages can be split
    own = F.when(F.coalesce("distrust", F.lit(0.0)) > F.coalesce("trust", F.lit(0.0)) * (1 + TIE), "block").otherwise("allow")
    return (
        ruled.drop("html")
        .join(hosts, "host", "left")
        .select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("action", own).alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
    )
