"""URL verdicts: written rules first, then trust and distrust that flow over links between hosts.

Pages that a rule allows or blocks make their hosts seeds. Trust follows links (personalised
PageRank from the allowed seeds); distrust runs against them, from the blocked seeds to the hosts
that link there. Masses are whole units of a fixed total, so every sum is exact and the verdicts do
not depend on partitions, retries or row order.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfcast.operators.skew import lookup
from shelfcast.settings import settle, settle_counted

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Units of mass that all seeds of a kind share.
UNITS = 10**15
# Percent of a host's mass that flows on, and the most links in a row that it may follow.
DAMPING, ROUNDS = 85, 20
# A host is blocked if more than this percent of its mass is distrust.
LIMIT = 50
# Most written rules: they become one expression over the url.
MAX_RULES = 1000
# The host of an absolute or protocol-relative link in an <a> element.
LINK = (
    r"<[Aa][\x09-\x0D ](?:[^<>]*[\x09-\x0D \"'])?[Hh][Rr][Ee][Ff][\x09-\x0D ]*=[\x09-\x0D ]*[\"']?"
    r"(?:[Hh][Tt][Tt][Pp][Ss]?:)?//([^/?#\"'<>\x00-\x20]+)"
)


class Rule(NamedTuple):
    """A rule for a host with all its subdomains and for paths that begin with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for a null or without ``://``."""
    url = F.coalesce(url, F.lit(""))
    place = F.instr(url, "://")
    rest = F.when(place > 0, F.substr(url, place + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return lower_ascii(host), path


def first_rule(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits (null without one)."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def host_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, w): pages of host ``src`` that link to another host ``dst``.

    A page counts once per linked host. Relative links stay on the host and are no edges.
    """
    host, _ = host_and_path(F.col(url_col).cast("string"))
    found = F.regexp_extract_all(F.col(html_col).cast("string"), F.lit(LINK), F.lit(1))
    targets = F.array_distinct(F.transform(found, lower_ascii))
    links = pages.select(host.alias("src"), F.explode(targets).alias("dst"))
    return links.filter("src <> '' and src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("w"))


def _arcs(edges: DataFrame) -> DataFrame:
    """(kind, a, b, w, total): trust along the links, distrust against them."""
    out = edges.groupBy("src").agg(F.sum("w").alias("total"))
    into = edges.groupBy("dst").agg(F.sum("w").alias("total"))
    along = edges.join(out, "src").select(F.lit("trust").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), "w", "total")
    against = edges.join(into, "dst").select(F.lit("distrust").alias("kind"), F.col("dst").alias("a"), F.col("src").alias("b"), "w", "total")
    return along.unionByName(against)


def propagate(edges: DataFrame, seeds: DataFrame, damping: int = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust): masses after ``rounds`` steps, for hosts that any mass reaches.

    ``edges`` is (src, dst, w); ``seeds`` is (host, kind, weight) with kind ``trust`` or ``distrust``.
    A step gives every seed its share of ``100 - damping`` percent of the units, and every host the
    parts that arrive over its links, rounded down. Each step is one join and one sum over the
    arcs, written to the shared folder; steps that change nothing end the loop, as all later ones
    would give the same. Without edges only seeds have mass; without seeds the result is empty.
    """
    total = seeds.groupBy("kind").agg(F.sum("weight").alias("all"))
    base = seeds.join(F.broadcast(total), "kind").select(  # two rows at most
        "kind", "host", F.expr(f"({UNITS} div `all`) * weight * {100 - damping} div 100").alias("m")
    )
    base = settle(base, "seeds")
    arcs, count = settle_counted(_arcs(edges), "arcs")
    mass, before = base, None
    for _ in range(rounds if count else 0):
        moved = arcs.join(mass.withColumnRenamed("host", "a"), ["kind", "a"]).select(
            "kind", F.col("b").alias("host"), F.expr(f"(m div total) * w * {damping} div 100").alias("m")
        )
        after = base.unionByName(moved).groupBy("kind", "host").agg(F.sum("m").alias("m"))
        seen = Observation()
        state = (F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64("kind", "host", "m").cast("decimal(38,0)")).alias("mark"))
        mass = settle(after.observe(seen, *state), "mass")
        now = (seen.get.get("rows"), seen.get.get("mark"))
        if now == before:
            break
        before = now
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("m")).otherwise(0)).alias(kind)
    return mass.groupBy("host").agg(of("trust"), of("distrust"))


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    links: DataFrame | None = None,
    limit: int = LIMIT,
    damping: int = DAMPING,
    rounds: int = ROUNDS,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """(id, host, path, rule, verdict, trust, distrust), one row per input row.

    The longest rule that fits decides. Other pages are blocked if more than ``limit`` percent of
    their host's mass is distrust, else allowed: a host that no mass reaches is allowed, and so are
    ties. ``links`` (src, dst, w) adds edges from elsewhere to those found in the pages.

    Null or odd urls have an empty host, which is in no graph; null pages have no links; null and
    repeated ids stay, and repeated rows count again as seeds and links; other columns are ignored;
    an empty table gives an empty table. One host may hold most pages: seeds and links are counted
    before they are shuffled, and the pages meet their host's masses by a broadcast of counted
    size or else a join that adaptive execution splits.
    """
    host, path = host_and_path(F.col(url_col).cast("string"))
    named = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rule, said = first_rule(rules, F.col("host"), F.col("path"))
    named = named.select("*", rule.alias("rule"), said.alias("said"))
    kind = F.when(F.col("said") == "allow", "trust").otherwise("distrust")
    seeds = named.filter("said is not null and host <> ''").groupBy("host", kind.alias("kind")).agg(F.count(F.lit(1)).alias("weight"))
    edges = host_links(pages, url_col, html_col)
    if links is not None:
        more = links.select(lower_ascii(F.col("src")).alias("src"), lower_ascii(F.col("dst")).alias("dst"), F.col("w").cast("long").alias("w"))
        edges = edges.unionByName(more.filter("src <> '' and dst <> '' and src <> dst and w > 0")).groupBy("src", "dst").agg(F.sum("w").alias("w"))
    masses = propagate(settle(edges, "edges"), seeds, damping, rounds)
    found = named.join(lookup(masses, "masses"), "host", "left")
    trust, distrust = F.coalesce("trust", F.lit(0)), F.coalesce("distrust", F.lit(0))
    method = F.when(distrust * (100 - limit) > trust * limit, "block").otherwise("allow")
    return found.select("id", "host", "path", "rule", F.coalesce("said", method).alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))
