"""URL filter: rules, and trust and distrust propagated over the links of hosts.

Host and path of a url are cut by text alone: the host lies between the first ``://`` and the next ``/``, ``?`` or
``#`` (A-Z lower-cased), the path after it up to ``?`` or ``#``; both are empty for NULL or without ``://``. A rule
fits its host and all subdomains if the path starts with the rule's; the longest rule wins.

Urls that no rule fits get the verdict of their host. Trust starts at every host with pages that rules allow, in
proportion to them, distrust at every host with pages that rules block, however few of its pages these are; a host may
be both. Trust follows links (personalised PageRank), distrust runs against them (whoever links to a distrusted host is
distrusted). A host also counts as linked with its parent domain, both ways,
in so far as both are hosts of the pages or of their links. Rounds go on until no host's rank changes by more than
``SETTLED`` of itself, so also until no further host is reached. Then a host is blocked where its share of all distrust
exceeds its share of all trust by more than ``threshold``, and allowed otherwise; what lies within rounding errors
(``EVEN`` of both together) is no excess.

Only DataFrame functions. Links are counted per pair of hosts before anything is joined; ranks are one row per host,
joined with the edges of the host as often as there are rounds. Joins on a host that has many pages are split by
adaptive execution, since only inner and left joins with the pages on the left are used.

Defined results: a NULL or malformed url has host, path '' and the verdict of the empty host: allow; repeated rows are
judged each; NULL html has no links; no pages give no rows.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inflecta.llm.common import Scratch

#: Fixed rules of the production filter: (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
DAMPING, THRESHOLD = 0.85, 0.0
#: Ranks are written and compared every so many rounds; greatest change, as a share of the rank, of ranks that are done.
BETWEEN, SETTLED = 3, 1e-6
EVEN = 1e-9
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``, or NULL."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    names = ("rule_host", "rule_path", "rule_verdict")
    rows = [F.struct(*[F.lit(value).alias(name) for name, value in zip(names, rule, strict=True)]) for rule in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def domains_of(host: Column) -> Column:
    """The host and all its parent domains."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def rules_of_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules) of hosts that any rule may fit; as many rules as were given at most, longest first."""
    fits = hosts.select("host", F.explode(domains_of(F.col("host"))).alias("rule_host")).join(rules, "rule_host")
    size = F.length("rule_host") + F.length("rule_path")
    entry = F.struct((-size).alias("size"), F.concat("rule_host", "rule_path").alias("rule"), "rule_path", "rule_verdict")
    return fits.groupBy("host").agg(F.array_sort(F.collect_list(entry)).alias("rules"))


def judged_by_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """All columns of ``pages`` with ``host`` and ``path``, and ``rule`` and ``by_rule`` (NULL where none fits)."""
    known = rules_of_hosts(pages.select("host").distinct(), rules)
    best = F.get(F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"])), F.lit(0))
    return pages.join(known, "host", "left").withColumn("_best", best).select(*pages.columns, F.col("_best.rule").alias("rule"), F.col("_best.rule_verdict").alias("by_rule"))


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b, links): links from pages of host a to host b in their html, absolute or without a scheme, a <> b."""
    found = F.regexp_extract_all(F.col(html), F.lit(r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)"""), 1)
    away = F.filter(F.array_distinct(found), lambda u: F.rlike(u, F.lit(r"^([A-Za-z][A-Za-z0-9+.-]*:)?//")))
    links = pages.select(host_of(F.col(url)).alias("a"), F.explode(away).alias("_u"))
    target = F.when(F.startswith("_u", F.lit("//")), F.concat(F.lit("x:"), "_u")).otherwise(F.col("_u"))
    links = links.select("a", host_of(target).alias("b")).where("a <> b AND b <> ''")
    return links.groupBy("a", "b").agg(F.count("*").alias("links"))


def domain_edges(hosts: DataFrame) -> DataFrame:
    """(a, b, links): each host and its nearest parent domain among the hosts, both ways."""
    above = hosts.select("host", F.posexplode(domains_of(F.col("host"))).alias("at", "b")).where("at > 0")
    nearest = above.join(hosts.select(F.col("host").alias("b")), "b").groupBy("host").agg(F.min_by("b", "at").alias("b"))
    both = nearest.select(F.col("host").alias("a"), "b").unionByName(nearest.select(F.col("b").alias("a"), F.col("host").alias("b")))
    return both.withColumn("links", F.lit(1).cast("long"))


def settled(before: DataFrame, rank: DataFrame) -> bool:
    """Whether no rank is new or differs by more than ``SETTLED`` of itself."""
    both = rank.select("kind", "host", "rank", F.lit(0.0).alias("last")).unionByName(before.select("kind", "host", F.lit(0.0).alias("rank"), F.col("rank").alias("last")))
    both = both.groupBy("kind", "host").agg(F.sum("rank").alias("rank"), F.sum("last").alias("last"))
    return both.where(F.abs(F.col("rank") - F.col("last")) > SETTLED * F.col("rank")).isEmpty()


def propagated(edges: DataFrame, seeds: DataFrame, scratch: Scratch, rounds: int | None = None, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust): shares of all trust and all distrust. ``seeds``: (host, trust, distrust), counts.

    Both kinds run in one table: trust along the edges, distrust against them. What a host without an edge holds
    goes back to the seeds. Without ``rounds`` they go on until all ranks are settled.
    """
    ways = edges.select(F.lit("trust").alias("kind"), F.col("a").alias("host"), F.col("b").alias("to"), "links")
    ways = ways.unionByName(edges.select(F.lit("distrust").alias("kind"), F.col("b").alias("host"), F.col("a").alias("to"), "links"))
    out = ways.groupBy("kind", "host").agg(F.sum("links").alias("out"))
    ways = scratch.save(ways.join(out, ["kind", "host"]).select("kind", "host", "to", (F.col("links") / F.col("out")).alias("share")), "ways")
    start = seeds.select("host", F.expr("stack(2, 'trust', trust, 'distrust', distrust) AS (kind, n)")).where("n > 0")
    whole = start.groupBy("kind").agg(F.sum("n").alias("whole"))  # two rows
    start = scratch.save(start.join(F.broadcast(whole), "kind").select("kind", "host", (F.col("n") / F.col("whole")).alias("seed")), "seeds")
    senders = ways.select("kind", "host").distinct().withColumn("sends", F.lit(True))
    rank = before = start.withColumnRenamed("seed", "rank")
    for number in itertools.count() if rounds is None else range(rounds):
        moved = ways.join(rank, ["kind", "host"]).groupBy("kind", F.col("to").alias("host")).agg(F.sum(F.col("share") * F.col("rank")).alias("moved"))
        stuck = rank.join(senders, ["kind", "host"], "left").where("sends IS NULL").groupBy("kind").agg(F.sum("rank").alias("stuck"))  # two rows
        both = moved.unionByName(start.select("kind", "host", F.lit(0.0).alias("moved"))).groupBy("kind", "host").agg(F.sum("moved").alias("moved"))
        back = F.coalesce("seed", F.lit(0.0)) * (1 - damping + damping * F.coalesce("stuck", F.lit(0.0)))
        rank = both.join(start, ["kind", "host"], "left").join(F.broadcast(stuck), "kind", "left").select("kind", "host", (damping * F.col("moved") + back).alias("rank"))
        if number % BETWEEN == BETWEEN - 1:
            rank = scratch.save(rank, f"rank-{number}")  # lineage does not grow with the rounds
            if rounds is None and settled(before, rank):
                break
            scratch.drop(f"rank-{number - BETWEEN}")
            before = rank
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0)).alias(kind)
    return rank.groupBy("host").agg(of("trust"), of("distrust"))


def verdicts(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, rounds: int | None = None, damping: float = DAMPING, threshold: float = THRESHOLD) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of each row of ``pages`` (page_id, url, html)."""
    spark = pages.sparkSession
    scratch = Scratch(spark)
    cut = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = scratch.save(judged_by_rules(cut, rule_table(spark, rules)), "judged")
    seed = lambda verdict: F.count(F.when(F.col("by_rule") == verdict, 1))
    seeds = scratch.save(judged.groupBy("host").agg(seed("allow").alias("trust"), seed("block").alias("distrust")), "hosts")
    links = scratch.save(host_edges(pages), "links")
    named = seeds.select("host").unionByName(links.select(F.explode(F.array("a", "b")).alias("host"))).distinct().where("host <> ''")
    edges = links.unionByName(domain_edges(named)).groupBy("a", "b").agg(F.sum("links").alias("links"))
    ranks = propagated(edges, seeds, scratch, rounds, damping)
    result = judged.join(ranks, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("by_rule", F.when(F.col("distrust") - F.col("trust") > threshold + EVEN * (F.col("distrust") + F.col("trust")), "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
    result = scratch.keep(result)
    scratch.drop_all()
    return result
