"""URL filters by rules and by link-graph propagation, in native DataFrame operators.

*Rules* are ``host/path-prefix`` strings with a verdict.  A rule fits its host and all
subdomains if the url's path starts with the rule's path; the longest fitting rule wins.

*Propagation* judges what no rule fits, per host.  Hosts are linked by the absolute and
protocol-relative links of their pages (each pair of hosts once, whatever the number of
links) and, both ways, to the nearest domain above them that is a host too.  A host with
more than half its pages allowed by rules is a trusted seed, one with more than half
blocked a blocked seed; a seed's share is its number of pages.  Trust is a personalised
PageRank from the trusted seeds along the links, distrust one from the blocked seeds
against them (who links to a distrusted host is distrusted).  A host is blocked when its
distrust is over ``threshold`` percent of the sum of both; a host that neither reaches is
allowed.

Scores are whole numbers (shares of :data:`UNIT`) and every division rounds down, so the
result does not depend on the order in which contributions meet.  What does not pass on
along a link (a host without links) is lost.

Pages are only read: per page a regular expression finds host and path, and links are
reduced to distinct host pairs before the shuffle ends.  The propagation works on host
edges; its state is written every few rounds.  Pages of hosts that hold over a thousandth of
all pages meet their host's row in a broadcast join, so that a hot host is not one task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickstream.session import materialize

#: Sum of all seed shares; sums of scores stay far below 64 bits.
UNIT = 10**15
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: First ``://``, then the host, then the path.
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Links that name a host: ``href`` or ``src``, with a scheme or ``//``.
LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'<>\s]+)"""


def host_of(url: Column) -> Column:
    """The host, A-Z lowered; empty if the url is null or has no ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """``(rule, verdict)`` rows of a rule list such as ``[("net/es/", "block")]``."""
    return spark.createDataFrame(list(rules), "rule string, verdict string")


def _suffixes(host: Column) -> Column:
    """The host and every domain above it: ``a.b.c`` -> ``[a.b.c, b.c, c]``."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)),
                       lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def _host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``(host, own)``: the rules of each host or a domain above it, longest first (equal lengths by rule)."""
    split = rules.where(F.col("rule").isNotNull() & F.col("verdict").isNotNull()).distinct().select(
        F.substring_index("rule", "/", 1).alias("at"),
        F.struct((-F.char_length("rule")).alias("size"), F.col("rule"), F.col("verdict"),
                 F.expr("substr(rule, char_length(substring_index(rule, '/', 1)) + 1)").alias("path")).alias("one"))
    return (hosts.where("host <> ''").select("host", F.explode(_suffixes(F.col("host"))).alias("at"))
            .join(split, "at").groupBy("host").agg(F.sort_array(F.collect_list("one")).alias("own")))


def host_edges(pages: DataFrame, html_col: str, hosts: DataFrame) -> DataFrame:
    """Distinct ``(src, dst)`` pairs of known hosts, by links and by domain; ``pages`` has a column ``host``.

    A link's user name and port are not part of its host.  Links to hosts without pages carry
    nothing to a page and are left out.
    """
    raw = F.regexp_extract_all(F.col(html_col), F.lit(LINK), 1)
    name = F.translate(F.regexp_replace(F.substring_index(F.col("to"), "@", -1), r":\d*$", ""), _UPPER, _LOWER)
    links = (pages.where("host <> ''").select("host", F.explode(F.array_distinct(raw)).alias("to"))
             .select(F.col("host").alias("src"), name.alias("dst")).where("src <> dst").distinct())
    known = hosts.select(F.col("host").alias("dst"))
    links = links.join(known, "dst", "left_semi").select("src", "dst")
    above = (hosts.where("host <> ''").select(F.col("host").alias("src"), F.posexplode(_suffixes(F.col("host"))).alias("up", "dst"))
             .where("up > 0").join(known, "dst", "left_semi")
             .groupBy("src").agg(F.min_by("dst", "up").alias("dst")))
    return (links.unionByName(above).unionByName(above.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
            .distinct())


def propagate(seeds: DataFrame, edges: DataFrame, rounds: int = 10, damping: int = 85, write_every: int = 5) -> DataFrame:
    """``(host, trust, distrust)`` from ``seeds`` (host, trusted, blocked: page numbers) over ``edges`` (src, dst).

    One state of ``(kind, host)`` rows holds both walks.  Each round is ``(100 - damping)``
    percent of the seed share and ``damping`` percent of what the neighbours pass on, each
    neighbour the same part to all its links.
    """
    total = seeds.agg(*[F.sum(c).alias(c) for c in ("trusted", "blocked")])
    part = lambda c: F.call_function("div", F.lit(UNIT), F.greatest(F.col(f"all.{c}"), F.lit(1)))
    one = total.select(F.struct("trusted", "blocked").alias("all"))
    state = (seeds.crossJoin(F.broadcast(one))  # one row of sums, not a product
             .select("host", F.explode(F.array(
                 F.struct(F.lit(0).alias("kind"), (F.col("trusted") * part("trusted")).alias("seed")),
                 F.struct(F.lit(1).alias("kind"), (F.col("blocked") * part("blocked")).alias("seed")))).alias("x"))
             .select("x.kind", "host", "x.seed", F.col("x.seed").alias("score")))
    flow = edges.select(F.lit(0).alias("kind"), "src", "dst").unionByName(
        edges.select(F.lit(1).alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst")))
    flow = materialize(flow.join(flow.groupBy("kind", "src").agg(F.count(F.lit(1)).alias("degree")), ["kind", "src"]),
                       "host-flow")
    state = materialize(state, "host-seeds")
    for k in range(1, rounds + 1):
        passed = (state.select("kind", F.col("host").alias("src"), "score").where("score > 0").join(flow, ["kind", "src"])
                  .groupBy("kind", F.col("dst").alias("host"))
                  .agg(F.sum(F.call_function("div", F.col("score"), F.col("degree"))).alias("got")))
        fresh_part = F.col("seed") * (100 - damping) + F.coalesce("got", F.lit(0)) * damping
        state = state.join(passed, ["kind", "host"], "left").select(
            "kind", "host", "seed", F.call_function("div", fresh_part, F.lit(100)).alias("score"))
        if k % write_every == 0 and k < rounds:
            state = materialize(state, "host-scores")  # cut the plan
    return state.groupBy("host").agg(F.sum(F.when(F.col("kind") == 0, F.col("score")).otherwise(0)).alias("trust"),
                                     F.sum(F.when(F.col("kind") == 1, F.col("score")).otherwise(0)).alias("distrust"))


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", html_col: str = "html", rounds: int = 10,
          damping: int = 85, threshold: int = 50, out: str = "judged") -> DataFrame:
    """``pages`` with one more column ``out``: ``struct(host, path, rule, verdict, trust, distrust)``.

    ``rules`` has ``rule`` (``host/path-prefix``) and ``verdict`` (``allow`` or ``block``);
    rows with a null in either are no rules.  Null urls and urls without ``://`` have an empty
    host and path, fit no rule, are in no graph and are allowed.  Null html holds no links.
    Every row is judged by itself, repeated or not; other columns stay, whatever their names.
    Empty tables give no rows, or (no rules) no seeds: then everything is allowed.
    """
    cols = [f"c{i}" for i in range(len(pages.columns))]  # own names: unread columns are pruned, none clashes
    base = pages.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(pages.columns, cols)],
                        host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    seen = base.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    own = materialize(seen.join(_host_rules(seen, rules), "host", "left"), "host-rules")
    n_pages = own.agg(F.sum("pages")).first()[0] or 0
    # the longest rule whose path fits
    hit = F.get(F.filter(F.col("own"), lambda r: F.startswith(F.col("path"), r["path"])), F.lit(0))
    ruled = _with_host(base.select("host", "path"), own, n_pages).withColumn("hit", hit)
    n = lambda v: F.sum((F.col("hit.verdict") == v).cast("long"))
    by_host = (ruled.groupBy("host").agg(F.count(F.lit(1)).alias("pages"), F.coalesce(n("allow"), F.lit(0)).alias("allowed"),
                                         F.coalesce(n("block"), F.lit(0)).alias("stopped")))
    seeds = materialize(by_host.where("host <> ''").select(
        "host", F.when(F.col("allowed") * 2 > F.col("pages"), F.col("pages")).otherwise(0).alias("trusted"),
        F.when(F.col("stopped") * 2 > F.col("pages"), F.col("pages")).otherwise(0).alias("blocked")), "host-seed-pages")
    linked = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    scores = propagate(seeds, host_edges(linked, "html", seeds.select("host")), rounds, damping)
    judged = materialize(own.join(scores, "host", "left").select(
        "host", "own", "pages", F.coalesce("trust", F.lit(0)).alias("trust"), F.coalesce("distrust", F.lit(0)).alias("distrust")),
        "host-verdicts")
    bad = F.col("distrust") * 100 > (F.col("trust") + F.col("distrust")) * threshold
    verdict = F.coalesce(F.col("hit.verdict"), F.when(bad, F.lit("block")).otherwise(F.lit("allow")))
    done = _with_host(base, judged, n_pages).withColumn("hit", hit)
    return done.select(*[F.col(n).alias(c) for c, n in zip(pages.columns, cols)], F.struct(
        "host", "path", F.col("hit.rule").alias("rule"), verdict.alias("verdict"), "trust", "distrust").alias(out))


def _with_host(base: DataFrame, table: DataFrame, n_pages: int) -> DataFrame:
    """``base`` with its host's row of ``table``, which has every host once and its number of ``pages``.

    Hosts with over a thousandth of the pages, fewer than a thousand, are broadcast, so their
    pages are not shuffled; the others meet in a join by host.
    """
    hot = F.col("pages") * 1000 > n_pages
    often = table.where(hot).drop("pages")
    rest = base.join(F.broadcast(often.select("host")), "host", "left_anti")
    return (base.join(F.broadcast(often), "host").unionByName(rest.join(table.where(~hot).drop("pages"), "host")))


def keep_allowed(pages: DataFrame, rules: DataFrame, **options) -> DataFrame:
    """The rows of ``pages`` that are allowed; columns unchanged."""
    out = "__judged"
    while out in {c.lower() for c in pages.columns}:
        out += "_"
    return judge(pages, rules, out=out, **options).where(F.col(f"{out}.verdict") == "allow").select(
        *[F.col(f"`{c}`") for c in pages.columns])
