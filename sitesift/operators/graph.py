"""Links and the link graph."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from .sizing import fits_broadcast


def seed_urls(raw: DataFrame, variables: Mapping[str, str] | None = None, col: str = "raw") -> DataFrame:
    """A1: transformed seeds; empty and malformed ones dropped."""
    return raw.withColumn("seed", U.seed_url(F.col(col), variables)).filter(F.col("seed").isNotNull())


def link_edges(parsed: DataFrame, key: str = "page_id", resolve: Callable[[Column, Column], Column] = U.resolve_link) -> DataFrame:
    """one row per link of a parsed page: raw link text, entity-decoded and
    resolved URL (malformed and empty ones dropped), referrer, depth + 1. Batch and
    stream. `resolve` makes a URL of (base, link)."""
    e = parsed.select(key, F.col("url").alias("referrer"), "base_url", "depth", F.explode("links").alias("link_raw"))
    e = e.withColumn("link_url", resolve(F.col("base_url"), U.decode_entities(F.col("link_raw"))))
    e = e.filter(F.col("link_url").isNotNull() & U.is_well_formed(F.col("link_url")))
    return e.select(key, "link_raw", "link_url", "referrer", (F.col("depth") + 1).cast("int").alias("depth"))


def same_site(links: DataFrame, url_col: str, seeds: DataFrame, seed_col: str) -> DataFrame:
    """Keep links whose host is the host of a seed (case-insensitive).
    The distinct seed hosts join on host; a semi join never duplicates rows."""
    hosts = seeds.select(U.url_host(F.col(seed_col)).alias("_host")).distinct()
    hosts = F.broadcast(hosts) if fits_broadcast(hosts) else hosts
    return links.join(hosts, U.url_host(F.col(url_col)) == hosts["_host"], "left_semi")


def _literal(prefix) -> Column:
    """The part of a rule's pattern before its first `*` or its closing `$`."""
    return F.regexp_extract(F.regexp_replace(prefix, r"\$$", ""), r"^([^*]*)", 1)


def _rule_fits(path: Column, prefix: Column) -> Column:
    """Whether a path begins with a pattern: `*` stands for any run of characters, `$` at the end for the end.

    The pieces between stars are looked for from left to right, each at its first
    place; the last one before a `$` has to end the path. No backtracking.
    """
    closed = prefix.endswith("$")
    pieces = F.split(F.regexp_replace(prefix, r"\$$", ""), r"\*")
    n = F.size(pieces)
    between = F.filter(F.slice(pieces, 2, F.greatest(n - F.when(closed, 2).otherwise(1), F.lit(0))), lambda p: p != "")
    first, last = F.get(pieces, 0), F.element_at(pieces, -1)
    found = lambda p, at: F.call_function("locate", p, path, at)
    after = F.aggregate(between, F.length(first) + 1, lambda at, p: F.when(
        (at > 0) & (found(p, at) > 0), found(p, at) + F.length(p)).otherwise(F.lit(0)))
    end = F.when(n == 1, path == first).otherwise(path.endswith(last) & (F.length(path) - F.length(last) + 1 >= after))
    return path.startswith(first) & F.when(closed, (after > 0) & end).otherwise(after > 0)


def robots_allowed(urls: DataFrame, url_col: str, rules: DataFrame) -> DataFrame:
    """`allowed` per URL row: the longest matching pattern of its host
    decides (allow wins a tie); no matching rule → allowed. Patterns match path
    and query from the start; `*` and a closing `$` are wildcards. Null and empty
    patterns match nothing.

    Decided once per distinct (host, path), by an equi-join: a path gives its
    beginnings of the lengths that the literal parts of its host's rules have (one
    row for each length, not each rule), and these meet the rules on (host, literal
    part). Only rules with wildcards are then tested further.
    """
    u = urls.withColumn("_host", U.url_host(F.col(url_col))).withColumn("_path", U.url_path_query(F.col(url_col)))
    r = rules.filter(F.col("prefix") != "").select(F.lower("host").alias("_host"), "prefix", "allow", _literal(F.col("prefix")).alias("_start"))
    lengths = r.groupBy("_host").agg(F.collect_set(F.length("_start")).alias("_lengths"))  # as many as the longest rule has characters
    lengths, r = (F.broadcast(x) if fits_broadcast(x) else x for x in (lengths, r))
    starts = u.select("_host", "_path").distinct().join(lengths, "_host").withColumn("_length", F.explode("_lengths"))
    starts = starts.filter(F.length("_path") >= F.col("_length")).withColumn("_start", F.expr("substring(_path, 1, _length)"))
    m = starts.join(r, ["_host", "_start"])
    m = m.filter(~F.col("prefix").rlike(r"\*|\$$") | _rule_fits(F.col("_path"), F.col("prefix")))
    dec = m.groupBy("_host", "_path").agg(F.max_by("allow", F.struct(F.length("prefix"), F.col("allow"))).alias("_allow"))
    return u.join(dec, ["_host", "_path"], "left").withColumn("allowed", F.coalesce(F.col("_allow"), F.lit(True))) \
        .drop("_host", "_path", "_allow")


def crawl_reach(seeds: DataFrame, edges: DataFrame, max_depth: int = 0, src: str = "src", dst: str = "dst",
                partitions: int | None = None) -> DataFrame:
    """breadth-first reach: (node, depth of first visit), each node once.

    Edges are hash-partitioned by source once and checkpointed, so every level
    joins the (small) frontier to them without re-shuffling the edges. Each
    level's new nodes are checkpointed to the shared checkpoint folder once; the
    seen set is the union of the levels and is not rewritten. Stops when the frontier is empty or at `max_depth` (> 0).
    """
    spark = edges.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    e = edges.select(F.col(src).alias("node"), F.col(dst).alias("next")).distinct() \
        .repartition(n, "node").checkpoint(eager=True)
    frontier = seeds.select(F.col("node")).distinct().withColumn("depth", F.lit(0)).repartition(n, "node") \
        .checkpoint(eager=True)
    seen = frontier
    depth = 0
    while max_depth <= 0 or depth < max_depth:
        depth += 1
        nxt = frontier.select("node").join(e, "node").select(F.col("next").alias("node")).distinct()
        nxt = nxt.join(seen.select("node"), "node", "left_anti").withColumn("depth", F.lit(depth))
        nxt = nxt.repartition(n, "node").checkpoint(eager=True)
        if nxt.isEmpty():
            break
        seen, frontier = seen.unionByName(nxt), nxt
    return seen


def broken_links(edges: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(link key, outcome, referrer) for links whose target failed."""
    bad = outcomes.filter(F.col("outcome").isin("NOT_FOUND", "ERROR", "ABORT")).select("doc_key", "outcome").distinct()
    return edges.join(bad, edges["link_key"] == bad["doc_key"]).select("doc_key", "outcome", "referrer", "link_raw")
