"""Routing of fetched pages into outcomes.

All per-row decisions are `when` chains inside one projection; the only
cross-row facts (first abort, crawl start) are one-row aggregates used as
scalar subqueries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import urls as U
from ..functions.html import RegionRule
from ..operators.page import BODY, parse_pages

INDEXED, SKIPPED, NOT_FOUND, ERROR, ABORT, ITEM_MISSING = (
    "INDEXED", "SKIPPED", "NOT_FOUND", "ERROR", "ABORT", "ITEM_MISSING")


def fetch_pages(log: DataFrame, pages: DataFrame) -> DataFrame:
    """Attach the fetched body, or what `parse_bodies` read in it, to each log row (join on page id)."""
    return log.join(pages.select("page_id", *[c for c in ("html", *BODY) if c in pages.columns]), "page_id", "left")


def parse_fetches(fetches: DataFrame, index_rules=(), follow_rules=(), compat: bool = False) -> DataFrame:
    """B1, B2, C1-C8 on a fetch log: effective URL, key, gated parse. Bodies read beforehand are not parsed again for each fetch."""
    f = fetches.withColumn("url", U.effective_url("response_uri", "step_uri"))
    gate = H.html_gate(F.col("status"), F.col("content_type"))
    return parse_pages(f, gate=gate, index_rules=index_rules, follow_rules=follow_rules, compat=compat)


def skip_reason(custom: Column | None = None, adhere: bool = True) -> Column:
    """First reason to skip a parsed page: custom veto, robots/internal
    index meta, canonical mismatch. Only when robot rules are adhered to and
    the page was parsed."""
    if not adhere:
        return F.lit(None).cast("string")
    c = F.when(custom, F.lit("CrawlDocumentAnalyse Skip = true")) if custom is not None else F.lit(None).cast("string")
    return F.when(F.col("parsed"), F.coalesce(c, F.col("noindex_reason"), F.col("canonical_reason")))


def route_status(status: Column, depth: Column, reason: Column) -> Column:
    """200 → INDEXED or SKIPPED; 404 → NOT_FOUND; 503 → ABORT; other →
    ERROR, or ABORT when at depth 0."""
    return (F.when(status == 200, F.when(reason.isNull(), F.lit(INDEXED)).otherwise(F.lit(SKIPPED)))
            .when(status == 404, F.lit(NOT_FOUND))
            .when(status == 503, F.lit(ABORT))
            .when(depth == 0, F.lit(ABORT))
            .otherwise(F.lit(ERROR)))


def narrow_outcomes(log: DataFrame) -> DataFrame:
    """(seq, depth, status, outcome) without the pages: enough for aborts, which depend on status and depth alone."""
    return log.select("seq", "depth", "status", route_status(F.col("status"), F.col("depth"), F.lit(None).cast("string")).alias("outcome"))


def outcomes(parsed: DataFrame, custom: Column | None = None, adhere: bool = True) -> DataFrame:
    """Outcome and reason per fetch (parsed columns kept)."""
    r = skip_reason(custom, adhere)
    return parsed.withColumn("reason", r).withColumn(
        "outcome", route_status(F.col("status"), F.col("depth"), F.col("reason")))


def abort_cut(df: DataFrame) -> DataFrame:
    """The first ABORT (by seq) ends the run; later rows do not count."""
    first = df.filter(F.col("outcome") == ABORT).agg(F.min("seq").alias("s"))
    first = first.scalar()
    return df.filter(first.isNull() | (F.col("seq") <= first))


def limit_depth(df: DataFrame, max_depth: int) -> DataFrame:
    """Keep depth <= max when max > 0."""
    return df.filter(F.col("depth") <= max_depth) if max_depth > 0 else df


def limit_documents(df: DataFrame, n: int) -> DataFrame:
    """The first n fetches in crawl order (depth, then seq) when n > 0."""
    return df.orderBy("depth", "seq").limit(n) if n > 0 else df


def limit_time(df: DataFrame, seconds: int) -> DataFrame:
    """Fetches within `seconds` of the crawl's first fetch, when > 0."""
    if seconds <= 0:
        return df
    start = df.agg(F.min("fetched_at").alias("t0")).scalar()
    return df.filter(F.col("fetched_at") <= start + F.make_dt_interval(secs=F.lit(seconds)))


EVENT_NAMES = {INDEXED: "document_updated", NOT_FOUND: "document_not_found", ERROR: "document_error", ABORT: "document_error"}


def outcome_events(df: DataFrame, names: dict[str, str] = EVENT_NAMES) -> DataFrame:
    """Notifications: updated (INDEXED), not found, error (ERROR or ABORT); `names` maps outcomes to event names."""
    ev = F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.col("outcome"))
    return df.withColumn("event", ev).filter(F.col("event").isNotNull())


def crawl_report(df: DataFrame) -> DataFrame:
    """Pages, mean and max download seconds by status, outcome and host."""
    host = U.url_host(F.col("url"))
    return df.groupBy("status", "outcome", host.alias("host")).agg(
        F.count(F.lit(1)).alias("pages"),
        F.round(F.avg("download_seconds"), 6).alias("avg_seconds"),
        F.sum(F.round(F.col("download_seconds") * 100)).cast("bigint").alias("total_centis"),
        F.round(F.max("download_seconds"), 6).alias("max_seconds"))


def failed_fetches(df: DataFrame) -> DataFrame:
    """Fetches that failed (server errors), recorded with a message; the
    run goes on."""
    bad = df.filter(F.col("status") >= 500)
    return bad.select("seq", "doc_key", F.format_string("HTTP %d for %s", F.col("status"), F.col("doc_key")).alias("error"))


__all__ = ["RegionRule", "fetch_pages", "parse_fetches", "skip_reason", "route_status", "outcomes", "abort_cut",
           "limit_depth", "limit_documents", "limit_time", "outcome_events", "crawl_report", "failed_fetches"]
