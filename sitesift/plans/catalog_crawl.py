"""Registered crawl-side queries: routing, outcomes, document table updates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import urls as U
from ..operators import docs as DO
from ..operators import route as R
from ..operators.page import build_document, parse_bodies, parse_pages
from ..sources import tables as S
from . import sqlparts as Q
from .catalog import CRAWL_LOG_SQL, ORACLE, PAGES_META_SQL, register


def fetched(spark, sf, log=None, compat=False):
    """The fetches of a log with what their pages say; each page is parsed once, not once for each fetch."""
    bodies = parse_bodies(S.pages_meta(spark, sf), compat=compat)
    return R.parse_fetches(R.fetch_pages(log if log is not None else S.crawl_log(spark, sf), bodies), compat=compat)


def crawl(spark, sf, compat=False):
    return R.outcomes(fetched(spark, sf, compat=compat))


_NI = ("list_filter(ms, lambda m: lower(m.name) IN ('robots', 'internal-index') "
       "AND contains(lower(m.content), 'noindex'))")
CRAWL_SQL = f"""WITH {PAGES_META_SQL}, {CRAWL_LOG_SQL},
pr AS (SELECT page_id, {Q.metas('c')} AS ms, regexp_extract_all(c, {Q.lit(P.LINK_TAG)}, 0) AS lt,
              {Q.title('c')} AS title, {Q.text('c')} AS text
       FROM (SELECT page_id, {Q.clean("coalesce(html, '')")} AS c FROM pages_meta)),
cr AS (SELECT l.seq, l.page_id, l.depth, l.status, l.content_type, l.fetched_at, l.download_seconds,
              coalesce(l.response_uri, l.step_uri) AS url, {Q.doc_key('coalesce(l.response_uri, l.step_uri)')} AS doc_key,
              (l.status = 200 AND starts_with(lower(coalesce(l.content_type, '')), 'text/html')) AS parsed,
              pr.ms, pr.lt, pr.title, pr.text
       FROM crawl_log l LEFT JOIN pr ON pr.page_id = l.page_id
         AND l.status = 200 AND starts_with(lower(coalesce(l.content_type, '')), 'text/html')),
cr2 AS (SELECT *, {_NI} AS ni, list_filter(lt, lambda t: {Q.attr('t', 'rel')} = 'canonical') AS cn FROM cr),
cr3 AS (SELECT *,
          CASE WHEN parsed AND len(ni) > 0 THEN printf('encountered meta tag %s=''%s''', ni[1].name, ni[1].content) END AS noindex_reason,
          CASE WHEN parsed AND len(cn) > 0 AND NOT contains(lower({Q.attr('cn[1]', 'href')}), lower(doc_key))
               THEN printf('encountered canonical tag to ''%s''', {Q.attr('cn[1]', 'href')}) END AS canonical_reason
        FROM cr2),
oc AS (SELECT *, CASE WHEN parsed THEN coalesce(noindex_reason, canonical_reason) END AS reason FROM cr3),
oc2 AS (SELECT *, CASE WHEN status = 200 THEN CASE WHEN reason IS NULL THEN 'INDEXED' ELSE 'SKIPPED' END
                       WHEN status = 404 THEN 'NOT_FOUND' WHEN status = 503 THEN 'ABORT'
                       WHEN depth = 0 THEN 'ABORT' ELSE 'ERROR' END AS outcome FROM oc)"""


@register("route_status", CRAWL_SQL + " SELECT seq, outcome FROM oc2")
def q_route_status(spark, sf):
    return crawl(spark, sf).select("seq", "outcome")


@register("meta_noindex", CRAWL_SQL + " SELECT seq, noindex_reason FROM oc2 WHERE noindex_reason IS NOT NULL")
def q_meta_noindex(spark, sf):
    return crawl(spark, sf).filter(F.col("noindex_reason").isNotNull()).select("seq", "noindex_reason")


@register("canonical_mismatch", CRAWL_SQL + " SELECT seq, canonical_reason FROM oc2 WHERE canonical_reason IS NOT NULL")
def q_canonical_mismatch(spark, sf):
    return crawl(spark, sf).filter(F.col("canonical_reason").isNotNull()).select("seq", "canonical_reason")


@register("skip_reason", CRAWL_SQL + " SELECT seq, reason FROM oc2 WHERE reason IS NOT NULL")
def q_skip_reason(spark, sf):
    return crawl(spark, sf).filter(F.col("reason").isNotNull()).select("seq", "reason")


@register("custom_skip", CRAWL_SQL + """ SELECT seq, CASE WHEN parsed THEN coalesce(
    CASE WHEN contains(lower(title), 'the') THEN 'CrawlDocumentAnalyse Skip = true' END,
    noindex_reason, canonical_reason) END AS reason FROM oc2 WHERE parsed AND coalesce(
    CASE WHEN contains(lower(title), 'the') THEN 'x' END, noindex_reason, canonical_reason) IS NOT NULL""")
def q_custom_skip(spark, sf):
    o = R.outcomes(fetched(spark, sf), custom=F.lower(F.col("title")).contains("the"))
    return o.filter(F.col("reason").isNotNull()).select("seq", "reason")


@register("abort_cut", CRAWL_SQL + """ SELECT seq, outcome FROM oc2
  WHERE seq <= coalesce((SELECT min(seq) FROM oc2 WHERE outcome = 'ABORT'), 4611686018427387904)""")
def q_abort_cut(spark, sf):
    return R.abort_cut(crawl(spark, sf)).select("seq", "outcome")


@register("limit_depth", f"WITH {CRAWL_LOG_SQL} SELECT seq, depth FROM crawl_log WHERE depth <= 2")
def q_limit_depth(spark, sf):
    return R.limit_depth(S.crawl_log(spark, sf), 2).select("seq", "depth")


@register("limit_documents", f"WITH {CRAWL_LOG_SQL} SELECT seq, depth FROM crawl_log ORDER BY depth, seq LIMIT 100")
def q_limit_documents(spark, sf):
    return R.limit_documents(S.crawl_log(spark, sf), 100).select("seq", "depth")


@register("limit_time", f"""WITH {CRAWL_LOG_SQL}
SELECT seq FROM crawl_log WHERE fetched_at <= (SELECT min(fetched_at) FROM crawl_log) + INTERVAL 3600 SECOND""")
def q_limit_time(spark, sf):
    return R.limit_time(S.crawl_log(spark, sf), 3600).select("seq")


@register("outcome_events", CRAWL_SQL + """ SELECT seq, doc_key,
  CASE WHEN outcome = 'INDEXED' THEN 'document_updated' WHEN outcome = 'NOT_FOUND' THEN 'document_not_found'
       ELSE 'document_error' END AS event
  FROM oc2 WHERE outcome IN ('INDEXED', 'NOT_FOUND', 'ERROR', 'ABORT')""")
def q_outcome_events(spark, sf):
    return R.outcome_events(crawl(spark, sf)).select("seq", "doc_key", "event")


@register("crawl_report", CRAWL_SQL + f""" SELECT status, outcome, {Q.host('url')} AS host, count(*) AS pages,
  CAST(sum(round(download_seconds * 100)) AS BIGINT) AS total_centis, round(max(download_seconds), 6) AS max_seconds
  FROM oc2 GROUP BY ALL""")
def q_crawl_report(spark, sf):
    return R.crawl_report(crawl(spark, sf)).drop("avg_seconds")


@register("failed_fetches", CRAWL_SQL + """ SELECT seq, doc_key, printf('HTTP %d for %s', status, doc_key) AS error
  FROM oc2 WHERE status >= 500""")
def q_failed_fetches(spark, sf):
    return R.failed_fetches(crawl(spark, sf))


DOCS_SQL = CRAWL_SQL + f""",
dk AS (SELECT seq, doc_key AS path, coalesce(title, '') AS title, coalesce(text, '') AS text, depth, outcome,
         list_transform(list_filter(coalesce(ms, []), lambda m: lower(m.name) = 'description'), lambda m: {Q.trim_ws('m.content')}) AS ds,
         list_transform(list_filter(coalesce(ms, []), lambda m: lower(m.name) = 'keywords'), lambda m: {Q.trim_ws('m.content')}) AS ks
       FROM oc2)"""


def crawl_docs(spark, sf, tags="crawled,web", boost=1.0):
    o = crawl(spark, sf)
    return build_document(o, tags=tags, boost=boost, depth=F.col("depth"), run_id="run1")


@register("build_document", DOCS_SQL + """ SELECT seq, path, title, CAST(len(list_concat([text, title], ks, ds)) AS INTEGER) AS n_content,
  CASE WHEN len(ds) = 0 THEN '' ELSE ds[1] END AS description, depth, 'crawled,web' AS tags, CAST(1.0 AS DOUBLE) AS boost,
  'run1' AS run_id FROM dk WHERE outcome = 'INDEXED'""")
def q_build_document(spark, sf):
    d = crawl_docs(spark, sf).filter(F.col("outcome") == R.INDEXED)
    return d.select("seq", "path", "title", F.size("content").cast("int").alias("n_content"),
                    F.get(F.col("description"), 0).alias("description"), "depth", "tags", "boost", "run_id")


@register("tag_documents", DOCS_SQL + " SELECT seq, path, 'crawled,web' AS tags FROM dk WHERE outcome = 'INDEXED'")
def q_tag_documents(spark, sf):
    return crawl_docs(spark, sf).filter(F.col("outcome") == R.INDEXED).select("seq", "path", "tags")


@register("doc_boost", DOCS_SQL + " SELECT seq, path, CAST(2.5 AS DOUBLE) AS boost FROM dk WHERE outcome = 'INDEXED'")
def q_doc_boost(spark, sf):
    return crawl_docs(spark, sf, boost=2.5).filter(F.col("outcome") == R.INDEXED).select("seq", "path", "boost")


OLD_SQL = f""",
old AS (SELECT DISTINCT {Q.doc_key('url')} AS path FROM pages_meta)"""


def _old_docs(spark, sf):
    pages = S.pages_meta(spark, sf)
    first = pages.groupBy(U.doc_key("url")).agg(F.min("page_id").alias("page_id")).select("page_id")
    d = build_document(parse_pages(pages.join(first, "page_id", "left_semi")), tags="crawled,web")
    return d.select("path", "title", "tags")


UPSERT_SQL = DOCS_SQL + OLD_SQL + """,
last AS (SELECT path, arg_max(outcome, seq) AS outcome, max(seq) AS seq FROM dk GROUP BY path),
up AS (SELECT path, CAST(NULL AS BIGINT) AS seq FROM old WHERE path NOT IN (SELECT path FROM last)
       UNION ALL SELECT path, seq FROM last WHERE outcome = 'INDEXED')"""


def _last_fetches(spark, sf):
    """The log's last fetch of each key, by the narrow columns alone; only these are parsed."""
    log = S.crawl_log(spark, sf)
    return DO.latest_fetch(log.withColumn("_key", U.doc_key(U.effective_url("response_uri", "step_uri"))), "_key", "seq").drop("_key")


def _upserted(spark, sf):
    o = R.outcomes(R.parse_fetches(R.fetch_pages(_last_fetches(spark, sf), S.pages_meta(spark, sf))))
    docs = build_document(o, tags="crawled,web", depth=F.col("depth"), run_id="run1").select("path", "title", "tags", "seq", "outcome")
    return DO.upsert_docs(_old_docs(spark, sf), docs)


@register("upsert_docs", UPSERT_SQL + " SELECT path, seq FROM up")
def q_upsert_docs(spark, sf):
    return _upserted(spark, sf).select("path", "seq")


@register("latest_per_key", DOCS_SQL + " SELECT path, max(seq) AS seq, arg_max(outcome, seq) AS outcome FROM dk GROUP BY path")
def q_latest_per_key(spark, sf):
    d = crawl_docs(spark, sf).select("path", "seq", "outcome")
    return DO.latest_fetch(d, "path").select("path", "seq", "outcome")


@register("publish_or_rollback", UPSERT_SQL + """ SELECT path, 'old' AS version FROM old
  WHERE EXISTS (SELECT 1 FROM oc2 WHERE outcome = 'ABORT')
  UNION ALL SELECT path, 'new' FROM up WHERE NOT EXISTS (SELECT 1 FROM oc2 WHERE outcome = 'ABORT')""")
def q_publish_or_rollback(spark, sf):
    old = _old_docs(spark, sf).select("path", F.lit("old").alias("version"))
    new = _upserted(spark, sf).select("path", F.lit("new").alias("version"))
    return DO.publish_or_rollback(old, new, R.narrow_outcomes(S.crawl_log(spark, sf)))


@register("publish_clean", UPSERT_SQL + """ SELECT path, 'old' AS version FROM old
  WHERE EXISTS (SELECT 1 FROM oc2 WHERE outcome = 'ABORT' AND NOT (depth = 0 AND status <> 503))
  UNION ALL SELECT path, 'new' FROM up
  WHERE NOT EXISTS (SELECT 1 FROM oc2 WHERE outcome = 'ABORT' AND NOT (depth = 0 AND status <> 503))""")
def q_publish_clean(spark, sf):
    """A run whose only aborts are depth-0 server errors that are re-routed as
    plain errors (no 503 in the log): the new table is published."""
    old = _old_docs(spark, sf).select("path", F.lit("old").alias("version"))
    new = _upserted(spark, sf).select("path", F.lit("new").alias("version"))
    return DO.publish_or_rollback(old, new, _without_depth0_errors(R.narrow_outcomes(S.crawl_log(spark, sf))))


def _without_depth0_errors(log):
    return log.filter(~((F.col("depth") == 0) & ~F.col("status").isin(200, 404, 503)))


PUBLISH_CLEAN_SQL = ORACLE["publish_clean"]


@register("publish_versions", PUBLISH_CLEAN_SQL)
def q_publish_versions(spark, sf):
    """Snapshots on disk: the old table is published as version 1, the new one written as version 2 and
    published unless its run aborted; the published one is read back."""
    from ..streaming.stream import scratch
    root = scratch(spark, "snapshots")
    DO.write_snapshot(_old_docs(spark, sf).select("path", F.lit("old").alias("version")), root, 1, True)
    log = _without_depth0_errors(R.narrow_outcomes(S.crawl_log(spark, sf)))
    clean = log.filter(F.col("outcome") == R.ABORT).isEmpty()
    DO.write_snapshot(_upserted(spark, sf).select("path", F.lit("new").alias("version")), root, 2, clean)
    return DO.read_published(spark, root)


#: Sequence number that answers 503: three fifths through the log.
ABORT_AT = "(SELECT max(event_id) * 3 // 5 FROM events)"


def _log_with_503(spark, sf):
    at = S.table(spark, sf, "events", "event_id").agg((F.max("event_id") * 3 / 5).cast("bigint")).first()[0]
    return _without_depth0_errors(S.crawl_log(spark, sf, abort_seq=at))


@register("abort_cut_503", CRAWL_SQL + f""", oc3 AS (SELECT seq, CASE WHEN seq = {ABORT_AT} THEN 'ABORT' ELSE outcome END AS outcome FROM oc2
  WHERE NOT (depth = 0 AND status NOT IN (200, 404)) OR seq = {ABORT_AT})
SELECT seq, outcome FROM oc3 WHERE seq <= {ABORT_AT}""")
def q_abort_cut_503(spark, sf):
    """A 503 late in the log: everything before it counts, nothing after."""
    return R.abort_cut(R.outcomes(fetched(spark, sf, _log_with_503(spark, sf)))).select("seq", "outcome")


@register("publish_rollback_503", UPSERT_SQL + " SELECT path, 'old' AS version FROM old")
def q_publish_rollback_503(spark, sf):
    """The run that meets a 503 is not published: the last good snapshot stays."""
    from ..streaming.stream import scratch
    root = scratch(spark, "snapshots")
    DO.write_snapshot(_old_docs(spark, sf).select("path", F.lit("old").alias("version")), root, 1, True)
    clean = R.narrow_outcomes(_log_with_503(spark, sf)).filter(F.col("outcome") == R.ABORT).isEmpty()
    DO.write_snapshot(_upserted(spark, sf).select("path", F.lit("new").alias("version")), root, 2, clean)
    return DO.read_published(spark, root)


@register("replace_tag", f"""WITH {PAGES_META_SQL},
od AS (SELECT '/doc/' || CAST(doc_id AS VARCHAR) AS path, coalesce(source, '') AS tags FROM documents),
nd AS (SELECT DISTINCT {Q.doc_key('url')} AS path, 'src3' AS tags FROM pages_meta)
SELECT path, tags FROM od WHERE tags <> 'src3' UNION ALL SELECT path, tags FROM nd""")
def q_replace_tag(spark, sf):
    from ..operators.page import documents_as_index
    old = documents_as_index(S.table(spark, sf, "documents", "doc_id", "text", "lang", "source")).select("path", "tags")
    new = parse_pages(S.pages_meta(spark, sf)).select(F.col("doc_key").alias("path")).distinct() \
        .withColumn("tags", F.lit("src3"))
    return DO.replace_tag(old, new, "src3").select("path", "tags")


@register("recover_published", """SELECT event_type AS index_name, max(CAST(user_id % 10 AS INTEGER)) AS version
  FROM events WHERE value > 50 GROUP BY event_type""")
def q_recover_published(spark, sf):
    ev = S.table(spark, sf, "events", "event_type", "user_id", "value")
    versions = ev.select(F.col("event_type").alias("index_name"), (F.col("user_id") % 10).cast("int").alias("version"),
                         (F.col("value") > 50).alias("published"))
    return DO.recover_published(versions)


@register("read_pages", "SELECT page_id, url, length(html) AS n_chars FROM pages")
def q_read_pages(spark, sf):
    return S.read_pages(spark, sf).select("page_id", "url", F.length("html").alias("n_chars"))

