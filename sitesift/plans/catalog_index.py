"""Registered queries over indexes that are kept current or ordered by impact."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.urls import url_host
from ..operators import route as R
from ..operators import search as SR
from ..operators import segments as SG
from ..operators import topk as TK
from ..operators.graph import robots_allowed
from ..operators.page import documents_as_index
from ..operators.route import INDEXED, NOT_FOUND
from ..operators.tree import tour_intervals
from ..session import stored
from ..sources import tables as S
from ..streaming import live as LV
from ..streaming import stream as ST
from . import flows
from . import sqlparts as Q
from .catalog import ORACLE, RANKED_SQL, register
from .catalog_crawl import CRAWL_SQL, fetched
from .catalog_more import ITEMS_SQL, _fetches, _root, enriched_page_index

# ---------------------------------------------------------------- an index kept current by a stream

#: Batches in which the versions of the documents arrive.
N_BATCHES = 6

# What the last versions of the documents say: some were only drafted, some were taken down.
DOCS_NOW_SQL = """docs_now AS (
  SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN concat('draft ', source, chr(10), lang) ELSE text END AS text, lang, source
  FROM documents WHERE doc_id % 5 = 0 OR doc_id % 7 <> 3)"""


def document_versions(spark, sf):
    """Two versions of each document, a draft and the whole text or its removal, in batches out of order:
    the older one may arrive later. Every fifth document stays a draft."""
    d = S.table(spark, sf, "documents", "doc_id", "text", "lang", "source")
    i = F.col("doc_id")
    draft = d.select("doc_id", F.concat(F.lit("draft "), "source", F.lit("\n"), "lang").alias("text"), "lang", "source",
                     (i * 2).alias("seq"), F.lit(INDEXED).alias("outcome"), (i % N_BATCHES).cast("int").alias("batch"))
    last = d.filter(i % 5 != 0).select("doc_id", "text", "lang", "source", (i * 2 + 1).alias("seq"),
                                       F.when(i % 7 == 3, NOT_FOUND).otherwise(INDEXED).alias("outcome"), ((i * 5 + 2) % N_BATCHES).cast("int").alias("batch"))
    return draft.unionByName(last)


def _streamed_index(spark, sf):
    """The versions through a file stream, batch by batch, into segments."""
    files, root, ck = (ST.scratch(spark, n) for n in ("versions", "segments", "segments-ck"))
    log = document_versions(spark, sf)
    per_batch = ST.write_batch_files([log.filter(F.col("batch") == b).drop("batch") for b in range(N_BATCHES)], files, log.count())
    stream = ST.read_fetch_stream(spark, files, log.drop("batch").schema, per_batch)
    ST.stream_segments(documents_as_index(stream), root, ck, fanout=3)
    return SG.open_segments(spark, root)


def _now(sql: str) -> str:
    return f"WITH {DOCS_NOW_SQL}, " + sql.removeprefix("WITH ").replace("FROM documents)", "FROM docs_now)")


@register("incremental_index", _now(f"""{Q.search_ctes(Q.BENCH_QUERIES)}{RANKED_SQL}
SELECT rk.query_id, rk.position, rk.path, dx.title, '' AS description, round(rk.score, 6) AS relevance,
       CAST(rk.total AS BIGINT) AS total
FROM rk JOIN dx ON dx.path = rk.path WHERE rk.position < 10"""))
def q_incremental_index(spark, sf):
    return SR.search_many(flows.benchmark_queries(spark, sf), _streamed_index(spark, sf), SR.SearchOptions(start=0, count=10))


@register("incremental_stats", _now(f"WITH {Q.documents_index_ctes()} SELECT field, term, df FROM tdf"))
def q_incremental_stats(spark, sf):
    return _streamed_index(spark, sf).term_df


# ---------------------------------------------------------------- first hits by impact-ordered blocks

@register("first_hits", f"""{Q.search_ctes(Q.BENCH_QUERIES)}{RANKED_SQL}
SELECT query_id, position, path, round(score, 6) AS score FROM rk WHERE position < 10""")
def q_first_hits(spark, sf):
    index = TK.impact_index(flows.document_index(spark, sf))
    hits = TK.top_hits(flows.benchmark_queries(spark, sf), index, 10)
    return hits.select("query_id", "position", "path", F.round("score", 6).alias("score"))


@register("first_hits_filtered", f"""{Q.search_ctes(Q.BENCH_QUERIES)},
f AS (SELECT sc.* FROM sc JOIN dx ON dx.path = sc.path WHERE lower(dx.language) IN ('de', 'fr')),
rk AS (SELECT query_id, path, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, path) - 1 AS BIGINT) AS position FROM f)
SELECT query_id, position, path, round(score, 6) AS score FROM rk WHERE position < 10""")
def q_first_hits_filtered(spark, sf):
    index = TK.impact_index(flows.document_index(spark, sf))
    hits = TK.top_hits(flows.benchmark_queries(spark, sf), index, 10, SR.SearchOptions(languages=["de", "fr"]))
    return hits.select("query_id", "position", "path", F.round("score", 6).alias("score"))


# ---------------------------------------------------------------- subtrees as intervals

TOUR_SQL = f"""WITH RECURSIVE {ITEMS_SQL},
way(item_no, k) AS (
  SELECT item_no, '/' || lpad(CAST(item_no AS VARCHAR), 12, '0') FROM items WHERE parent_no IS NULL
  UNION ALL
  SELECT c.item_no, w.k || '/' || lpad(CAST(c.item_no AS VARCHAR), 12, '0') FROM items c JOIN way w ON c.parent_no = w.item_no),
num AS (SELECT item_no, k, row_number() OVER (ORDER BY k) - 1 AS enter FROM way)"""


@register("tour_intervals", TOUR_SQL + """
SELECT a.item_no, a.enter, max(b.enter) AS leave FROM num a JOIN num b ON starts_with(b.k, a.k) GROUP BY a.item_no, a.enter""")
def q_tour_intervals(spark, sf):
    return tour_intervals(S.items(spark, sf))


def _interval_search(spark, sf, item_no, section_no=None, **options):
    tour = stored(tour_intervals(S.items(spark, sf)))
    ends = {r["item_no"]: (r["enter"], r["leave"]) for r in tour.filter(F.col("item_no").isin(item_no, section_no or item_no)).collect()}
    root = {**_root(spark, sf, item_no, section_no), "interval": ends[item_no]}
    if section_no is not None:
        root["section_interval"] = ends[section_no]
    index = enriched_page_index(spark, sf, tour)
    return SR.search_many(flows.benchmark_queries(spark, sf), index, SR.SearchOptions(root_item=root, **options))


@register("filter_subtree_interval", ORACLE["filter_subtree"])
def q_filter_subtree_interval(spark, sf):
    return _interval_search(spark, sf, 1, ignore_editor_options=True)


@register("filter_section_interval", ORACLE["filter_section"])
def q_filter_section_interval(spark, sf):
    return _interval_search(spark, sf, 4, 1)


# ---------------------------------------------------------------- robots rules with wildcards

#: Patterns of every host, as (pattern, allowed, the same as a regular expression).
ROBOTS_PATTERNS = (
    ("/", True, "^/"),
    ("/en/", False, "^/en/"),
    ("/en/*page=", True, "^/en/.*page="),
    ("/*utm_source", False, "^/.*utm_source"),
    ("/fr/*5$", False, "^/fr/.*5$"),
    ("/*/6*/$", False, "^/.*/6.*/$"),
    ("/de/7", False, "^/de/7"),
    ("/de/7*.html$", True, r"^/de/7.*\.html$"),
    ("/es/*", False, "^/es/.*"),
    ("/es/9$", True, "^/es/9$"),
)


@register("robots_wildcards", f"""WITH rr(pattern, allow, re) AS (VALUES {', '.join(f"('{p}', {str(a).lower()}, '{r}')" for p, a, r in ROBOTS_PATTERNS)}),
u AS (SELECT page_id, CASE WHEN starts_with(p, '/') THEN p ELSE '/' || p END AS path
      FROM (SELECT page_id, regexp_extract(url, {Q.lit(P.URL_PATH_QUERY)}, 1) AS p FROM pages))
SELECT u.page_id, arg_max(rr.allow, length(rr.pattern) * 2 + CAST(rr.allow AS INTEGER)) AS allowed
FROM u JOIN rr ON regexp_matches(u.path, rr.re) GROUP BY u.page_id""")
def q_robots_wildcards(spark, sf):
    pages = S.table(spark, sf, "pages", "page_id", "url")
    patterns = F.array(*[F.struct(F.lit(p).alias("prefix"), F.lit(a).alias("allow")) for p, a, _ in ROBOTS_PATTERNS])
    rules = pages.select(url_host("url").alias("host")).distinct().select("host", F.inline(patterns))
    return robots_allowed(pages, "url", rules).select("page_id", "allowed")


# ---------------------------------------------------------------- streams with side tables

def _outcome_stream(spark, sf):
    return R.outcomes(R.parse_fetches(_fetches(spark, sf)))


@register("stream_events", ORACLE["outcome_events"])
def q_stream_events(spark, sf):
    root, ck = ST.scratch(spark, "events"), ST.scratch(spark, "events-ck")
    LV.stream_events(_outcome_stream(spark, sf).select("seq", "doc_key", "outcome"), root, ck)
    return LV.read_events(spark, root)


WINDOW_SQL = CRAWL_SQL + """ SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, f.fetched_at)) // 1000000 AS window_start, o.status, o.outcome, count(*) AS pages,
  CAST(sum(round(o.download_seconds * 100)) AS BIGINT) AS total_centis, round(max(o.download_seconds), 6) AS max_seconds,
  count(*) FILTER (WHERE o.status >= 500) AS failed
  FROM oc2 o JOIN (SELECT event_id, ts AS fetched_at FROM events) f ON f.event_id = o.seq GROUP BY ALL"""


@register("window_report", WINDOW_SQL)
def q_window_report(spark, sf):
    o = R.outcomes(fetched(spark, sf))
    return LV.window_report(o).withColumn("window_start", F.unix_timestamp("window_start"))


@register("stream_report", WINDOW_SQL)
def q_stream_report(spark, sf):
    root, ck = ST.scratch(spark, "report"), ST.scratch(spark, "report-ck")
    LV.stream_report(_outcome_stream(spark, sf), root, ck, delay="10000 days")  # nothing is late
    return LV.read_report(spark, root).withColumn("window_start", F.unix_timestamp("window_start"))


@register("stream_items", f"""WITH {ITEMS_SQL}
SELECT h.page_id, i.item_no, CASE WHEN i.item_no IS NULL AND h.item_uri <> '' THEN 'ITEM_MISSING' END AS outcome
FROM hdr h LEFT JOIN iu i ON i.item_uri = h.item_uri AND h.item_uri <> ''""")
def q_stream_items(spark, sf):
    """Pages come before most of their items: a third of the items is known with each further batch."""
    files, root, ck = ST.scratch(spark, "pages"), ST.scratch(spark, "items"), ST.scratch(spark, "items-ck")
    heads = S.page_item_headers(spark, sf)
    per_batch = ST.write_batch_files([heads.filter(F.col("page_id") % 3 == b) for b in range(3)], files, heads.count())
    asked = []

    def items():
        asked.append(1)
        return S.items(spark, sf).filter(F.col("item_no") % 3 < len(asked))

    LV.stream_items(ST.read_fetch_stream(spark, files, heads.schema, per_batch), root, ck, items)
    here = LV.attached_pages(spark, root).select("page_id", "item_no", F.lit(None).cast("string").alias("outcome"))
    return here.unionByName(LV.waiting_pages(spark, root).select("page_id", F.lit(None).cast("bigint").alias("item_no"), "outcome"))


@register("stream_reach", ORACLE["crawl_reach"])
def q_stream_reach(spark, sf):
    """The links in four batches, the ones far from the seed first."""
    files, root, ck = ST.scratch(spark, "links"), ST.scratch(spark, "reach"), ST.scratch(spark, "reach-ck")
    links = S.edges(spark, sf)
    per_batch = ST.write_batch_files([links.filter(F.col("dst") % 4 == 3 - b) for b in range(4)], files, links.count())
    seeds = S.read_pages(spark, sf).filter(F.col("page_id") == 0).select(F.col("page_id").alias("node"))
    LV.stream_reach(ST.read_fetch_stream(spark, files, links.schema, per_batch), root, ck, seeds)
    return LV.read_reach(spark, root)
