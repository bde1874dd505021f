"""Registered queries: one Spark DataFrame per operator of SURVEY 2, and, where
SQL can say the same, the DuckDB SQL that must give the same rows.

Every query reads the given tables (or tables Spark derives from them) whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import patterns as P
from ..functions import text as TX
from ..functions import urls as U
from ..operators import search as SR
from ..operators.index import build_postings, field_lengths, term_stats
from ..operators.page import documents_as_index, parse_pages
from ..sources import tables as S
from . import flows
from . import sqlparts as Q

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _parsed(spark, sf, src="pages"):
    df = S.pages_meta(spark, sf) if src == "pages_meta" else S.read_pages(spark, sf)
    return parse_pages(df)


PAGES_META_SQL = """
pages_meta AS (
  SELECT page_id, url, replace(html, '</head>', concat(
    CASE WHEN page_id % 7 = 0 THEN '<meta name="Robots" content="NOINDEX, follow">'
         WHEN page_id % 11 = 0 THEN '<meta name="internal-index" content="noindex">' ELSE '' END,
    CASE WHEN page_id % 5 = 0 THEN '<link rel="canonical" href="http://other.example.com/x">'
         WHEN page_id % 5 = 1 THEN concat('<link rel="canonical" href="', url, '">') ELSE '' END,
    CASE WHEN page_id % 3 = 0 THEN concat('<meta name="description" content="about page ',
         CAST(page_id AS VARCHAR), '">') ELSE '' END,
    CASE WHEN page_id % 4 = 0 THEN '<meta name="keywords" content="alpha,beta">' ELSE '' END,
    CASE WHEN page_id % 6 = 0 THEN '<meta name="efcrawler:extrafield:shelf" content="s1">' ELSE '' END,
    '</head>')) AS html
  FROM pages)"""

CRAWL_LOG_SQL = """
crawl_log AS (
  SELECT e.event_id AS seq, p.page_id, p.url AS step_uri,
         CASE WHEN e.event_id % 13 = 0 THEN regexp_replace(p.url, '^http://', 'https://') END AS response_uri,
         CAST(e.user_id % 4 AS INTEGER) AS depth,
         CAST(CASE WHEN e.event_type = 'error' AND e.event_id % 3 = 0 THEN 500
              WHEN e.event_type = 'error' THEN 404 ELSE 200 END AS INTEGER) AS status,
         CASE WHEN e.event_id % 11 = 0 THEN 'application/pdf' ELSE 'text/html; charset=utf-8' END AS content_type,
         e.ts AS fetched_at, e.value AS download_seconds
  FROM (SELECT ev.*, ev.event_id % n.n_pages AS pid
        FROM events ev CROSS JOIN (SELECT count(*) AS n_pages FROM pages) n) e
  JOIN pages p ON p.page_id = e.pid)"""

PARSED_SQL = f"pp AS ({Q.parsed_pages('pages')})"
PARSED_META_SQL = PAGES_META_SQL + f", pp AS ({Q.parsed_pages('pages_meta')})"


# ---------------------------------------------------------------- 2.3 fields

@register("extract_title", f"WITH {PARSED_SQL} SELECT page_id, {Q.title('c')} AS title FROM pp")
def q_extract_title(spark, sf):
    return _parsed(spark, sf).select("page_id", "title")


@register("extract_text", f"WITH {PARSED_SQL} SELECT page_id, {Q.text('c')} AS text FROM pp")
def q_extract_text(spark, sf):
    return _parsed(spark, sf).select("page_id", "text")


@register("extract_links", f"""WITH {PARSED_SQL}
SELECT DISTINCT page_id, link FROM (SELECT page_id, unnest({Q.links('c')}) AS link FROM pp)""")
def q_extract_links(spark, sf):
    return _parsed(spark, sf).select("page_id", F.explode("links").alias("link"))


@register("extract_metas", f"""WITH {PARSED_META_SQL},
mm AS (SELECT page_id, {Q.metas('c')} AS ms FROM pp)
SELECT page_id, CAST(i - 1 AS INTEGER) AS meta_no, ms[i].name AS name, ms[i].content AS content
FROM (SELECT page_id, ms, generate_subscripts(ms, 1) AS i FROM mm)""")
def q_extract_metas(spark, sf):
    p = _parsed(spark, sf, "pages_meta")
    return p.select("page_id", F.posexplode("metas").alias("meta_no", "m")).select(
        "page_id", F.col("meta_no").cast("int"), F.col("m.name").alias("name"), F.col("m.content").alias("content"))


@register("html_gate", f"""WITH {CRAWL_LOG_SQL}
SELECT seq, (status = 200 AND starts_with(lower(coalesce(content_type, '')), 'text/html')) AS parse FROM crawl_log""")
def q_html_gate(spark, sf):
    return S.crawl_log(spark, sf).select("seq", H.html_gate("status", "content_type").alias("parse"))


@register("keywords_content", f"""WITH {PARSED_META_SQL},
mm AS (SELECT page_id, {Q.metas('c')} AS ms FROM pp)
SELECT page_id, {Q.trim_ws('m.content')} AS keywords
FROM (SELECT page_id, unnest(ms) AS m FROM mm) WHERE lower(m.name) = 'keywords'""")
def q_keywords_content(spark, sf):
    p = _parsed(spark, sf, "pages_meta")
    return p.select("page_id", F.explode(H.keywords_values("metas")).alias("keywords"))


@register("description_field", f"""WITH {PARSED_META_SQL},
mm AS (SELECT page_id, {Q.metas('c')} AS ms FROM pp),
d AS (SELECT page_id, list_transform(list_filter(ms, lambda m: lower(m.name) = 'description'),
                                     lambda m: {Q.trim_ws('m.content')}) AS ds FROM mm)
SELECT page_id, unnest(CASE WHEN len(ds) = 0 THEN [''] ELSE ds END) AS description FROM d""")
def q_description_field(spark, sf):
    p = _parsed(spark, sf, "pages_meta")
    d = H.description_values("metas")
    return p.select("page_id", F.explode(F.when(F.size(d) == 0, F.array(F.lit(""))).otherwise(d)).alias("description"))


@register("extra_fields", f"""WITH {PARSED_META_SQL},
mm AS (SELECT page_id, {Q.metas('c')} AS ms FROM pp)
SELECT page_id, substr(m.name, {len(H.EXTRA_PREFIX) + 1}) AS field, m.content AS value
FROM (SELECT page_id, unnest(ms) AS m FROM mm)
WHERE starts_with(lower(m.name), '{H.EXTRA_PREFIX}') AND length(m.name) > {len(H.EXTRA_PREFIX)}""")
def q_extra_fields(spark, sf):
    p = _parsed(spark, sf, "pages_meta")
    return p.select("page_id", F.explode(H.extra_fields("metas")).alias("field", "vals")).select(
        "page_id", "field", F.explode("vals").alias("value"))


@register("content_values", f"""WITH {PARSED_META_SQL},
mm AS (SELECT page_id, {Q.title('c')} AS title, {Q.text('c')} AS text, {Q.metas('c')} AS ms FROM pp),
cv AS (SELECT page_id, list_concat([text, title],
          list_transform(list_filter(ms, lambda m: lower(m.name) = 'keywords'), lambda m: {Q.trim_ws('m.content')}),
          list_transform(list_filter(ms, lambda m: lower(m.name) = 'description'), lambda m: {Q.trim_ws('m.content')})) AS vs
       FROM mm)
SELECT page_id, CAST(i - 1 AS INTEGER) AS value_no, vs[i] AS value
FROM (SELECT page_id, vs, generate_subscripts(vs, 1) AS i FROM cv)""")
def q_content_values(spark, sf):
    from ..operators.page import build_document
    d = build_document(_parsed(spark, sf, "pages_meta"))
    return d.select("page_id", F.posexplode("content").alias("value_no", "value")).select(
        "page_id", F.col("value_no").cast("int"), "value")


# ---------------------------------------------------------------- 2.2 URLs

@register("doc_key", f"SELECT page_id, {Q.doc_key('url')} AS doc_key FROM pages")
def q_doc_key(spark, sf):
    return S.read_pages(spark, sf).select("page_id", U.doc_key("url").alias("doc_key"))


@register("strip_fragment", f"SELECT page_id, {Q.strip_fragment('url')} AS url FROM pages")
def q_strip_fragment(spark, sf):
    return S.read_pages(spark, sf).select("page_id", U.strip_fragment("url").alias("url"))


@register("url_identity", f"""SELECT page_id,
  CASE WHEN regexp_matches(u, {Q.lit(P.URL_SCHEME)})
       THEN lower(regexp_extract(u, {Q.lit(P.URL_SCHEME)}, 1)) || '://' || regexp_extract(u, {Q.lit(P.URL_USERINFO)}, 1)
            || lower(regexp_extract(u, {Q.lit(r'^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)')}, 1))
            || lower(regexp_extract(u, {Q.lit(P.URL_AFTER_AUTHORITY)}, 1))
       ELSE lower(u) END AS url_key
FROM (SELECT page_id, {Q.strip_fragment('url')} AS u FROM pages)""")
def q_url_identity(spark, sf):
    return S.read_pages(spark, sf).select("page_id", U.url_identity("url").alias("url_key"))


@register("effective_url", f"WITH {CRAWL_LOG_SQL} SELECT seq, coalesce(response_uri, step_uri) AS url FROM crawl_log")
def q_effective_url(spark, sf):
    return S.crawl_log(spark, sf).select("seq", U.effective_url("response_uri", "step_uri").alias("url"))


@register("depth_marker", f"WITH {CRAWL_LOG_SQL} SELECT seq, repeat('-', depth) AS marker FROM crawl_log")
def q_depth_marker(spark, sf):
    return S.crawl_log(spark, sf).select("seq", U.depth_marker("depth").alias("marker"))


@register("decode_entities", f"""WITH {PARSED_SQL},
t AS (SELECT page_id, array_to_string(regexp_extract_all(c, {Q.lit(P.TITLE)}, 1), ';') AS raw FROM pp)
SELECT page_id,
  replace(replace(replace(replace(replace(replace(replace(replace(
    list_reduce(list_distinct(regexp_extract_all(raw, {Q.lit(P.NUM_ENTITY)}, 0)),
      lambda acc, r: replace(acc, r, CASE
        WHEN regexp_matches(r, '^&#[xX]') THEN chr(CAST(('0x' || regexp_extract(r, '([0-9a-fA-F]+)', 1)) AS INTEGER))
        ELSE chr(CAST(regexp_extract(r, '([0-9]+)', 1) AS INTEGER)) END), raw),
  '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&apos;', ''''), '&nbsp;', chr(160)), '&copy;', chr(169)),
  '&middot;', chr(183)), '&amp;', '&') AS decoded
FROM t""")
def q_decode_entities(spark, sf):
    p = S.read_pages(spark, sf).select("page_id", H.clean_html("html").alias("c"))
    raw = F.array_join(F.regexp_extract_all("c", F.lit(P.TITLE), 1), ";")
    return p.select("page_id", U.decode_entities(raw).alias("decoded"))


@register("base_url", f"WITH {PARSED_SQL} SELECT page_id, {Q.base_url('c', 'url')} AS base_url FROM pp")
def q_base_url(spark, sf):
    return _parsed(spark, sf).select("page_id", "base_url")


LINKS_SQL = f"""{PARSED_SQL},
lk AS (SELECT DISTINCT page_id, url, base, link FROM (
         SELECT page_id, url, {Q.base_url('c', 'url')} AS base, unnest({Q.links('c')}) AS link FROM pp)),
rl AS (SELECT page_id, url, link, {Q.resolve('base', 'link')} AS resolved FROM lk)"""


def _resolved_links(spark, sf):
    p = _parsed(spark, sf)
    l = p.select("page_id", F.col("url"), "base_url", F.explode("links").alias("link"))
    return l.select("page_id", "url", "link", U.resolve_link("base_url", "link").alias("resolved"))


@register("resolve_link", f"WITH {LINKS_SQL} SELECT page_id, link, resolved FROM rl")
def q_resolve_link(spark, sf):
    return _resolved_links(spark, sf).select("page_id", "link", "resolved")


@register("drop_malformed", f"WITH {LINKS_SQL} SELECT page_id, resolved FROM rl WHERE {Q.well_formed('resolved')}")
def q_drop_malformed(spark, sf):
    r = _resolved_links(spark, sf)
    return r.filter(U.is_well_formed("resolved")).select("page_id", "resolved")


@register("exclude_urls", f"""WITH {LINKS_SQL}
SELECT page_id, resolved FROM rl WHERE NOT regexp_matches(resolved, {Q.lit(P.DEFAULT_EXCLUDE)})""")
def q_exclude_urls(spark, sf):
    r = _resolved_links(spark, sf)
    return r.filter(U.exclude_urls("resolved")).select("page_id", "resolved")


@register("link_edges", f"""WITH {LINKS_SQL}
SELECT page_id AS src_page, link AS link_raw, resolved AS link_url, url AS referrer, 1 AS depth
FROM rl WHERE resolved IS NOT NULL AND {Q.well_formed('resolved')}""")
def q_link_edges(spark, sf):
    from ..operators.graph import link_edges
    p = _parsed(spark, sf).withColumn("depth", F.lit(0))
    return link_edges(p).select(F.col("page_id").alias("src_page"), "link_raw", "link_url", "referrer", "depth")


SEEDS_SQL = f"""
seeds AS (SELECT page_id, CASE WHEN page_id % 10 = 7 THEN ''
                  WHEN page_id % 3 = 1 THEN regexp_replace(url, '^https?://', '')
                  WHEN page_id % 3 = 2 THEN '$(site)' || {Q.doc_key('url')}
                  ELSE url END AS raw FROM pages)"""


@register("seed_urls", f"""WITH {SEEDS_SQL},
s AS (SELECT page_id, raw, replace(raw, '$(site)', 'www.example.com') AS v FROM seeds),
s2 AS (SELECT page_id, raw, CASE WHEN starts_with(v, 'http://') OR starts_with(v, 'https://') THEN v ELSE 'http://' || v END AS v FROM s)
SELECT page_id, v AS seed FROM s2 WHERE raw <> '' AND {Q.well_formed('v')}""")
def q_seed_urls(spark, sf):
    from ..operators.graph import seed_urls
    return seed_urls(_seed_raw(spark, sf), {"site": "www.example.com"}).select("page_id", "seed")


def _seed_raw(spark, sf):
    p = S.read_pages(spark, sf).select("page_id", "url")
    pid = F.col("page_id")
    raw = (F.when(pid % 10 == 7, F.lit("")).when(pid % 3 == 1, F.regexp_replace("url", "^https?://", ""))
           .when(pid % 3 == 2, F.concat(F.lit("$(site)"), U.doc_key("url"))).otherwise(F.col("url")))
    return p.select("page_id", raw.alias("raw"))


@register("same_site", f"""WITH {LINKS_SQL},
sh AS (SELECT DISTINCT {Q.host('url')} AS host FROM pages)
SELECT page_id, resolved FROM rl WHERE {Q.host('resolved')} IN (SELECT host FROM sh)""")
def q_same_site(spark, sf):
    from ..operators.graph import same_site
    r = _resolved_links(spark, sf)
    seeds = S.read_pages(spark, sf).select(F.col("url").alias("seed"))
    return same_site(r, "resolved", seeds, "seed").select("page_id", "resolved")


@register("robots_txt_allowed", f"""WITH rr AS (
  SELECT DISTINCT regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host, '/es/' AS prefix, false AS allow FROM pages
  UNION ALL
  SELECT DISTINCT regexp_extract(url, '^[a-z]+://([^/]+)', 1), '/es/9', true FROM pages),
u AS (SELECT page_id, url, {Q.host('url')} AS host, regexp_extract(url, {Q.lit(P.URL_PATH)}, 1) AS path FROM pages),
m AS (SELECT u.page_id, r.allow, length(r.prefix) AS plen FROM u JOIN rr r ON r.host = u.host AND starts_with(u.path, r.prefix))
SELECT u.page_id, coalesce((SELECT arg_max(m.allow, m.plen * 2 + CAST(m.allow AS INTEGER)) FROM m WHERE m.page_id = u.page_id), true) AS allowed
FROM u""")
def q_robots_txt_allowed(spark, sf):
    from ..operators.graph import robots_allowed
    u = S.read_pages(spark, sf).select("page_id", "url")
    return robots_allowed(u, "url", S.robots_rules(spark, sf)).select("page_id", "allowed")


# ---------------------------------------------------------------- 2.7 index and search

DOCS_Q = "SELECT doc_id, text, lang, source FROM documents"


def _doc_index_docs(spark, sf):
    return documents_as_index(S.table(spark, sf, "documents", "doc_id", "text", "lang", "source"))


@register("analyze_text", f"""SELECT doc_id, CAST(i - 1 AS INTEGER) AS token_no, toks[i] AS token
FROM (SELECT doc_id, toks, generate_subscripts(toks, 1) AS i FROM (SELECT doc_id, {Q.tokens('text')} AS toks FROM documents))""")
def q_analyze_text(spark, sf):
    d = S.table(spark, sf, "documents", "doc_id", "text")
    return d.select("doc_id", F.posexplode(TX.analyze_text("text")).alias("token_no", "token")).select(
        "doc_id", F.col("token_no").cast("int"), "token")


@register("build_postings", f"WITH {Q.documents_index_ctes()} SELECT field, term, path, tf, round(norm, 6) AS norm FROM post")
def q_build_postings(spark, sf):
    p = build_postings(_doc_index_docs(spark, sf))
    return p.select("field", "term", "path", "tf", F.round("norm", 6).alias("norm"))


@register("index_stats", f"WITH {Q.documents_index_ctes()} SELECT field, term, df FROM tdf")
def q_index_stats(spark, sf):
    return term_stats(build_postings(_doc_index_docs(spark, sf)))


@register("field_lengths", f"WITH {Q.documents_index_ctes()} SELECT field, path, CAST(n AS INTEGER) AS n_terms FROM ft")
def q_field_lengths(spark, sf):
    return field_lengths(_doc_index_docs(spark, sf))


@register("split_query", f"WITH {Q.clause_ctes(Q.BENCH_QUERIES)} SELECT query_id, word_no, word FROM words")
def q_split_query(spark, sf):
    return SR.split_query(flows.benchmark_queries(spark, sf))


_ESC_CLASS = "".join("\\" + c for c in P.QUERY_SYNTAX_CHARS)


@register("escape_term", f"""WITH {Q.clause_ctes(Q.BENCH_QUERIES)}
SELECT query_id, word_no, lower(regexp_replace(word, {Q.lit('([' + _ESC_CLASS + '])')}, '\\\\\\1', 'g')) AS term FROM words""")
def q_escape_term(spark, sf):
    w = SR.split_query(flows.benchmark_queries(spark, sf))
    return w.select("query_id", "word_no", TX.escape_term("word").alias("term"))


@register("full_text_clauses", f"""WITH {Q.clause_ctes(Q.BENCH_QUERIES)}
SELECT query_id, word_no, field, term, min_sim, round(boost, 6) AS boost, n_clauses FROM cl""")
def q_full_text_clauses(spark, sf):
    c = SR.full_text_clauses(flows.benchmark_queries(spark, sf))
    return c.select("query_id", "word_no", "field", "term", "min_sim", F.round("boost", 6).alias("boost"), "n_clauses")


@register("word_clauses", f"""WITH {Q.clause_ctes(Q.BENCH_QUERIES)}
SELECT query_id, word_no, field, term, round(boost, 6) AS boost FROM cl WHERE word_no > 0""")
def q_word_clauses(spark, sf):
    c = SR.full_text_clauses(flows.benchmark_queries(spark, sf)).filter(F.col("word_no") > 0)
    return c.select("query_id", "word_no", "field", "term", F.round("boost", 6).alias("boost"))


def _doc_index(spark, sf):
    return flows.document_index(spark, sf)


@register("term_match", f"""WITH {Q.documents_index_ctes()}, {Q.clause_ctes(Q.BENCH_QUERIES)}
SELECT DISTINCT c.field, c.term, t.df FROM cl c JOIN tdf t ON t.field = c.field AND t.term = c.term""")
def q_term_match(spark, sf):
    idx = _doc_index(spark, sf)
    c = SR.full_text_clauses(flows.benchmark_queries(spark, sf)).select("field", "term").distinct()
    return c.join(idx.term_df, ["field", "term"]).select("field", "term", "df")


@register("fuzzy_match", f"""WITH {Q.documents_index_ctes()}, {Q.clause_ctes(Q.BENCH_QUERIES)}, {Q.expansion_ctes()}
SELECT field, term, min_sim, vterm, df, round(weight, 6) AS weight FROM exp""")
def q_fuzzy_match(spark, sf):
    idx = _doc_index(spark, sf)
    c = SR.full_text_clauses(flows.benchmark_queries(spark, sf))
    e = SR.expand_terms(c, idx.term_df)
    return e.select("field", "term", "min_sim", "vterm", "df", F.round("weight", 6).alias("weight"))


def _hits(spark, sf, opts=None):
    return SR.hits_for(flows.benchmark_queries(spark, sf), _doc_index(spark, sf), opts)


@register("boolean_match", f"{Q.search_ctes(Q.BENCH_QUERIES)} SELECT DISTINCT query_id, path FROM m")
def q_boolean_match(spark, sf):
    return _hits(spark, sf).select("query_id", "path")


@register("score_hits", f"{Q.search_ctes(Q.BENCH_QUERIES)} SELECT query_id, path, round(score, 6) AS score FROM sc")
def q_score_hits(spark, sf):
    return _hits(spark, sf).select("query_id", "path", F.round("score", 6).alias("score"))


@register("total_hits", f"""{Q.search_ctes(Q.BENCH_QUERIES)}
SELECT b.item_id AS query_id, CAST(coalesce(t.total, 0) AS BIGINT) AS total
FROM benchmark b LEFT JOIN (SELECT query_id, count(*) AS total FROM sc GROUP BY query_id) t ON t.query_id = b.item_id""")
def q_total_hits(spark, sf):
    qs = flows.benchmark_queries(spark, sf)
    return SR.total_hits(qs, _hits(spark, sf))


RANKED_SQL = """, rk AS (SELECT query_id, path, score,
       CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, path) - 1 AS BIGINT) AS position,
       count(*) OVER (PARTITION BY query_id) AS total FROM sc)"""


@register("page_hits", f"""{Q.search_ctes(Q.BENCH_QUERIES)}{RANKED_SQL}
SELECT query_id, position, path FROM rk WHERE position >= 5 AND position < 10""")
def q_page_hits(spark, sf):
    return SR.rank_hits(_hits(spark, sf), 5, 5).select("query_id", "position", "path")


@register("page_hits_from", f"""{Q.search_ctes(Q.BENCH_QUERIES)}{RANKED_SQL}
SELECT query_id, position, path FROM rk WHERE position >= 5""")
def q_page_hits_from(spark, sf):
    return SR.rank_hits(_hits(spark, sf), 5, None).select("query_id", "position", "path")


SEARCH_RESULT_SQL = f"""{Q.search_ctes(Q.BENCH_QUERIES)}{RANKED_SQL}
SELECT rk.query_id, rk.position, rk.path, dx.title, '' AS description, round(rk.score, 6) AS relevance,
       CAST(rk.total AS BIGINT) AS total
FROM rk JOIN dx ON dx.path = rk.path WHERE rk.position < 10"""


@register("search_many", SEARCH_RESULT_SQL)
def q_search_many(spark, sf):
    return SR.search_many(flows.benchmark_queries(spark, sf), _doc_index(spark, sf), SR.SearchOptions(start=0, count=10))


@register("result_rows", SEARCH_RESULT_SQL)
def q_result_rows(spark, sf):
    return q_search_many(spark, sf)


@register("sort_hits", f"""{Q.search_ctes(Q.BENCH_QUERIES)},
rs AS (SELECT sc.query_id, sc.path, dx.title,
       CAST(row_number() OVER (PARTITION BY sc.query_id ORDER BY dx.title, sc.path) - 1 AS BIGINT) AS position
       FROM sc JOIN dx ON dx.path = sc.path)
SELECT query_id, position, path, title FROM rs WHERE position < 10""")
def q_sort_hits(spark, sf):
    idx = _doc_index(spark, sf)
    h = SR.hits_for(flows.benchmark_queries(spark, sf), idx).join(idx.result_table.select("path", "title"), "path")
    return SR.rank_hits(h, 0, 10, sort=[F.col("title").asc(), F.col("path").asc()]).select(
        "query_id", "position", "path", "title")


EMPTY_Q = ("SELECT item_id AS query_id, CASE WHEN item_id % 4 = 1 THEN '' WHEN item_id % 4 = 2 THEN NULL "
           "ELSE text END AS q FROM benchmark")


def _with_empty(spark, sf):
    b = flows.benchmark_queries(spark, sf)
    qid = F.col("query_id")
    return b.select("query_id", F.when(qid % 4 == 1, F.lit("")).when(qid % 4 == 2, F.lit(None).cast("string"))
                    .otherwise(F.col("q")).alias("q"))


@register("empty_query", f"""{Q.search_ctes(EMPTY_Q)}
SELECT b.item_id AS query_id, CAST(coalesce(t.total, 0) AS BIGINT) AS total
FROM benchmark b LEFT JOIN (SELECT query_id, count(*) AS total FROM sc GROUP BY query_id) t ON t.query_id = b.item_id""")
def q_empty_query(spark, sf):
    qs = _with_empty(spark, sf)
    return SR.total_hits(qs, SR.hits_for(qs, _doc_index(spark, sf)))


@register("filter_language", f"""{Q.search_ctes(Q.BENCH_QUERIES)},
f AS (SELECT sc.* FROM sc JOIN dx ON dx.path = sc.path WHERE lower(dx.language) IN ('de', 'fr'))
SELECT query_id, path, round(score, 6) AS score FROM f""")
def q_filter_language(spark, sf):
    h = _hits(spark, sf, SR.SearchOptions(languages=["DE", "fr"]))
    return h.select("query_id", "path", F.round("score", 6).alias("score"))


@register("match_all", f"""WITH {Q.documents_index_ctes()},
f AS (SELECT path, title FROM dx WHERE lower(language) IN ('es'))
SELECT CAST(0 AS BIGINT) AS query_id, CAST(row_number() OVER (ORDER BY path) - 1 AS BIGINT) AS position, path, title,
       CAST(count(*) OVER () AS BIGINT) AS total FROM f""")
def q_match_all(spark, sf):
    r = SR.match_all(_doc_index(spark, sf), SR.SearchOptions(languages=["es"]))
    return r.select("query_id", "position", "path", "title", "total")


@register("intro_words", f"""SELECT doc_id,
  CASE WHEN len(w) > 12 THEN array_to_string(w[1:12], ' ') || ' ...' ELSE array_to_string(w, ' ') END AS intro
FROM (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), {Q.lit(P.WS_RUN)}), lambda x: x <> '') AS w FROM documents)""")
def q_intro_words(spark, sf):
    d = S.table(spark, sf, "documents", "doc_id", "text")
    return d.select("doc_id", TX.intro_words("text", 12).alias("intro"))
