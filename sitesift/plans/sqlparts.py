"""DuckDB SQL fragments of the oracle, built from the same patterns the Spark
expressions use (functions/patterns.py), so both engines run one definition."""

from __future__ import annotations

from ..functions import patterns as P


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def trim_ws(x: str) -> str:
    return f"regexp_replace({x}, {lit(P.EDGE_WS)}, '', 'g')"


def unquote(x: str) -> str:
    return f"regexp_replace({x}, {lit(P.QUOTES)}, '', 'g')"


def clean(x: str) -> str:
    return f"regexp_replace({x}, {lit(P.SCRIPT_STYLE_COMMENT)}, ' ', 'g')"


def title(c: str) -> str:
    return trim_ws(f"array_to_string(regexp_extract_all({c}, {lit(P.TITLE)}, 1), ';')")


def text(c: str) -> str:
    return trim_ws(f"regexp_replace(regexp_replace({c}, {lit(P.TAG)}, ' ', 'g'), {lit(P.WS_RUN)}, ' ', 'g')")


def attr(tag: str, name: str) -> str:
    return unquote(f"regexp_extract({tag}, {lit(P.attr(name))}, 1)")


def metas(c: str) -> str:
    """list of struct(name, content), non-empty both, page order."""
    return (f"list_filter(list_transform(regexp_extract_all({c}, {lit(P.META_TAG)}, 0), "
            f"lambda t: {{'name': {attr('t', 'name')}, 'content': {attr('t', 'content')}}}), "
            f"lambda m: m.name <> '' AND m.content <> '')")


def links(c: str) -> str:
    a = f"list_transform(regexp_extract_all({c}, {lit(P.A_LINK_HREF)}, 1), lambda x: {unquote('x')})"
    r = f"list_transform(regexp_extract_all({c}, {lit(P.REF_SRC)}, 1), lambda x: {unquote('x')})"
    return f"list_filter(list_concat({a}, {r}), lambda x: x <> '')"


def tokens(x: str) -> str:
    return f"regexp_extract_all(lower(coalesce({x}, '')), {lit(P.TOKEN)}, 0)"


def doc_key(u: str) -> str:
    pq = f"regexp_extract({u}, {lit(P.URL_PATH_QUERY)}, 1)"
    return f"(CASE WHEN {pq} = '' THEN '/' ELSE {pq} END)"


def strip_fragment(u: str) -> str:
    return f"split_part({u}, '#', 1)"


def host(u: str) -> str:
    return f"lower(regexp_extract({u}, {lit(P.URL_HOST)}, 1))"


def well_formed(u: str) -> str:
    return f"coalesce(regexp_matches({u}, {lit(P.WELL_FORMED_URL)}) AND NOT regexp_matches({u}, {lit(P.BAD_PERCENT)}), false)"


def base_url(c: str, url: str) -> str:
    head = f"regexp_extract({c}, {lit(P.HEAD)}, 1)"
    hrefs = (f"list_filter(list_transform(regexp_extract_all({head}, {lit(P.BASE_TAG)}, 0), lambda t: {attr('t', 'href')}), "
             f"lambda h: h <> '' AND regexp_matches(h, {lit(r'^[^ \t\n\r\f<>\"]+$')}))")
    return f"coalesce({hrefs}[1], regexp_replace({url}, '[?#].*$', ''))"


def remove_dots(path: str, collapse: bool) -> str:
    segs = f"string_split({path}, '/')"
    inner = f"{segs}[2:len({segs})-1]"
    if collapse:
        inner = f"list_filter({inner}, lambda x: x <> '')"
    last = f"{segs}[len({segs})]"
    allsegs = f"(CASE WHEN len({segs}) >= 2 THEN list_append({inner}, {last}) ELSE []::VARCHAR[] END)"
    res = (f"list_reduce({allsegs}, lambda acc, x: CASE WHEN x = '..' THEN acc[1:len(acc)-1] "
           f"WHEN x = '.' THEN acc ELSE list_append(acc, x) END, []::VARCHAR[])")
    return (f"('/' || array_to_string({res}, '/') || "
            f"CASE WHEN {last} IN ('.', '..') AND len({res}) > 0 THEN '/' ELSE '' END)")


def resolve(b: str, l: str) -> str:
    origin = f"regexp_extract({b}, {lit(P.URL_ORIGIN)}, 1)"
    bpath = f"regexp_extract({b}, {lit(P.URL_PATH)}, 1)"
    lpath = f"regexp_extract({l}, '^([^?#]*)', 1)"
    lrest = f"regexp_extract({l}, '^[^?#]*(.*)$', 1)"
    bdir = f"(CASE WHEN {bpath} = '' THEN '/' ELSE regexp_replace({bpath}, '[^/]*$', '') END)"
    return (
        f"(CASE WHEN {l} IS NULL OR {l} = '' THEN NULL "
        f"WHEN regexp_matches({l}, {lit(P.ABS_URL)}) THEN {l} "
        f"WHEN starts_with({l}, '//') THEN regexp_extract({b}, {lit('^([A-Za-z][A-Za-z0-9+.-]*:)')}, 1) || {l} "
        f"WHEN starts_with({l}, '#') THEN regexp_replace({b}, '#.*$', '') || {l} "
        f"WHEN starts_with({l}, '?') THEN regexp_replace({b}, '[?#].*$', '') || {l} "
        f"WHEN starts_with({l}, '/') THEN {origin} || {remove_dots(lpath, False)} || {lrest} "
        f"ELSE {origin} || {remove_dots(bdir + ' || ' + lpath, True)} || {lrest} END)"
    )


def parsed_pages(src: str = "pages") -> str:
    """CTE body: page_id, url, c (cleaned html), plus fields."""
    return (f"SELECT page_id, url, {clean('coalesce(html, ' + lit('') + ')')} AS c FROM {src}")


# ---- index over `documents` --------------------------------------------------

def documents_index_ctes() -> str:
    t = trim_ws("split_part(coalesce(text, ''), chr(10), 1)")
    return f"""
dx AS (
  SELECT '/doc/' || CAST(doc_id AS VARCHAR) AS path, {t} AS title, coalesce(text, '') AS body,
         lang AS language, coalesce(source, '') AS tags
  FROM documents),
ftok AS (
  SELECT path, 'content' AS field, list_concat({tokens('body')}, {tokens('title')}) AS toks FROM dx
  UNION ALL SELECT path, 'name', {tokens('title')} FROM dx
  UNION ALL SELECT path, 'tags', {tokens('tags')} FROM dx),
ft AS (SELECT path, field, toks, len(toks) AS n FROM ftok WHERE len(toks) > 0),
post AS (
  SELECT field, term, path, CAST(count(*) AS INTEGER) AS tf, any_value(1.0 / sqrt(n)) AS norm
  FROM (SELECT field, path, n, unnest(toks) AS term FROM ft) GROUP BY field, term, path),
tdf AS (SELECT field, term, count(*) AS df FROM post GROUP BY field, term),
nd AS (SELECT count(*) AS n_docs FROM dx)"""


def clause_ctes(queries_sql: str) -> str:
    """CTEs qs (query_id, q), words, cl (clauses). `queries_sql` yields (query_id, q)."""
    return f"""
qs AS (SELECT query_id, q FROM ({queries_sql}) WHERE q IS NOT NULL AND q <> ''),
wsplit AS (SELECT query_id, list_filter(string_split(q, ' '), lambda x: x <> '') AS w FROM qs WHERE contains(q, ' ')),
words AS (SELECT query_id, CAST(i AS INTEGER) AS word_no, w[i] AS word
          FROM (SELECT query_id, w, generate_subscripts(w, 1) AS i FROM wsplit)),
nw AS (SELECT query_id, count(*) AS nw FROM words GROUP BY query_id),
wall AS (
  SELECT query_id, 0 AS word_no, lower(q) AS term, CAST(0.5 AS DOUBLE) AS min_sim,
         CASE WHEN contains(q, ' ') THEN CAST(0.7 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS extra, true AS is_whole FROM qs
  UNION ALL SELECT query_id, word_no, lower(word), CAST(0.7 AS DOUBLE), CAST(0.0 AS DOUBLE), false FROM words),
fl AS (SELECT * FROM (VALUES ('content', CAST(1.0 AS DOUBLE), false), ('name', CAST(1.5 AS DOUBLE), true),
                             ('description', CAST(1.1 AS DOUBLE), false)) v(field, base_boost, is_title)),
cl AS (
  SELECT a.query_id, CAST(a.word_no AS INTEGER) AS word_no, f.field, a.term, a.min_sim,
         (CASE WHEN f.is_title AND a.is_whole THEN CAST(1.5 AS DOUBLE) ELSE f.base_boost END) + a.extra AS boost,
         CAST(1 + coalesce(nw.nw, 0) AS INTEGER) AS n_clauses
  FROM wall a CROSS JOIN fl f LEFT JOIN nw ON nw.query_id = a.query_id)"""


def expansion_ctes() -> str:
    """CTEs over cl and tdf: exp (field, term, min_sim, vterm, df, weight).

    DuckDB's levenshtein counts bytes; non-ASCII characters of both sides are
    first mapped one-to-one onto single-byte control characters."""
    return """
ct AS (SELECT DISTINCT field, term, min_sim FROM cl),
ct2 AS (SELECT *, length(term) AS L,
               (min_sim < 1.0 AND CAST(length(term) AS DOUBLE) > 1.0 / (1.0 - min_sim)) AS fuzzy FROM ct),
chars AS (SELECT DISTINCT ch FROM (
            SELECT unnest(string_split(term, '')) AS ch FROM ct
            UNION ALL SELECT unnest(string_split(term, '')) FROM tdf) WHERE unicode(ch) > 127),
codes AS (SELECT row_number() OVER (ORDER BY c) AS rn, c FROM (
            SELECT unnest([1,2,3,4,5,6,7,8,14,15,16,17,18,19,20,21,22,23,24,25,26,27,28,29,30,31,127]) AS c)),
cmap AS (SELECT coalesce(string_agg(ch, '' ORDER BY rn), '') AS src, coalesce(string_agg(chr(c), '' ORDER BY rn), '') AS dst
         FROM (SELECT ch, row_number() OVER (ORDER BY ch) AS rn FROM chars) JOIN codes USING (rn)),
ex AS (SELECT c.field, c.term, c.min_sim, t.term AS vterm, t.df, CAST(1.0 AS DOUBLE) AS weight
       FROM ct2 c JOIN tdf t ON t.field = c.field AND t.term = c.term WHERE NOT c.fuzzy),
fz AS (SELECT c.field, c.term, c.min_sim, t.term AS vterm, t.df, least(c.L, length(t.term)) AS mn,
              levenshtein(translate(c.term, m.src, m.dst), translate(t.term, m.src, m.dst)) AS d
       FROM ct2 c JOIN tdf t ON t.field = c.field CROSS JOIN cmap m
       WHERE c.fuzzy AND abs(length(t.term) - c.L) <= floor((1.0 - c.min_sim) * least(c.L, length(t.term)))),
fz2 AS (SELECT field, term, min_sim, vterm, df, ((1.0 - d / mn) - min_sim) / (1.0 - min_sim) AS weight
        FROM fz WHERE d <= floor((1.0 - min_sim) * mn)
          AND CAST(1.0 AS FLOAT) - CAST(d / mn AS FLOAT) > CAST(min_sim AS FLOAT)),
exp AS (SELECT * FROM ex UNION ALL SELECT * FROM fz2)"""


def scoring_ctes() -> str:
    """CTEs over cl, exp, post, nd: m (matches), sc (query_id, path, score)."""
    return """
ce AS (SELECT c.query_id, c.word_no, c.n_clauses, c.field, e.vterm, e.df, c.boost * e.weight AS qboost
       FROM cl c JOIN exp e ON c.field = e.field AND c.term = e.term AND c.min_sim = e.min_sim),
m AS (SELECT ce.query_id, ce.word_no, ce.n_clauses, ce.field, p.path,
             sqrt(p.tf) * (1.0 + ln(nd.n_docs / (ce.df + 1))) * (1.0 + ln(nd.n_docs / (ce.df + 1))) * ce.qboost * p.norm AS w
      FROM ce JOIN post p ON p.field = ce.field AND p.term = ce.vterm CROSS JOIN nd),
pf AS (SELECT query_id, path, word_no, field, sum(w) AS sf, any_value(n_clauses) AS n_clauses
       FROM m GROUP BY query_id, path, word_no, field),
pw AS (SELECT query_id, path, word_no, sum(sf) * count(*) / 3.0 AS ws, any_value(n_clauses) AS n_clauses
       FROM pf GROUP BY query_id, path, word_no),
sc AS (SELECT query_id, path, sum(ws) * count(*) / any_value(n_clauses) AS score FROM pw GROUP BY query_id, path)"""


def search_ctes(queries_sql: str) -> str:
    return "WITH " + ",".join([documents_index_ctes(), clause_ctes(queries_sql), expansion_ctes(), scoring_ctes()])


BENCH_QUERIES = "SELECT item_id AS query_id, text AS q FROM benchmark"
