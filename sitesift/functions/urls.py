"""URL and link expressions. JVM-side Column expressions only."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def effective_url(response_uri, step_uri) -> Column:
    """B1: the response URI when present, else the requested one."""
    return F.coalesce(_c(response_uri), _c(step_uri))


def strip_fragment(url) -> Column:
    """Cut at the first '#'; null passes through."""
    return F.substring_index(_c(url), "#", 1)


def doc_key(url) -> Column:
    """B2: path + query, no host, no fragment; '/' for a bare host."""
    pq = F.regexp_extract(_c(url), P.URL_PATH_QUERY, 1)
    return F.when(pq == "", F.lit("/")).otherwise(pq)


def url_host(url) -> Column:
    return F.lower(F.regexp_extract(_c(url), P.URL_HOST, 1))


def url_origin(url) -> Column:
    return F.regexp_extract(_c(url), P.URL_ORIGIN, 1)


def url_path_query(url) -> Column:
    """Path and query of an absolute URL, '/' for an empty path."""
    pq = F.regexp_extract(_c(url), P.URL_PATH_QUERY, 1)
    return F.when(pq.startswith("/"), pq).otherwise(F.concat(F.lit("/"), pq))


def url_path(url) -> Column:
    return F.regexp_extract(_c(url), P.URL_PATH, 1)


def url_identity(url, sensitive: Iterable[str] = ("userinfo",)) -> Column:
    """Seen-set key. Fragment cut; URL parts named in `sensitive`
    (scheme, userinfo, host, rest) keep their case, the others are lower-cased."""
    u = strip_fragment(url)
    sens = set(sensitive)

    def part(name, pattern):
        v = F.regexp_extract(u, pattern, 1)
        return v if name in sens else F.lower(v)

    scheme = part("scheme", P.URL_SCHEME)
    userinfo = part("userinfo", P.URL_USERINFO)
    host = part("host", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)")
    rest = part("rest", P.URL_AFTER_AUTHORITY)
    return F.when(u.rlike(P.URL_SCHEME), F.concat(scheme, F.lit("://"), userinfo, host, rest)).otherwise(F.lower(u))


def is_well_formed(url) -> Column:
    """Absolute URL that parses; malformed ones are dropped, never fatal."""
    return F.coalesce(_c(url).rlike(P.WELL_FORMED_URL) & ~_c(url).rlike(P.BAD_PERCENT), F.lit(False))


def exclude_urls(url, pattern: str = P.DEFAULT_EXCLUDE) -> Column:
    """True for URLs to keep: those the exclusion regex does not find (case-sensitive)."""
    return ~_c(url).rlike(pattern)


def depth_marker(depth) -> Column:
    """B12: '-' repeated depth times."""
    return F.repeat(F.lit("-"), _c(depth))


def decode_entities(s) -> Column:
    """Decode numeric references, then the named set, '&amp;' last."""
    refs = F.array_distinct(F.regexp_extract_all(_c(s), F.lit(P.NUM_ENTITY), 0))

    def decode_ref(ref):
        body = F.regexp_extract(ref, r"^&#([xX]?)([0-9a-fA-F]+);$", 2)
        is_hex = F.regexp_extract(ref, r"^&#([xX]?)", 1) != ""
        digits = F.regexp_replace(body, "^0+", "")  # leading zeros do not count; more than 7 digits is no code point
        code = F.when(F.length(digits) <= 7, F.when(is_hex, F.conv(digits, 16, 10).cast("bigint")).otherwise(
            F.when(digits.rlike("^[0-9]+$"), digits).cast("bigint")))
        return F.when(code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF),
                      F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(ref)

    out = F.aggregate(refs, _c(s), lambda acc, r: F.replace(acc, r, decode_ref(r)))
    for name, ch in P.NAMED_ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(ch))
    return out


def first_base(cleaned_html) -> Column:
    """First non-empty well-formed <head><base href>, null without one."""
    from .html import head_base_hrefs

    return F.get(F.filter(head_base_hrefs(cleaned_html), lambda h: (h != "") & h.rlike(r"^[^ \t\n\r\f<>\"]+$")), 0)


def base_or_url(base, response_url) -> Column:
    """The base that a page names, else the response URL without query and fragment."""
    return F.coalesce(_c(base), F.regexp_replace(_c(response_url), r"[?#].*$", ""))


def base_url(cleaned_html, response_url) -> Column:
    """First non-empty well-formed <head><base href>, else the response URL
    without query and fragment."""
    return base_or_url(first_base(cleaned_html), response_url)


def _remove_dots(path: Column, collapse_empty: bool) -> Column:
    """RFC 3986 5.2.4 on a path that starts with '/'."""
    segs = F.split(path, "/")
    n = F.size(segs)
    inner = F.slice(segs, 2, F.greatest(n - 2, F.lit(0)))
    if collapse_empty:
        inner = F.filter(inner, lambda x: x != "")
    last = F.element_at(segs, -1)
    allsegs = F.when(n >= 2, F.concat(inner, F.array(last))).otherwise(F.array().cast("array<string>"))
    res = F.aggregate(
        allsegs,
        F.array().cast("array<string>"),
        lambda acc, x: F.when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(x == ".", acc)
        .otherwise(F.concat(acc, F.array(x))),
    )
    trail = F.when(last.isin(".", "..") & (F.size(res) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.lit("/"), F.array_join(res, "/"), trail)


def resolve_link(base, link) -> Column:
    """Resolve `link` against absolute `base` (RFC 3986 section 5, as
    Python's urljoin). Empty links give null."""
    b = _c(base)
    l = _c(link)
    b_nofrag = F.regexp_replace(b, "#.*$", "")
    b_noquery = F.regexp_replace(b, "[?#].*$", "")
    origin = url_origin(b)
    bpath = url_path(b)
    lpath = F.regexp_extract(l, r"^([^?#]*)", 1)
    lrest = F.regexp_extract(l, r"^[^?#]*(.*)$", 1)
    bdir = F.when(bpath == "", F.lit("/")).otherwise(F.regexp_replace(bpath, "[^/]*$", ""))
    return (
        F.when(l.isNull() | (l == ""), F.lit(None).cast("string"))
        .when(l.rlike(P.ABS_URL), l)
        .when(l.startswith("//"), F.concat(F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1), l))
        .when(l.startswith("#"), F.concat(b_nofrag, l))
        .when(l.startswith("?"), F.concat(b_noquery, l))
        .when(l.startswith("/"), F.concat(origin, _remove_dots(lpath, False), lrest))
        .otherwise(F.concat(origin, _remove_dots(F.concat(bdir, lpath), True), lrest))
    )


def substitute_vars(s, variables: Mapping[str, str]) -> Column:
    """Replace each $(name) by its value, in the order given."""
    out = _c(s)
    for k, v in variables.items():
        out = F.replace(out, F.lit("$(" + k + ")"), F.lit(v))
    return out


def seed_url(raw, variables: Mapping[str, str] | None = None) -> Column:
    """A1: one seed: null for empty; variables substituted; 'http://' prefixed
    unless it starts with http:// or https:// (case-sensitive); null when not a
    well-formed URL."""
    s = substitute_vars(raw, variables or {})
    s = F.when(s.startswith("http://") | s.startswith("https://"), s).otherwise(F.concat(F.lit("http://"), s))
    return F.when((_c(raw) != "") & is_well_formed(s), s)
