"""Page → field expressions. All are JVM-side Column expressions.

HTML is read by regular expressions in two steps (tag, then attribute), after
script, style and comment blocks are removed, so a `"</p>"` inside a script or a
link inside a comment does not leak into text or links.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trim_ws(c) -> Column:
    """Trim all white space (not just blanks) at both ends."""
    return F.regexp_replace(_c(c), P.EDGE_WS, "")


def unquote(c) -> Column:
    return F.regexp_replace(_c(c), P.QUOTES, "")


def html_gate(status, content_type) -> Column:
    """Parse only 200 responses whose type starts with text/html (any case)."""
    return (_c(status) == 200) & F.lower(F.coalesce(_c(content_type), F.lit(""))).startswith("text/html")


@dataclass(frozen=True)
class RegionRule:
    """A start/end marker pair; a region start..end is cut out, markers included.

    `start`/`end` are literal unless the matching `*_regex` flag is set. A rule
    needs both markers (SURVEY 2.11.4).
    """

    start: str
    end: str
    start_regex: bool = False
    end_regex: bool = False

    def pattern(self) -> str:
        s = self.start if self.start_regex else P.quote_literal(self.start)
        e = self.end if self.end_regex else P.quote_literal(self.end)
        return "(?s)" + s + ".*?" + e


# Sample-configuration rules (text: NOINDEX region; links:
# NOFOLLOW region, rel=nofollow anchors, robots-nofollow meta to end of page).
NOINDEX_RULE = RegionRule("<!--BEGIN-NOINDEX-->", "<!--END-NOINDEX-->")
NOFOLLOW_RULE = RegionRule("<!--BEGIN-NOFOLLOW-->", "<!--END-NOFOLLOW-->")
NOFOLLOW_PRESET = (
    RegionRule(P.NOFOLLOW_A_START, P.NOFOLLOW_A_END, True, False),
    RegionRule(P.NOFOLLOW_META_START, P.NOFOLLOW_META_END, True, False),
)


def strip_regions(html, rules: Sequence[RegionRule]) -> Column:
    """Remove every start..end region of each rule, rules in order."""
    out = _c(html)
    for r in rules:
        out = F.regexp_replace(out, r.pattern(), "")
    return out


def clean_html(html) -> Column:
    """Drop script, style and comment blocks."""
    return F.regexp_replace(_c(html), P.SCRIPT_STYLE_COMMENT, " ")


def extract_title(cleaned) -> Column:
    """Inner text of all <title> elements joined by ';', trimmed."""
    return trim_ws(F.array_join(F.regexp_extract_all(_c(cleaned), F.lit(P.TITLE), 1), ";"))


def extract_text(cleaned) -> Column:
    """Visible text: tags become blanks, white-space runs collapse, trimmed."""
    no_tags = F.regexp_replace(_c(cleaned), P.TAG, " ")
    return trim_ws(F.regexp_replace(no_tags, P.WS_RUN, " "))


def extract_metas(cleaned) -> Column:
    """array<struct<name,content>> of <meta> tags with non-empty name and content, page order."""
    tags = F.regexp_extract_all(_c(cleaned), F.lit(P.META_TAG), 0)
    pairs = F.transform(
        tags,
        lambda t: F.struct(
            unquote(F.regexp_extract(t, P.attr("name"), 1)).alias("name"),
            unquote(F.regexp_extract(t, P.attr("content"), 1)).alias("content"),
        ),
    )
    return F.filter(pairs, lambda m: (m["name"] != "") & (m["content"] != ""))


def extract_links(cleaned) -> Column:
    """Distinct union of a/link hrefs and src/background/lowsrc references, empties dropped."""
    links = F.transform(F.regexp_extract_all(_c(cleaned), F.lit(P.A_LINK_HREF), 1), unquote)
    refs = F.transform(F.regexp_extract_all(_c(cleaned), F.lit(P.REF_SRC), 1), unquote)
    return F.filter(F.array_union(links, refs), lambda x: x != "")


def link_tag_attr(cleaned, rel: str, attr_name: str = "href") -> Column:
    """`attr_name` of every <link> whose rel equals `rel` (any case), page order."""
    tags = F.regexp_extract_all(_c(cleaned), F.lit(P.LINK_TAG), 0)
    hit = F.filter(tags, lambda t: F.lower(unquote(F.regexp_extract(t, P.attr("rel"), 1))) == rel.lower())
    return F.transform(hit, lambda t: unquote(F.regexp_extract(t, P.attr(attr_name), 1)))


def head_base_hrefs(cleaned) -> Column:
    """href values of <base> tags inside <head>, page order."""
    head = F.regexp_extract(_c(cleaned), P.HEAD, 1)
    tags = F.regexp_extract_all(head, F.lit(P.BASE_TAG), 0)
    return F.transform(tags, lambda t: unquote(F.regexp_extract(t, P.attr("href"), 1)))


def metas_named(metas, *names: str) -> Column:
    """Metas whose name equals one of `names`, any case."""
    low = [n.lower() for n in names]
    return F.filter(_c(metas), lambda m: F.lower(m["name"]).isin(low))


def keywords_values(metas, compat: bool = False) -> Column:
    """Content of 'keywords' metas, to be added to Content."""
    v = F.transform(metas_named(metas, "keywords"), lambda m: m["content"])
    return v if compat else F.transform(v, trim_ws)


def description_values(metas, compat: bool = False) -> Column:
    """Content of 'description' metas (for Content and Description)."""
    v = F.transform(metas_named(metas, "description"), lambda m: m["content"])
    return v if compat else F.transform(v, trim_ws)


EXTRA_PREFIX = "efcrawler:extrafield:"


def extra_fields(metas) -> Column:
    """C11: map field → values from <meta name="efcrawler:extrafield:F" content=v>.

    The field name is what follows the prefix (kept as written); a meta named
    the bare prefix (no field) is ignored.
    """
    ex = F.filter(
        _c(metas),
        lambda m: F.lower(m["name"]).startswith(EXTRA_PREFIX) & (F.length(m["name"]) > len(EXTRA_PREFIX)),
    )
    kv = F.transform(ex, lambda m: F.struct(F.substring(m["name"], F.lit(len(EXTRA_PREFIX) + 1), F.length(m["name"])).alias("k"),
                                            m["content"].alias("v")))
    keys = F.array_distinct(F.transform(kv, lambda e: e["k"]))
    return F.map_from_arrays(
        keys, F.transform(keys, lambda k: F.transform(F.filter(kv, lambda e: e["k"] == k), lambda e: e["v"]))
    )


def noindex_hits(metas) -> Column:
    """robots/internal-index metas whose content contains 'noindex' (any case)."""
    return F.filter(
        _c(metas),
        lambda m: F.lower(m["name"]).isin("robots", "internal-index") & F.lower(m["content"]).contains("noindex"),
    )


def noindex_reason_from(hits) -> Column:
    first = F.get(_c(hits), 0)
    return F.when(F.size(_c(hits)) > 0, F.format_string("encountered meta tag %s='%s'", first["name"], first["content"]))


def canonical_hrefs(cleaned) -> Column:
    """hrefs ('' when absent) of <link rel="canonical"> tags, page order."""
    tags = F.regexp_extract_all(_c(cleaned), F.lit(P.LINK_TAG), 0)
    canon = F.filter(tags, lambda t: unquote(F.regexp_extract(t, P.attr("rel"), 1)) == "canonical")
    return F.transform(canon, lambda t: unquote(F.regexp_extract(t, P.attr("href"), 1)))


def canonical_reason_from(hrefs, doc_key) -> Column:
    href = F.get(_c(hrefs), 0)
    return F.when((F.size(_c(hrefs)) > 0) & ~F.lower(href).contains(F.lower(_c(doc_key))),
                  F.format_string("encountered canonical tag to '%s'", href))
