"""Fetched pages → parsed fields → index documents.

`parse_pages` is one narrow stage: the region-stripped and cleaned HTML is
computed once per row in one projection and every field reads it, so each
regular expression runs once per page. `html` is not carried past it. Where a
page is fetched many times, `parse_bodies` reads it once, before it meets the log.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import urls as U
from ..functions.html import RegionRule


def parse_bodies(df: DataFrame, html: str = "html", index_rules: Sequence[RegionRule] = (), follow_rules: Sequence[RegionRule] = (),
                 gate: Column | None = None, keep: Sequence[str] | None = None, compat: bool = False) -> DataFrame:
    """What a page's body says, whatever its URL: the columns of `BODY` in place of ``html``. Rows that fail ``gate``
    are not read and get empty fields; arguments as in `parse_pages`."""
    keep = list(keep) if keep is not None else [c for c in df.columns if c != html]
    ok = gate if gate is not None else F.lit(True)
    raw = F.when(ok, F.coalesce(F.col(html), F.lit("")))
    text_html = H.strip_regions(raw, index_rules)
    link_html = H.strip_regions(raw, follow_rules)
    skip_html = link_html if (compat and (index_rules or follow_rules)) else raw
    stage1 = df.select(
        *keep,
        H.clean_html(text_html).alias("_th"),
        H.clean_html(link_html).alias("_lh"),
        H.clean_html(skip_html).alias("_sh"),
    )
    # Intermediate arrays get their own projection so each is computed once.
    stage2 = stage1.select(
        *keep, "_th", "_lh",
        H.extract_metas("_th").alias("_metas"),
        H.noindex_hits(H.extract_metas("_sh")).alias("_ni"),
        H.canonical_hrefs("_sh").alias("_canon"),
    )
    return stage2.select(
        *keep,
        H.extract_title("_th").alias("_title"),
        "_metas",
        H.extract_text("_th").alias("_text"),
        H.extract_links("_lh").alias("_links"),
        U.first_base("_lh").alias("_base"),
        H.noindex_reason_from("_ni").alias("_noindex"),
        "_canon",
    )


#: Columns of `parse_bodies`.
BODY = ("_title", "_metas", "_text", "_links", "_base", "_noindex", "_canon")


def parse_pages(
    df: DataFrame,
    html: str = "html",
    url: str = "url",
    index_rules: Sequence[RegionRule] = (),
    follow_rules: Sequence[RegionRule] = (),
    gate: Column | None = None,
    keep: Sequence[str] | None = None,
    compat: bool = False,
) -> DataFrame:
    """Parse pages into doc_key, title, metas, text, links (raw), base_url.

    `gate` (C1) is a boolean column; rows failing it keep empty fields (they are
    still indexed, with empty text). Text fields come from the page with index
    regions removed (C2), links from the original page with follow regions
    removed (C3). Skip tests (D2, D3) read the original page, or with
    `compat=True` the follow-stripped one, as the reference does (quirk Q3).

    Rows that have the columns of `parse_bodies` in place of `html` are not parsed again.
    """
    keep = list(keep) if keep is not None else [c for c in df.columns if c != html and c not in BODY]
    ok = gate if gate is not None else F.lit(True)
    own = [*keep, F.col(url).alias("_url"), U.doc_key(F.col(url)).alias("_key"), ok.alias("_parsed")]
    if html in df.columns:
        bodies = df.select(*own, F.col(html).alias("_html"))
        bodies = parse_bodies(bodies, "_html", index_rules, follow_rules, F.col("_parsed"), compat=compat)
    elif index_rules or follow_rules:
        raise ValueError("rules hold where bodies are parsed")
    else:
        bodies = df.select(*own, *BODY)
    read = lambda c: F.when(F.col("_parsed"), F.col(c))
    return bodies.select(
        *keep,
        F.col("_key").alias("doc_key"),
        F.col("_parsed").alias("parsed"),
        F.coalesce(read("_title"), F.lit("")).alias("title"),
        F.coalesce(read("_metas"), F.array().cast("array<struct<name:string,content:string>>")).alias("metas"),
        F.coalesce(read("_text"), F.lit("")).alias("text"),
        F.coalesce(read("_links"), F.array().cast("array<string>")).alias("links"),
        F.when(F.col("_parsed"), U.base_or_url("_base", "_url")).alias("base_url"),
        read("_noindex").alias("noindex_reason"),
        F.when(F.col("_parsed"), H.canonical_reason_from("_canon", "_key")).alias("canonical_reason"),
    )


def build_document(
    parsed: DataFrame,
    tags: str = "",
    boost: float = 1.0,
    run_id: str = "",
    depth: Column | None = None,
    compat: bool = False,
    extra_columns: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Assemble the index document of each parsed page.

    content = [text, title, keywords..., descriptions...]; description =
    descriptions or [''] when none; name = [title]; extra = extra-field metas;
    constant tags, boost and run id; doc_group = path.
    """
    kw = H.keywords_values("metas", compat)
    desc = H.description_values("metas", compat)
    cols = [
        F.col("doc_key").alias("path"),
        F.array(F.col("title")).alias("name"),
        F.col("title"),
        F.concat(F.array(F.col("text"), F.col("title")), kw, desc).alias("content"),
        F.when(F.size(desc) == 0, F.array(F.lit(""))).otherwise(desc).alias("description"),
        H.extra_fields("metas").alias("extra"),
        F.lit(tags).alias("tags"),
        F.col("doc_key").alias("doc_group"),
        (depth if depth is not None else F.lit(0)).cast("int").alias("depth"),
        F.lit(run_id).alias("run_id"),
        F.lit(float(boost)).alias("boost"),
    ]
    for name, c in (extra_columns or {}).items():
        cols.append(c.alias(name))
    passthrough = [c for c in ("page_id", "seq", "url", "item_uri", "outcome") if c in parsed.columns]
    return parsed.select(*passthrough, *cols)


def documents_as_index(docs: DataFrame, boost: float = 1.0, run_id: str = "") -> DataFrame:
    """The `documents` table as index documents: path '/doc/<id>', title = first
    line of the text, content = [text, title], language = lang, tags = source."""
    title = H.trim_ws(F.substring_index(F.coalesce(F.col("text"), F.lit("")), "\n", 1))
    passthrough = [c for c in ("seq", "outcome") if c in docs.columns]
    return docs.select(
        *passthrough,
        F.concat(F.lit("/doc/"), F.col("doc_id").cast("string")).alias("path"),
        F.array(title).alias("name"),
        title.alias("title"),
        F.array(F.coalesce(F.col("text"), F.lit("")), title).alias("content"),
        F.array(F.lit("")).alias("description"),
        F.create_map().cast("map<string,array<string>>").alias("extra"),
        F.coalesce(F.col("source"), F.lit("")).alias("tags"),
        F.concat(F.lit("/doc/"), F.col("doc_id").cast("string")).alias("doc_group"),
        F.lit(0).alias("depth"),
        F.lit(run_id).alias("run_id"),
        F.lit(float(boost)).alias("boost"),
        F.col("lang").alias("language"),
    )
