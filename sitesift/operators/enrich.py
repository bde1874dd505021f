"""CMS item enrichment: item joins, identifiers, template and link
strings, hidden flag and ancestor path over the item tree."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import short_id
from ..session import stored
from .route import ITEM_MISSING
from .sizing import fits_broadcast


def item_uri(items: DataFrame) -> DataFrame:
    return items.withColumn("item_uri", F.concat(F.lit("item://"), F.col("database"), F.lit("/"), F.col("item_id")))


def join_items(pages: DataFrame, items: DataFrame, header: str = "item_uri") -> DataFrame:
    """Pages with a non-empty item header pick up their item (left join);
    pages without one are kept as they are."""
    it = item_uri(items).withColumnRenamed("item_uri", "_iu")
    named = F.coalesce(F.col(header) != "", F.lit(False))
    joined = pages.filter(named).join(it, F.col(header) == F.col("_iu"), "left").drop("_iu")
    return joined.unionByName(pages.filter(~named), allowMissingColumns=True)  # most pages name no item: they are not shuffled


def missing_items(pages: DataFrame, items: DataFrame, header: str = "item_uri") -> DataFrame:
    """Pages whose header names an item that does not exist: outcome
    ITEM_MISSING with a message (they are not indexed)."""
    it = item_uri(items).select(F.col("item_uri").alias("_iu"))
    hp = pages.filter(F.col(header).isNotNull() & (F.col(header) != ""))
    miss = hp.join(it, hp[header] == it["_iu"], "left_anti")
    return miss.withColumn("outcome", F.lit(ITEM_MISSING)).withColumn(
        "reason", F.format_string("Item not found: %s", F.col(header)))


def version_fields(df: DataFrame, templates: DataFrame, extra_columns: Mapping[str, Column] | None = None) -> DataFrame:
    """Database, composite id (short id + language + '%' + version),
    language, template short id, url (item URI). `extra_columns` adds columns or
    takes the place of these."""
    t = templates.select("template_no", short_id(F.col("template_id")).alias("template"))
    t = F.broadcast(t) if fits_broadcast(t) else t
    out = df.join(t, "template_no", "left")
    out = out.withColumn("db", F.col("database")).withColumn(
        "full_id", F.concat(short_id(F.col("item_id")), F.col("language"), F.lit("%"), F.col("version").cast("string")))
    return out.withColumns(dict(extra_columns or {}))


def special_fields(df: DataFrame, extra_columns: Mapping[str, Column] | None = None) -> DataFrame:
    """Item name and display name (`names`, to be added to the document's
    names), icon, creator, editor and template name of items. `extra_columns` adds
    columns or takes the place of these."""
    return df.withColumns({"item_name": F.col("name"), "names": F.array("name", "display_name"),
                           "creator": F.col("created_by"), "editor": F.col("updated_by")}).withColumns(dict(extra_columns or {}))


def all_templates(items: DataFrame, templates: DataFrame, bases: DataFrame) -> DataFrame:
    """(item_no, all_templates): own template then its direct bases in
    order, each followed by a blank. Templates and bases are few (bounded by
    the template count) and join by broadcast after a size check."""
    tid = templates.select("template_no", short_id(F.col("template_id")).alias("sid"))
    b = bases.join(tid.withColumnRenamed("template_no", "base_no"), "base_no") \
        .groupBy("template_no").agg(F.array_sort(F.collect_list(F.struct("ord", "sid"))).alias("bs"))
    per_t = tid.join(b, "template_no", "left").select(
        "template_no",
        F.concat(F.col("sid"), F.lit(" "),
                 F.array_join(F.transform(F.coalesce(F.col("bs"), F.array().cast("array<struct<ord:int,sid:string>>")),
                                          lambda x: F.concat(x["sid"], F.lit(" "))), "")).alias("all_templates"))
    per_t = F.broadcast(per_t) if fits_broadcast(per_t) else per_t
    return items.select("item_no", "template_no").join(per_t, "template_no", "left").select("item_no", "all_templates")


def item_links(links: DataFrame, items: DataFrame) -> DataFrame:
    """(item_no, item_links): ' ' + target short id for each link, in order."""
    tgt = items.select(F.col("item_no").alias("target_no"), short_id(F.col("item_id")).alias("sid"))
    j = links.join(tgt, "target_no")
    g = j.groupBy("item_no").agg(F.array_sort(F.collect_list(F.struct("ord", "target_no", "sid"))).alias("ls"))
    return g.select("item_no", F.array_join(F.transform("ls", lambda x: F.concat(F.lit(" "), x["sid"])), "").alias("item_links"))


def ancestors(items: DataFrame, with_chain: bool = True) -> DataFrame:
    """(item_no, hidden_any, chain) by pointer doubling.

    chain lists the item's id and all its ancestors' ids, item first;
    hidden_any is true when the item or any ancestor is hidden. Each round
    joins the open rows (those whose pointer names a further ancestor) to the
    row their pointer names and doubles the distance covered, so depth d takes
    log2(d) rounds; finished rows are set aside. Rounds are stored as Parquet (a checkpoint
    hands on size estimates whose digits double with each join), joins are merge joins (chains
    take far more memory than their files). Open rows left when the distance exceeds the
    number of items stand on or below a cycle, which is an error. An item whose
    parent does not exist ends its own chain. Without `with_chain` no chains
    are built.
    """
    chain = F.array(F.upper(F.regexp_replace("item_id", "[{}-]", ""))) if with_chain else F.lit(None).cast("array<string>")
    rows = stored(items.select("item_no", F.col("parent_no").alias("ptr"), F.coalesce(F.col("hidden"), F.lit(False)).alias("hid"),
                               chain.alias("chain")))
    done, open_rows = rows.filter(F.col("ptr").isNull()), rows.filter(F.col("ptr").isNotNull())
    n, reach = rows.count(), 1
    while not open_rows.isEmpty():
        if reach > n:
            raise ValueError(f"items in a cycle of parents, or below one: {[r[0] for r in open_rows.select('item_no').take(5)]}")
        t = done.unionByName(open_rows).select(F.col("item_no").alias("t_no"), F.col("ptr").alias("t_ptr"), F.col("hid").alias("t_hid"),
                                               F.col("chain").alias("t_chain"))
        rows = stored(open_rows.join(t.hint("merge"), F.col("ptr") == F.col("t_no"), "left").select(
            "item_no", F.col("t_ptr").alias("ptr"), (F.col("hid") | F.coalesce(F.col("t_hid"), F.lit(False))).alias("hid"),
            F.when(F.col("t_chain").isNull(), F.col("chain")).otherwise(F.concat("chain", "t_chain")).alias("chain"),
        ))
        done, open_rows = done.unionByName(rows.filter(F.col("ptr").isNull())), rows.filter(F.col("ptr").isNotNull())
        reach *= 2
    return done.select("item_no", F.col("hid").alias("hidden_any"), "chain")


def hidden_flag(items: DataFrame) -> DataFrame:
    """(item_no, hidden) — hidden if the item or an ancestor is."""
    return ancestors(items, with_chain=False).select("item_no", F.col("hidden_any").alias("hidden"))


def item_path(items: DataFrame) -> DataFrame:
    """(item_no, item_path): ' ' + id for each ancestor, root first, ids
    without braces and dashes."""
    a = ancestors(items)
    return a.select("item_no", F.array_join(F.transform(F.reverse("chain"), lambda x: F.concat(F.lit(" "), x)), "")
                    .alias("item_path"))


def attach_item(results: DataFrame, items: DataFrame, url_col: str = "url", only_visible_db: str | None = None) -> DataFrame:
    """Result rows get their item back when the stored url is an item
    URI; with `only_visible_db`, only an item with at least one version in that
    database."""
    it = item_uri(items)
    if only_visible_db is not None:
        it = it.filter((F.col("n_versions") > 0) & (F.col("database") == only_visible_db))
    it = it.select(F.col("item_uri").alias("_iu"), F.col("item_no").alias("item_no"))
    return results.join(it, results[url_col] == it["_iu"], "left").drop("_iu")
