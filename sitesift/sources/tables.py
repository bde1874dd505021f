"""Sources: the given Parquet tables and the tables Spark derives
from them. Every reader selects only the columns it needs so the scan's
ReadSchema stays narrow; filters placed after it are pushed into the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FETCH_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("step_uri", T.StringType()),
    T.StructField("response_uri", T.StringType()),
    T.StructField("depth", T.IntegerType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("fetched_at", T.TimestampNTZType()),
    T.StructField("download_seconds", T.DoubleType()),
])


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def read_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 (batch): fetched pages (page_id, url, html)."""
    return table(spark, sf_dir, "pages", "page_id", "url", "html")


def read_pages_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """A2 (stream): the same rows arriving as Parquet files in a folder."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def crawl_log(spark: SparkSession, sf_dir: str, abort_seq: int | None = None,
              depth0_error_seq: int | None = None) -> DataFrame:
    """One fetch per event: events drive which page was fetched, with which
    status, type, depth and time. `abort_seq` turns one fetch into a 503;
    `depth0_error_seq` turns one into a depth-0 500 (the abort cases)."""
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    n_pages = pages.agg(F.count(F.lit(1)).alias("n_pages")).scalar()  # scalar subquery
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    ev = ev.withColumn("pid", F.col("event_id") % n_pages)
    j = ev.join(pages, pages.page_id == ev.pid)
    status = (F.when((F.col("event_type") == "error") & (F.col("event_id") % 3 == 0), 500)
              .when(F.col("event_type") == "error", 404).otherwise(200))
    depth = (F.col("user_id") % 4).cast("int")
    if abort_seq is not None:
        status = F.when(F.col("event_id") == abort_seq, 503).otherwise(status)
    if depth0_error_seq is not None:
        status = F.when(F.col("event_id") == depth0_error_seq, 500).otherwise(status)
        depth = F.when(F.col("event_id") == depth0_error_seq, 0).otherwise(depth)
    return j.select(
        F.col("event_id").alias("seq"),
        F.col("page_id"),
        F.col("url").alias("step_uri"),
        F.when(F.col("event_id") % 13 == 0, F.regexp_replace("url", "^http://", "https://"))
        .cast("string").alias("response_uri"),
        depth.cast("int").alias("depth"),
        status.cast("int").alias("status"),
        F.when(F.col("event_id") % 11 == 0, F.lit("application/pdf"))
        .otherwise(F.lit("text/html; charset=utf-8")).alias("content_type"),
        F.col("ts").alias("fetched_at"),
        F.col("value").alias("download_seconds"),
    )


def pages_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`pages` with head tags added: robots/internal-index noindex, canonical
    links, description, keywords and an extra-field meta (FIXTURES 2)."""
    p = read_pages(spark, sf_dir)
    pid = F.col("page_id")
    add = F.concat(
        F.when(pid % 7 == 0, F.lit('<meta name="Robots" content="NOINDEX, follow">'))
        .when(pid % 11 == 0, F.lit('<meta name="internal-index" content="noindex">')).otherwise(F.lit("")),
        F.when(pid % 5 == 0, F.lit('<link rel="canonical" href="http://other.example.com/x">'))
        .when(pid % 5 == 1, F.concat(F.lit('<link rel="canonical" href="'), F.col("url"), F.lit('">')))
        .otherwise(F.lit("")),
        F.when(pid % 3 == 0, F.concat(F.lit('<meta name="description" content="about page '),
                                      pid.cast("string"), F.lit('">'))).otherwise(F.lit("")),
        F.when(pid % 4 == 0, F.lit('<meta name="keywords" content="alpha,beta">')).otherwise(F.lit("")),
        F.when(pid % 6 == 0, F.lit('<meta name="efcrawler:extrafield:shelf" content="s1">')).otherwise(F.lit("")),
        F.lit("</head>"),
    )
    return p.select("page_id", "url", F.replace(F.col("html"), F.lit("</head>"), add).alias("html"))


def _guid(prefix: str, n: Column) -> Column:
    h = F.upper(F.md5(F.concat(F.lit(prefix), n.cast("string"))))
    return F.concat(F.lit("{"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"),
                    F.substring(h, 13, 4), F.lit("-"), F.substring(h, 17, 4), F.lit("-"),
                    F.substring(h, 21, 12), F.lit("}"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CMS item tree over `part`: parent = key/3, a hidden flag, ids, language,
    version, template, names, statistics."""
    p = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    k = F.col("p_partkey")
    return p.select(
        k.alias("item_no"),
        F.when(k < 3, F.lit(None)).otherwise(F.floor(k / 3)).cast("bigint").alias("parent_no"),
        (k % 97 == 0).alias("hidden"),
        _guid("item", k).alias("item_id"),
        F.when(k % 10 == 9, F.lit("web")).otherwise(F.lit("master")).alias("database"),
        F.when(k % 3 == 0, F.lit("en")).when(k % 3 == 1, F.lit("de")).otherwise(F.lit("fr-FR")).alias("language"),
        ((k % 4) + 1).cast("int").alias("version"),
        (k % 12).cast("bigint").alias("template_no"),
        (k % 5).cast("int").alias("n_versions"),
        F.col("p_name").alias("name"),
        F.concat(F.col("p_brand"), F.lit(" "), F.col("p_name")).alias("display_name"),
        F.concat(F.lit("icons/"), F.lower(F.regexp_replace("p_type", " ", "_")), F.lit(".png")).alias("icon"),
        F.concat(F.lit("cms\\user"), (k % 7).cast("string")).alias("created_by"),
        F.concat(F.lit("cms\\user"), (k % 5).cast("string")).alias("updated_by"),
        F.concat(F.lit("2024"), F.lpad(((k % 12) + 1).cast("string"), 2, "0"), F.lit("01T000000")).alias("created"),
        F.concat(F.lit("2025"), F.lpad(((k % 12) + 1).cast("string"), 2, "0"), F.lit("15T120000")).alias("updated"),
        F.col("p_type").alias("template_name"),
    )


def templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Template ids (template_no → GUID text); 12 templates."""
    t = spark.range(12).select(F.col("id").alias("template_no"))
    return t.select("template_no", _guid("template", F.col("template_no")).alias("template_id"))


def template_bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Direct base templates: template t has bases (t+1)%12 and (t+5)%12, t<6 only."""
    t = spark.range(6).select(F.col("id").alias("template_no"))
    return (t.select("template_no", F.lit(1).alias("ord"), ((F.col("template_no") + 1) % 12).alias("base_no"))
            .unionByName(t.select("template_no", F.lit(2).alias("ord"), ((F.col("template_no") + 5) % 12).alias("base_no")))
            .select("template_no", F.col("ord").cast("int"), F.col("base_no").cast("bigint")))


def item_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item → item links: each item links to key*2 and key+7 when that item exists."""
    p = table(spark, sf_dir, "part", "p_partkey")
    mx = p.agg(F.max("p_partkey").alias("mx")).scalar()  # scalar subquery
    k = F.col("p_partkey")
    l = p.select(
        k.alias("item_no"),
        F.array(F.struct(F.lit(1).alias("ord"), (k * 2).alias("target_no")),
                F.struct(F.lit(2).alias("ord"), (k + 7).alias("target_no"))).alias("t"), mx.alias("mx"))
    l = l.select("item_no", "mx", F.inline("t"))
    return l.filter(F.col("target_no") <= F.col("mx")).select(
        "item_no", F.col("ord").cast("int"), F.col("target_no").cast("bigint"))


def page_item_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages carrying a item header: item URI of item page_id+1 for
    most pages, a missing item for page_id % 17 == 5, none for page_id % 9 == 4."""
    p = table(spark, sf_dir, "pages", "page_id")
    pid = F.col("page_id")
    uri = F.when(pid % 9 == 4, F.lit(None).cast("string")).when(
        pid % 17 == 5, F.concat(F.lit("item://master/"), _guid("missing", pid))
    ).otherwise(F.concat(F.lit("item://master/"), _guid("item", pid + 1)))
    return p.select("page_id", uri.alias("item_uri"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link graph over page ids: src → (3*src + j) % n for j in 1, 2, 5."""
    p = table(spark, sf_dir, "pages", "page_id")
    n = p.agg(F.count(F.lit(1)).alias("n")).scalar()  # scalar subquery
    e = p.select("page_id", F.explode(F.array(F.lit(1), F.lit(2), F.lit(5))).alias("j"))
    return e.select(F.col("page_id").alias("src"), ((F.col("page_id") * 3 + F.col("j")) % n).alias("dst"))


def robots_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per host: disallow '/es/', allow '/es/9' (longest prefix decides)."""
    p = table(spark, sf_dir, "pages", "url")
    host = F.regexp_extract("url", r"^[a-z]+://([^/]+)", 1)
    h = p.select(host.alias("host")).distinct()
    return (h.select("host", F.lit("/es/").alias("prefix"), F.lit(False).alias("allow"))
            .unionByName(h.select("host", F.lit("/es/9").alias("prefix"), F.lit(True).alias("allow"))))
