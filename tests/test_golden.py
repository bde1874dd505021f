"""Hand-derived golden rows (FIXTURES.md §3) for the scalar operators."""

from pyspark.sql import functions as F

from sitesift.functions import html as H
from sitesift.functions import text as TX
from sitesift.functions import urls as U
from sitesift.operators import route as R
from sitesift.operators import search as SR
from sitesift.operators.docs import publish_or_rollback, upsert_docs
from sitesift.operators.index import build_index
from sitesift.operators.page import parse_pages


def one(spark, col, *values, schema="x string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(col).collect()]


def test_seed_urls(spark):
    got = one(spark, U.seed_url(F.col("x"), {"site": "www.h.com"}), "$(site)/a", "https://h.com", "")
    assert got == ["http://www.h.com/a", "https://h.com", None]


def test_doc_key_and_fragment(spark):
    assert one(spark, U.doc_key(F.col("x")), "http://h.com", "http://h.com/a?b=1#c") == ["/", "/a?b=1"]
    assert one(spark, U.strip_fragment(F.col("x")), "u#a#b", "u", None) == ["u", "u", None]


def test_exclude_urls(spark):
    assert one(spark, U.exclude_urls(F.col("x")), "/x.json", "/x.JPG", "/x.html") == [False, True, True]


def test_resolve_link(spark):
    df = spark.createDataFrame([
        ("http://h.com/a/b/c", "../d"), ("http://h.com/a/b", "?k=v"), ("http://h.com/a", "//o.com/z"),
        ("http://h.com/a/b", "../../../z"), ("http://h.com/a/b/", "./x/./y/../z"), ("http://h.com", "q"),
        ("http://h.com/a", ""), ("http://h.com/a/b", "#f"), ("http://h.com/a/b", "mailto:x@y"),
    ], "b string, l string")
    got = [r[0] for r in df.select(U.resolve_link("b", "l")).collect()]
    from urllib.parse import urljoin
    want = [urljoin(b, l) if l else None for b, l in df.collect()]
    assert got == want


def test_decode_entities(spark):
    got = one(spark, U.decode_entities(F.col("x")), "a&amp;b", "&#233;t&#xE9;", "&amp;lt;", "&lt;p&gt;")
    assert got == ["a&b", "été", "&lt;", "<p>"]


def test_strip_regions_and_text(spark):
    r = H.RegionRule("<!--B-->", "<!--E-->")
    assert one(spark, H.strip_regions(F.col("x"), [r]), "a<!--B-->x<!--E-->b", "a<!--B-->x") == ["ab", "a<!--B-->x"]
    page = ("<b>you can index me</b>\n<!--BEGIN-NOINDEX-->\nbut not me!\n<!--END-NOINDEX-->\n"
            "<i>and here is fine also</i>")
    df = spark.createDataFrame([(1, "http://h.com/", page)], "page_id long, url string, html string")
    text = parse_pages(df, index_rules=[H.NOINDEX_RULE]).first()["text"]
    assert text == "you can index me and here is fine also"


def test_nofollow_links(spark):
    page = ('<b>you can index me</b><a href="follow.aspx">follow me</a>\n<!--BEGIN-NOFOLLOW-->\n'
            '<a href="follownot.aspx">but not me!</a>\n<!--END-NOFOLLOW-->\n'
            '<a href="follownot" rel="nofollow">me neither</a>')
    df = spark.createDataFrame([(1, "http://h.com/", page)], "page_id long, url string, html string")
    links = parse_pages(df, follow_rules=[H.NOFOLLOW_RULE, *H.NOFOLLOW_PRESET]).first()["links"]
    assert links == ["follow.aspx"]


def test_title_and_metas(spark):
    df = spark.createDataFrame([(1, "http://h.com/a", "<title>A</title><title> B</title>"
                                 "<meta name='Robots' content='NOINDEX, follow'><meta name=x content=''>")],
                               "page_id long, url string, html string")
    p = parse_pages(df).first()
    assert p["title"] == "A; B"
    assert [(m["name"], m["content"]) for m in p["metas"]] == [("Robots", "NOINDEX, follow")]
    assert p["noindex_reason"] == "encountered meta tag Robots='NOINDEX, follow'"


def test_meta_noindex_and_canonical(spark):
    rows = [(1, "http://h.com/a", '<meta name="robots" content="none">'),
            (2, "http://h.com/a", '<meta name="internal-index" content="noindex">'),
            (3, "http://h.com/a", '<link rel="canonical" href="http://h.com/A">'),
            (4, "http://h.com/a", '<link rel="canonical" href="http://h.com/b">'),
            (5, "http://h.com/a", '<link rel="canonical">'),
            (6, "http://h.com/a", "<p>x</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    p = {r["page_id"]: (r["noindex_reason"], r["canonical_reason"]) for r in parse_pages(df).collect()}
    assert p[1] == (None, None)
    assert p[2][0] is not None
    assert p[3][1] is None
    assert p[4][1] is not None and p[5][1] is not None
    assert p[6] == (None, None)


def test_route_status(spark):
    df = spark.createDataFrame([(200, 1), (404, 0), (503, 3), (500, 0), (500, 2)], "status int, depth int")
    got = [r[0] for r in df.select(R.route_status(F.col("status"), F.col("depth"), F.lit(None).cast("string"))).collect()]
    assert got == ["INDEXED", "NOT_FOUND", "ABORT", "ABORT", "ERROR"]


def test_upsert_and_publish(spark):
    old = spark.createDataFrame([("/k", "t0"), ("/o", "t1")], "path string, title string")
    log = spark.createDataFrame([("/k", "t2", 1, "INDEXED"), ("/k", "t3", 2, "NOT_FOUND")],
                                "path string, title string, seq long, outcome string")
    new = upsert_docs(old, log)
    assert sorted(r["path"] for r in new.collect()) == ["/o"]
    aborted = spark.createDataFrame([(1, "ABORT")], "seq long, outcome string")
    kept = publish_or_rollback(old, new.select("path", "title"), aborted)
    assert sorted(r["path"] for r in kept.collect()) == ["/k", "/o"]


def test_fuzzy_similarity(spark):
    df = spark.createDataFrame([("kitten", "sitten", 0.7), ("für", "fur", 0.5)], "a string, b string, m double")
    d = F.levenshtein("a", "b")
    got = df.select(SR.fuzzy_similarity_ok(d, F.length("a"), F.length("b"), F.col("m"))).collect()
    assert [r[0] for r in got] == [True, True]


def test_clauses_red_car(spark):
    q = spark.createDataFrame([(1, "red car")], "query_id long, q string")
    c = SR.full_text_clauses(q).collect()
    assert len(c) == 9
    whole = sorted(round(r["boost"], 6) for r in c if r["word_no"] == 0)
    assert whole == [1.7, 1.8, 2.2]
    words = sorted(round(r["boost"], 6) for r in c if r["word_no"] > 0)
    assert words == [1.0, 1.0, 1.1, 1.1, 1.5, 1.5]


def test_short_id_and_intro(spark):
    assert one(spark, TX.short_id(F.col("x")), "{ab-1}") == ["AB1"]
    assert one(spark, TX.intro_words(F.col("x"), 2), "a b c", "a b") == ["a b ...", "a b"]


def test_search_paging_and_empty(spark):
    docs = spark.createDataFrame(
        [(f"/d{i}", [f"word{i % 3} common"], f"t{i}", [""], 1.0) for i in range(12)],
        "path string, content array<string>, title string, description array<string>, boost double")
    docs = docs.withColumn("name", F.array("title"))
    idx = build_index(docs)
    qs = spark.createDataFrame([(1, "common"), (2, ""), (3, None)], "query_id long, q string")
    allh = SR.search_many(qs, idx, SR.SearchOptions())
    assert allh.filter("query_id = 1").count() == 12
    assert allh.filter("query_id <> 1").count() == 0
    page = SR.search_many(qs, idx, SR.SearchOptions(start=5, count=5)).orderBy("position").collect()
    assert [r["position"] for r in page] == [5, 6, 7, 8, 9] and all(r["total"] == 12 for r in page)
    rest = SR.search_many(qs, idx, SR.SearchOptions(start=5)).collect()
    assert sorted(r["position"] for r in rest) == list(range(5, 12))
    totals = {r["query_id"]: r["total"] for r in SR.total_hits(qs, SR.hits_for(qs, idx)).collect()}
    assert totals == {1: 12, 2: 0, 3: 0}
