"""Long URLs, character references, robots queries, persistent index, must-not search, stream replays."""

import pytest
from pyspark.sql import functions as F

from sitesift.functions import urls as U
from sitesift.operators import docs as DO
from sitesift.operators import enrich as EN
from sitesift.operators import search as SR
from sitesift.operators.graph import robots_allowed
from sitesift.operators.index import build_index, read_index, write_index
from sitesift.operators.page import documents_as_index
from sitesift.streaming import stream as ST


def test_long_urls_are_tested_not_fatal(spark):
    long = "http://h.example/" + "a/" * 50_000
    rows = [(1, long), (2, long + "%zz"), (3, long + "%4"), (4, long + "%41?q"), (5, "http://h.example/a b"), (6, None), (7, "http://h:80?x%20y")]
    got = {r["i"]: r["ok"] for r in spark.createDataFrame(rows, "i int, u string").select("i", U.is_well_formed("u").alias("ok")).collect()}
    assert got == {1: True, 2: False, 3: False, 4: True, 5: False, 6: False, 7: True}


def test_character_references(spark):
    texts = ["&#128512; &#x1F600;", "&#00000000065;", "&#1114112; &#xD800;", "&#99999999999999999999;", "&amp;lt;"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(U.decode_entities("t")).collect()]
    assert got == ["😀 😀", "A", "&#1114112; &#xD800;", "&#99999999999999999999;", "&lt;"]


def test_robots_rules_match_the_query(spark):
    urls = spark.createDataFrame([("http://h/a?x=1",), ("http://h/a?y",), ("http://h",), ("http://g/a?x",), (None,), ("http://h/a?x=1",)], "url string")
    rules = spark.createDataFrame([("h", "/a?x", False), ("h", "/", True)], "host string, prefix string, allow boolean")
    got = sorted((str(r["url"]), r["allowed"]) for r in robots_allowed(urls, "url", rules).collect())
    assert got == [("None", True), ("http://g/a?x", True), ("http://h", True), ("http://h/a?x=1", False), ("http://h/a?x=1", False), ("http://h/a?y", True)]


def test_head_is_not_header(spark):
    html = "<html><header><base href='http://wrong/'></header><head lang=x><base href='http://right/'></head>"
    assert spark.createDataFrame([(html,)], "h string").select(U.base_url("h", F.lit("http://page/"))).first()[0] == "http://right/"


def _docs(spark):
    rows = [(i, t, "en", "s") for i, t in enumerate(["apple pie", "apple tart", "banana bread", "apple banana"])]
    return documents_as_index(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))


def test_written_index_is_searched(spark, tmp_path):
    queries = spark.createDataFrame([(1, "apple"), (2, "banana bread")], "query_id long, q string")
    index = build_index(_docs(spark), checkpoint=True)
    write_index(index, str(tmp_path))
    a, b = (sorted(map(tuple, SR.search_many(queries, i).collect())) for i in (index, read_index(spark, str(tmp_path))))
    assert a == b and len(a) > 4


def test_sort_by_a_document_column(spark):
    queries = spark.createDataFrame([(1, "apple")], "query_id long, q string")
    rows = SR.search_many(queries, build_index(_docs(spark), checkpoint=True), SR.SearchOptions(sort=[F.col("title").desc()])).collect()
    assert [r["title"] for r in sorted(rows, key=lambda r: r["position"])] == ["apple tart", "apple pie", "apple banana"]


def test_hits_are_computed_once(spark):
    queries = spark.createDataFrame([(1, "apple")], "query_id long, q string")
    plan = SR.search_many(queries, build_index(_docs(spark), checkpoint=True), SR.SearchOptions(start=0, count=2))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "tf" not in text and "levenshtein" not in text  # only the checkpointed hits and the result table are read


def test_special_fields_run(spark):
    items = spark.createDataFrame([(1, "n", "d", "i.png", "u1", "u2", "t")], "item_no int, name string, display_name string, icon string, created_by string, updated_by string, template_name string")
    r = EN.special_fields(items).first()
    assert (r["item_name"], r["names"], r["creator"], r["editor"]) == ("n", ["n", "d"], "u1", "u2")


def test_latest_fetch_has_one_row_per_key(spark):
    log = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "y"), ("b", 5, "z"), ("c", None, "w")], "doc_key string, seq long, v string")
    assert sorted(map(tuple, DO.latest_fetch(log).select("doc_key", "seq", "v").collect())) == [("a", 2, "y"), ("b", 5, "z")]


def _batch(spark, *rows):
    return spark.createDataFrame(rows, "doc_key string, seq long, outcome string, title string")


def test_repeated_batch_gives_the_same_table(spark, tmp_path):
    root = str(tmp_path / "t")
    read = lambda: sorted(map(tuple, ST.read_current(spark, root).select("doc_key", "seq", "outcome", "title").collect()))
    ST.merge_batch(_batch(spark, ("a", 1, "INDEXED", "t1"), ("b", 2, "INDEXED", "t2")), 0, root)
    second = _batch(spark, ("a", 5, "NOT_FOUND", None), ("c", 4, "INDEXED", "t3"))
    ST.merge_batch(second, 1, root)
    once = read()
    ST.merge_batch(second, 1, root)  # the batch failed after its marks and comes again
    assert read() == once == [("a", 5, "NOT_FOUND", None), ("b", 2, "INDEXED", "t2"), ("c", 4, "INDEXED", "t3")]
    ST.merge_batch(_batch(spark, ("a", 3, "INDEXED", "late")), 2, root)  # an older fetch does not come back
    assert read() == once


def test_unreadable_table_is_an_error(spark, tmp_path):
    root = str(tmp_path / "t")
    ST.merge_batch(_batch(spark, ("a", 1, "INDEXED", "t1")), 0, root)
    for f in (tmp_path / "t" / "_versions" / "batch=000000000").glob("*.parquet"):
        f.write_bytes(b"broken")
    with pytest.raises(Exception):  # noqa: B017
        ST.merge_batch(_batch(spark, ("b", 2, "INDEXED", "t2")), 1, root)


def test_new_checkpoint_on_an_old_table_is_refused(spark, tmp_path):
    root = str(tmp_path / "t")
    ST.merge_batch(_batch(spark, ("a", 1, "INDEXED", "t1")), 0, root)
    with pytest.raises(ValueError):
        ST._check_start(spark, root, str(tmp_path / "new-checkpoint"))


def test_cluster_without_a_shared_folder_is_refused():
    from sitesift.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *_):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def _tree(spark, *edges):
    return spark.createDataFrame([(i, p, False, f"{{id-{i}}}") for i, p in edges], "item_no long, parent_no long, hidden boolean, item_id string")


def test_ancestors_of_a_deep_tree(spark):
    deep = [(0, None), *[(i, i - 1) for i in range(1, 70)], (100, 999)]
    got = {r["item_no"]: r["chain"] for r in EN.ancestors(_tree(spark, *deep)).collect()}
    assert got[69] == [f"ID{i}" for i in range(69, -1, -1)] and got[0] == ["ID0"] and got[100] == ["ID100"]


def test_cycle_of_parents_is_reported(spark):
    with pytest.raises(ValueError, match="cycle"):
        EN.ancestors(_tree(spark, (1, 2), (2, 1), (3, None))).collect()
