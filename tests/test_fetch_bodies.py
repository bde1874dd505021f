"""Pages are parsed once, before they meet the log of their fetches."""

import pytest

from sitesift.operators import route as R
from sitesift.operators.page import parse_bodies

LOG = "seq long, page_id long, step_uri string, response_uri string, depth int, status int, content_type string"


def test_bodies_read_beforehand_give_the_same_rows(spark):
    head = '<meta name="robots" content="noindex"><link rel="canonical" href="http://h/a"><base href="http://b/">'
    pages = spark.createDataFrame([(1, f"<html><head><title>T</title>{head}</head><a href='x'>y</a></html>"), (2, None), (3, "<p>text</p>"),
                                   (4, '<link rel="canonical" href="http://h/other">')], "page_id long, html string")
    log = [(n, n % 6, f"http://h/{'ab'[n % 2]}?q#f", "http://h/c" if n % 5 == 0 else None, n % 3, (200, 200, 404, None)[n % 4], ("text/html", None, "text/html")[n % 3])
           for n in range(48)]
    log = spark.createDataFrame(log, LOG)
    at_each_fetch = R.outcomes(R.parse_fetches(R.fetch_pages(log, pages)))
    before = R.outcomes(R.parse_fetches(R.fetch_pages(log, parse_bodies(pages))))
    assert before.columns == at_each_fetch.columns
    assert sorted(map(str, before.collect())) == sorted(map(str, at_each_fetch.collect()))
    with pytest.raises(ValueError, match="rules"):
        R.parse_fetches(R.fetch_pages(log, parse_bodies(pages)), index_rules=["x"])


@pytest.mark.parametrize("name", ["skip_reason", "custom_skip", "canonical_mismatch", "doc_boost"])
def test_a_page_is_parsed_once_not_for_each_fetch(spark, name):
    import __spark_entry__ as E

    fetches = E.queries()[name](spark, "/root/testdata/sf0.001")
    plan = fetches._jdf.queryExecution().optimizedPlan().toString()
    assert "<script" not in plan.split("Join LeftOuter")[0] and "<script" in plan
