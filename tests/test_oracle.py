"""Registered queries against their DuckDB SQL on sf0.001 (same check as the driver's)."""

import os

import pytest

SF = "/root/testdata/sf0.001"
FAST = ["extract_title", "extract_text", "extract_links", "extract_metas", "doc_key", "url_identity",
        "resolve_link", "seed_urls", "robots_txt_allowed", "build_postings", "full_text_clauses",
        "route_status", "upsert_docs", "publish_or_rollback", "hidden_flag", "item_path", "crawl_reach",
        "nofollow_links", "search_many", "filter_section", "publish_rollback_503", "abort_cut_503", "stream_index",
        "special_fields", "missing_items"]


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("pages", "documents", "benchmark", "events", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.skipif(not os.path.exists(SF), reason="test data missing")
@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    from tools.check_oracle import digest

    sdf = E.queries()[name](spark, SF)
    rel = duck.sql(E.oracle_sql()[name])
    s = digest(sdf.columns, [tuple(r) for r in sdf.collect()])
    d = digest(rel.columns, rel.fetchall())
    assert s[:3] == d[:3]


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() == 400  # ten hits for each of 40 queries
    assert "relevance" in df.columns
