"""Timings of the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line. Each query is run warm (one untimed run first), then
timed as the median of 3 runs. The search timing reads a built index (index
once, query many), as a search service does.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from sitesift.operators.graph import crawl_reach  # noqa: E402
from sitesift.operators.index import build_postings  # noqa: E402
from sitesift.operators.page import documents_as_index, parse_pages  # noqa: E402
from sitesift.operators.search import SearchOptions, search_many  # noqa: E402
from sitesift.plans import flows  # noqa: E402
from sitesift.plans.catalog_crawl import _upserted  # noqa: E402
from sitesift.session import get_session  # noqa: E402
from sitesift.sources import tables as S  # noqa: E402


def _sink(df):
    """Run the whole plan: a no-op write touches every row and column."""
    df.write.format("noop").mode("overwrite").save()


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = get_session(master=f"local[{cpus}]")

    idx = flows.document_index(spark, sf, checkpoint=True)
    queries = flows.benchmark_queries(spark, sf)

    def q_extract_text():
        _sink(parse_pages(S.read_pages(spark, sf)).select("page_id", "title", "text", "links"))

    def q_build_postings():
        docs = documents_as_index(S.table(spark, sf, "documents", "doc_id", "text", "lang", "source"))
        _sink(build_postings(docs))

    def q_search_many():
        _sink(search_many(queries, idx, SearchOptions(start=0, count=10)))

    def q_upsert_docs():
        _sink(_upserted(spark, sf))

    def q_crawl_reach():
        seeds = S.read_pages(spark, sf).filter(F.col("page_id") == 0).select(F.col("page_id").alias("node"))
        _sink(crawl_reach(seeds, S.edges(spark, sf)))

    plan = {
        "extract_text": q_extract_text,
        "build_postings": q_build_postings,
        "search_many": q_search_many,
        "upsert_docs": q_upsert_docs,
        "crawl_reach": q_crawl_reach,
    }
    out = {}
    for name, fn in plan.items():
        fn()  # warm
        ts = []
        for _ in range(reps):
            t0 = time.perf_counter()
            fn()
            ts.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(ts), 3)
    total = round(sum(out.values()), 3)
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": total, "unit": "sec", "queries": out,
                      "sf": os.path.basename(sf.rstrip("/")).replace("sf", ""), "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
