"""End-to-end flows that compose the operators over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import doc_key
from ..operators.index import SearchIndex, build_index
from ..operators.page import build_document, documents_as_index, parse_pages
from ..operators.search import SearchOptions, search_many
from ..sources import tables as S


def page_documents(spark: SparkSession, sf_dir: str, tags: str = "crawled", boost: float = 1.0) -> DataFrame:
    """pages → parsed → index documents (one per distinct key, last page id wins)."""
    pages = S.read_pages(spark, sf_dir)
    last = pages.groupBy(doc_key("url")).agg(F.max("page_id").alias("page_id")).select("page_id")
    return build_document(parse_pages(pages.join(last, "page_id", "left_semi")), tags=tags, boost=boost)


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The `benchmark` table as a table of queries: (query_id, q) = (item_id, text)."""
    return S.table(spark, sf_dir, "benchmark", "item_id", "text").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("q"))


def page_index(spark: SparkSession, sf_dir: str, checkpoint: bool = True) -> SearchIndex:
    return build_index(page_documents(spark, sf_dir), checkpoint=checkpoint)


def document_index(spark: SparkSession, sf_dir: str, checkpoint: bool = True) -> SearchIndex:
    docs = documents_as_index(S.table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))
    return build_index(docs, checkpoint=checkpoint)


def search_documents(spark: SparkSession, sf_dir: str, opts: SearchOptions | None = None) -> DataFrame:
    idx = document_index(spark, sf_dir)
    return search_many(benchmark_queries(spark, sf_dir), idx, opts or SearchOptions(start=0, count=10))
