"""Inverted index.

Documents are shuffled once, by path; tokens of every text field are produced
inside the document row, and term frequencies are a grouped count in the same
task, as all rows of a path are there. Postings, whose keys take several times the
space of the texts, are not shuffled. The field norm
(doc boost / sqrt(field length)) rides on each posting, so scoring needs no
join back to a per-document table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import analyze_text
from ..session import stored

# Text fields of an index document: (field name, column, is it an array).
BASE_FIELDS = (
    ("content", "content", True),
    ("name", "name", True),
    ("description", "description", True),
    ("tags", "tags", False),
)
ITEM_FIELDS = (
    ("template", "template", False),
    ("creator", "creator", False),
    ("editor", "editor", False),
    ("all_templates", "all_templates", False),
    ("template_name", "template_name", False),
    ("item_path", "item_path", False),
    ("item_links", "item_links", False),
)


def _tokens(col: str, is_array: bool, stop_words: Sequence[str]) -> Column:
    if is_array:
        return F.flatten(F.transform(F.coalesce(F.col(col), F.array().cast("array<string>")),
                                     lambda v: analyze_text(v, stop_words)))
    return analyze_text(F.col(col), stop_words)


def field_tokens(docs: DataFrame, stop_words: Sequence[str] = ()) -> DataFrame:
    """(path, field, boost, tokens) per non-empty text field of each document."""
    specs = [s for s in BASE_FIELDS + ITEM_FIELDS if s[1] in docs.columns]
    arr = [F.struct(F.lit(f).alias("field"), _tokens(c, a, stop_words).alias("tokens")) for f, c, a in specs]
    all_fields = F.array(*arr)
    if "extra" in docs.columns:
        extras = F.transform(
            F.map_entries(F.coalesce(F.col("extra"), F.create_map().cast("map<string,array<string>>"))),
            lambda e: F.struct(e["key"].alias("field"),
                               F.flatten(F.transform(e["value"], lambda v: analyze_text(v, stop_words))).alias("tokens")),
        )
        all_fields = F.concat(all_fields, extras)
    boost = F.col("boost") if "boost" in docs.columns else F.lit(1.0)
    return (docs.select("path", boost.cast("double").alias("boost"), F.inline(all_fields))
            .filter(F.size("tokens") > 0))


def field_lengths(docs: DataFrame, stop_words: Sequence[str] = ()) -> DataFrame:
    """(field, path, n_terms)."""
    return field_tokens(docs, stop_words).select("field", "path", F.size("tokens").cast("int").alias("n_terms"))


def _parts(docs: DataFrame) -> tuple[int, ...]:
    """Parts for the documents: Spark would join parts by the size of their texts, a tenth of their postings'; a
    stream's batch is left to it."""
    return () if docs.isStreaming else (int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")),)


def build_postings(docs: DataFrame, stop_words: Sequence[str] = ()) -> DataFrame:
    """(field, term, path, tf, norm), one row per term occurring in a field of a document."""
    ft = field_tokens(docs.repartition(*_parts(docs), "path"), stop_words).select(
        "field", "path", (F.col("boost") / F.sqrt(F.size("tokens"))).alias("norm"), F.explode("tokens").alias("term"))
    return ft.groupBy("field", "term", "path").agg(
        F.count(F.lit(1)).cast("int").alias("tf"), F.first("norm").alias("norm"))


def term_stats(postings: DataFrame) -> DataFrame:
    """(field, term, df) document frequency per field."""
    return postings.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))


@dataclass
class SearchIndex:
    """Everything a search reads: `postings` and `term_df` are the inverted
    index, `results` the narrow table of result columns, `total` the number of
    documents; `docs` holds the attributes that filters and sorts name. Where
    postings carry a `seq`, `dead` lists the (path, seq) that no longer count."""

    docs: DataFrame
    postings: DataFrame
    term_df: DataFrame
    results: DataFrame | None = None
    total: int | None = None
    dead: DataFrame | None = None

    @property
    def n_docs(self) -> DataFrame:
        return self.docs.agg(F.count(F.lit(1)).alias("n_docs"))

    @property
    def result_table(self) -> DataFrame:
        return self.results if self.results is not None else result_columns(self.docs)


def result_columns(docs: DataFrame) -> DataFrame:
    """(path, title, description) of each document."""
    return docs.select("path", "title", F.coalesce(F.get(F.col("description"), 0), F.lit("")).alias("description"))


def build_index(docs: DataFrame, stop_words: Sequence[str] = (), checkpoint: bool = False) -> SearchIndex:
    """Index the documents. With `checkpoint=True` postings, document
    frequencies and result columns are written to the shared checkpoint folder
    once, so the searches over them neither re-tokenise nor read the corpus."""
    postings = build_postings(docs, stop_words)
    results = result_columns(docs)
    total = None
    if checkpoint:
        postings, results = stored(postings), stored(results)
        total = results.count()
    tdf = term_stats(postings)
    if checkpoint:
        tdf = stored(tdf)
    return SearchIndex(docs=docs, postings=postings, term_df=tdf, results=results if checkpoint else None, total=total)


# Attributes that filters and sorts read, kept with a written index where the documents have them.
ATTRIBUTES = ("title", "language", "tags", "hidden", "template", "item_path", "db", "creator", "editor", "depth", "boost", "item_enter")


def write_index(index: SearchIndex, path: str) -> None:
    """Persist an index: postings and document frequencies sorted by (field,
    term), so that a search's terms prune row groups, result columns and
    document attributes."""
    for name, df in (("postings", index.postings), ("term_df", index.term_df)):
        df.repartitionByRange("field", "term").sortWithinPartitions("field", "term").write.mode("overwrite").parquet(f"{path}/{name}")
    index.result_table.write.mode("overwrite").parquet(f"{path}/results")
    kept = [c for c in ATTRIBUTES if c in index.docs.columns]
    docs = index.docs.select("path", *kept)
    if "item_enter" in kept:  # a subtree is a range: its row groups lie together
        docs = docs.repartitionByRange("item_enter").sortWithinPartitions("item_enter")
    docs.write.mode("overwrite").parquet(f"{path}/docs")


def read_index(spark: SparkSession, path: str) -> SearchIndex:
    """The index that `write_index` wrote, ready to be searched."""
    postings, term_df, results, docs = (spark.read.parquet(f"{path}/{n}") for n in ("postings", "term_df", "results", "docs"))
    return SearchIndex(docs=docs, postings=postings, term_df=term_df, results=results, total=results.count())
