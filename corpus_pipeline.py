"""The corpus pipeline over `documents`: five stages, each calling one of the operators.

Every stage works on all rows that the one before kept; all but the last return
the columns of `documents`. No SQL expresses the stages (fingerprints, learned
models, merges), so they are tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitesift.llm import bpe, decontaminate, langid, pii, simhash
from sitesift.llm.common import release, table, written

#: Columns that language identification makes; own columns of these names are kept beside them.
_MADE = ("language", "probability", "text_language", "accepted")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is identified, with it as their label; others (no letters, no known language) go."""
    release(spark)
    own = {c: f"_own_{c}" for c in docs.columns if c in _MADE}
    found = langid.identify_documents(docs.withColumnsRenamed(own)).filter("accepted").withColumn("lang", F.col("language"))
    return found.drop(*_MADE).withColumnsRenamed({b: a for a, b in own.items()}).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component stays: that with the smallest doc_id."""
    release(spark)
    return simhash.keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a passage of the benchmark go."""
    release(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind; n_chars follows."""
    found = pii.redact(pii.find_spans(docs, out="_spans"), spans_col="_spans")
    return found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with its bytes back from them as a checksum."""
    release(spark)
    ids = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), chars=2_000_000, most=300_000)  # beside what other stages hold
    return ids.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language identification", language),
    ("near-duplicate removal", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("personal data", personal_data),
    ("byte-level BPE", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
