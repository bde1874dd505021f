"""Operator 1: proportional stratified interleaving.

Rows are shuffled with a seed inside each source, every row gets its fractional
rank ``(rank + 0.5) / rows of the source``, and all rows are put in the order of
that fraction. Any run of neighbours in this order holds the sources in their
proportions, so cutting it into equal runs gives shards that match the mixture.

Only narrow rows (id, source, size, checksum, keys) are shuffled, twice, by
range; the shuffle key is part of the range, so a source with a third of all
rows is spread over many tasks like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import global_rank, shuffle_parts, table, utf8_size

N_SHARDS = 8
SEED = 20240


def interleave(docs: DataFrame, n_shards: int = N_SHARDS, seed: int = SEED, id_col: str = "doc_id",
               text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per input row: id, source, size, text_crc32, shard, slot.

    Law ``rows``: shard sizes differ by one row at most. ``size`` is the UTF-8
    bytes of the text plus 1 (a null text counts as no bytes, checksum 0). Rows
    without a source form a source of their own; rows without an id are placed
    like others. Repeated rows are each placed. Ties of the shuffle key are
    broken by id and checksum, so equal input gives equal shards. An empty table
    gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        (utf8_size(F.col(text_col)) + 1).alias("size"), F.crc32(text).alias("text_crc32"),
        F.concat(F.when(F.col(source_col).isNull(), "0").otherwise("1"),
                 F.coalesce(F.col(source_col).cast("string"), F.lit(""))).alias("stratum"))
    rows = rows.withColumn("key", F.xxhash64(F.lit(seed), "id", "text_crc32"))
    placed = global_rank(rows, ["stratum", "key", "id", "text_crc32"], "at")
    strata = placed.groupBy("stratum").agg(F.min("at").alias("first"), F.count("*").alias("of"))
    placed = placed.join(strata, "stratum").select(
        "id", "source", "size", "text_crc32", "stratum", "key",
        ((F.col("at") - F.col("first") + 0.5) / F.col("of")).alias("fraction"))
    mixed = global_rank(placed, ["fraction", "stratum", "key", "id"], "at")
    return (mixed.withColumn("total", mixed.agg(F.count("*")).scalar())
            .withColumn("shard", F.expr(f"CAST((at * {n_shards}L) DIV total AS INT)"))
            .withColumn("slot", F.expr(f"at - (shard * total + {n_shards - 1}) DIV {n_shards}"))
            .select("id", "source", "size", "text_crc32", "shard", "slot"))


def write_shards(docs: DataFrame, shards: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write the rows of ``docs`` (unique ids) into ``path/shard=N``, each shard in slot order."""
    placed = docs.join(shards.select(F.col("id").alias(id_col), "shard", "slot"), id_col)
    n = shuffle_parts(docs.sparkSession)
    placed.repartitionByRange(n, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = interleave(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return placed.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "source")
