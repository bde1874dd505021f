"""Operator 4: SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints that differ in at most three bits must meet in some table. Every
bit gets a nonzero vector of four bits; table ``v`` (one of the 15 nonzero
vectors) masks out the bits whose vector is orthogonal to ``v`` and hashes the
others. Three vectors always leave some ``v`` orthogonal to all of them, so any
three differing bits are masked out in that table: no pair within the radius is
lost, whatever the data.

Rows are distinct fingerprints, not documents, so copies cost nothing. A bucket
with many fingerprints is covered again over the bits that its table left free,
and once more if need be; the free bits shrink from 64 to 32, 16 and 8, so a
bucket of the last level holds at most 256 fingerprints. In a bucket only a
spanning forest of its links is given out, which leaves the components whole
without all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_columns, table, written
from .graph import components

RADIUS = 3
SHINGLE = 3
SEED = 42
#: Fingerprints compared within one bucket; a larger bucket is covered again.
BUCKET = 1024
LEVELS = 3
_BLOCK = 1 << 16


def fingerprint(text: str | None, k: int = SHINGLE) -> int:
    """64 bits: bit i is set if it is set in over half of the shingles' hashes."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(k, len(words))
    joined = b" ".join(words)
    ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
    starts = [0, *[e + 1 for e in ends[:-1]]]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1:])), np.uint64, len(words) - k + 1)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _BLOCK):
        bits = np.unpackbits(hashes[i:i + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def with_fingerprint(docs: DataFrame, text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with the text's fingerprint as a (signed) long."""
    return add_columns(docs, {out: "long"}, text_col, lambda texts, _: {out: [_signed(fingerprint(t)) for t in texts]})


def covering_masks(free: int = (1 << 64) - 1, radius: int = RADIUS) -> list[int]:
    """Masks over the bits of ``free``: any ``radius`` of them are outside some mask."""
    vectors = (1 << (radius + 1)) - 1
    bits = [i for i in range(64) if free >> i & 1]
    return [sum(1 << b for j, b in enumerate(bits) if (j % vectors + 1 & v).bit_count() % 2) for v in range(1, vectors + 1)]


def _levels() -> list[dict[int, list[int]]]:
    """For each level: mask of the bucket above to the masks below it."""
    out, above = [], [0]
    for _ in range(LEVELS):
        below = {m: sorted({m | x for x in covering_masks(~m & (1 << 64) - 1)}) for m in above}
        out.append(below)
        above = sorted({x for xs in below.values() for x in xs})
    return out


def _forest(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that span the components of the fingerprints at ``radius`` differing bits or fewer."""
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius
    left = np.ones(len(prints), bool)
    links = []
    for i in range(len(prints)):
        if not left[i]:
            continue
        left[i] = False
        queue = [i]
        while queue:
            u = queue.pop()
            new = np.flatnonzero(near[u] & left)
            left[new] = False
            queue += new.tolist()
            links += [(prints[u], prints[v]) for v in new]
    return links


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that span the components of distinct ``fp`` at ``radius`` (three) differing bits or fewer."""
    spark = prints.sparkSession
    found = None
    schema = "a long, b long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [x for fps in batch["fps"] for x in _forest(np.array(fps, np.int64).view(np.uint64), radius)]
            yield pd.DataFrame(np.array(out, np.uint64).reshape(-1, 2).view(np.int64), columns=["a", "b"])

    for level, below in enumerate(_levels(), 1):
        if level == 1:
            rows = prints.select("fp", F.explode(F.array(*[F.lit(_signed(x)) for x in below[0]])).alias("mask"))
        else:
            masks = spark.createDataFrame([(_signed(m), [_signed(x) for x in xs]) for m, xs in below.items()], "mask long, masks array<long>")
            rows = rows.join(F.broadcast(masks), "mask").select("fp", F.explode("masks").alias("mask"))  # fixed tables: 15 and 225 rows
        rows = rows.withColumn("key", F.expr("fp & mask"))
        if level > 1:
            rows = rows.distinct()  # two ways lead to one bucket
        large = None
        if level < LEVELS:
            large = written(rows.groupBy("mask", "key").agg(F.count("*").alias("n")).filter(F.col("n") > BUCKET).drop("n"), "buckets")
            small = rows.join(large, ["mask", "key"], "left_anti")
        else:
            small = rows
        met = (small.groupBy("mask", "key").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
               .select("fps").mapInPandas(run, schema))
        found = met if found is None else found.unionByName(met)
        if large is None or large.isEmpty():
            break
        rows = rows.join(large, ["mask", "key"], "left_semi").select("fp", "mask")
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, root, component_id) per row: fingerprint, smallest linked fingerprint, smallest linked id.

    Every row takes part. A null or empty text has no words: fingerprint zero,
    linked like any other. Rows without an id take part; ``component_id`` is
    null only where no row of the component has an id. Repeated rows and ids are
    returned as often as they come. An empty table gives no rows; other columns
    are not read.
    """
    return from_prints(written(with_fingerprint(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
                               .select("id", F.col("fingerprint").alias("fp")), "prints"))


def from_prints(prints: DataFrame) -> DataFrame:
    """``near_duplicates`` for rows (id, fp)."""
    nodes = prints.groupBy("fp").agg(F.min("id").alias("least"))
    stars = components(links(nodes.select("fp")))
    nodes = written(nodes.join(stars.withColumnRenamed("node", "fp"), "fp", "left")
                    .select("fp", "least", F.coalesce("root", "fp").alias("root")), "nodes")
    classes = nodes.join(nodes.groupBy("root").agg(F.min("least").alias("component_id")), "root").drop("least")
    return prints.join(classes, "fp").select("id", "fp", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id.

    Rows without an id stay only where no row of their component has one; then
    one of those with the smallest fingerprint stays. Of repeated rows with the
    kept id one stays.
    """
    cols = docs.columns
    marked = written(with_fingerprint(docs, text_col, "_fp"), "marked")
    rows = from_prints(marked.select(F.col(id_col).alias("id"), F.col("_fp").alias("fp")))
    kept = rows.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "fp")).alias("k")).select(
        F.col("k.id").alias("_id"), F.col("k.fp").alias("_fp"))
    mine = marked[id_col].eqNullSafe(kept["_id"]) & (marked["_fp"] == kept["_fp"])
    return marked.join(kept, mine, "left_semi").dropDuplicates(["_fp", id_col]).select(*cols)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text")).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
