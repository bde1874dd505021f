"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sitesift.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder, for one written table."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def global_rank(df: DataFrame, order: list[str], out: str = "pos") -> DataFrame:
    """``df`` with ``out``: the row's 0-based place in the order of ``order``, over all rows.

    Rows are range partitioned and sorted; a row's place is its place in its
    partition plus the sizes of the partitions before. Only one row per
    partition meets in one task. The sorted rows are written once, so that the
    partition sizes and the places come from the same partitioning.
    """
    n = shuffle_parts(df.sparkSession)
    ranked = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranked = written(ranked, "rank")
    part, within = F.shiftright("_mid", 33), F.col("_mid").bitwiseAND((1 << 33) - 1)
    sizes = ranked.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = sizes.selectExpr(
        "_part", "sum(_n) OVER (ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - _n AS _before")
    return (ranked.withColumn("_part", part)
            .join(F.broadcast(before), "_part")  # one row per partition
            .withColumn(out, F.col("_before") + within)
            .drop("_mid", "_part", "_before"))


def utf8_size(text: Column) -> Column:
    """Bytes of the text in UTF-8; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


#: Characters of text that a task handles at once.
SLAB_CHARS = 1_000_000

#: What this Python worker keeps from one task to the next, by name; workers live on through later stages.
_KEPT: dict[str, object] = {}


def keep(name: str, build: Callable[[], object]):
    """The object of this name that the worker keeps, built at first; objects of other names go."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = build()
    return _KEPT[name]


def forget() -> None:
    """Free what earlier stages kept in this worker, and give Arrow's unused memory back."""
    _KEPT.clear()
    pa.default_memory_pool().release_unused()


def release(spark: SparkSession) -> None:
    """Free what idle workers kept from earlier stages: a job of short tasks that meets each of them, as far as it can.

    Nothing depends on it but memory; a worker that it misses frees its objects with its next task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ctypes
        import gc
        import time

        forget()
        gc.collect()
        try:
            ctypes.CDLL(None).malloc_trim(0)  # freed memory goes back to the system
        except (AttributeError, OSError):
            pass
        time.sleep(0.1)  # so that the other workers get tasks too
        yield from batches

    n = 2 * spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).mapInArrow(run, "id long").count()


def slabs(texts: list[str], chars: int = SLAB_CHARS) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``chars`` characters; at least one text each."""
    start = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > chars:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch; null as empty."""
    return [t if t is not None else "" for t in batch.column(column).to_pylist()]


def add_columns(df: DataFrame, fields: dict[str, str], text_col: str,
                make: Callable[[list[str], pa.RecordBatch], dict[str, list]], drop: tuple[str, ...] = (), keeps: bool = False,
                chars: int = SLAB_CHARS) -> DataFrame:
    """``df`` with the columns ``fields`` (name: type) that ``make`` computes from the texts of a slab of rows.

    ``make`` gets the texts (null as empty) and their rows. Other columns pass
    through as Arrow arrays, whatever their types; columns in ``drop`` go.
    ``keeps``: ``make`` uses an object kept by the worker. ``chars``: characters of a slab.
    """
    df = df.drop(*fields)
    kept = [f for f in df.schema.fields if f.name not in drop]
    schema = T.StructType([*kept, *[T.StructField(n, T._parse_datatype_string(t)) for n, t in fields.items()]])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        if not keeps:
            forget()
        for batch in batches:
            texts = texts_of(batch, text_col)
            for a, b in slabs(texts, chars):
                rows = batch.slice(a, b - a)
                made = make(texts[a:b], rows)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(n).cast(arrow.field(n).type) if n in names else pa.array(made[n], arrow.field(n).type)
                     for n in schema.names], schema=arrow)
        pa.default_memory_pool().release_unused()  # the worker lives on, idle, through later stages

    return df.mapInArrow(run, schema)
