"""Streams that keep side tables: events, windowed reports, waiting pages, the crawl frontier.

Every sink writes a folder per batch by overwriting it, and reads the folders of
batches below its own number only. A batch that is repeated after a failure thus
gives the same rows, raises no event twice and counts no page twice.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import enrich as EN
from ..operators import route as R
from ..session import stored
from .stream import _exists, scratch


def _folder(root: str, epoch: int) -> str:
    return f"{root}/batch={epoch:09d}"


def _write(df: DataFrame, root: str, epoch: int) -> None:
    df.write.mode("overwrite").parquet(_folder(root, epoch))


def read_batches(spark: SparkSession, root: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """Rows of all batches (below ``before``) with their number as ``batch``; none where nothing was written."""
    full = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    if not _exists(spark, root):
        return spark.createDataFrame([], full)
    rows = spark.read.schema(full).parquet(root)
    return rows if before is None else rows.filter(F.col("batch") < before)


def _run(stream: DataFrame, sink: Callable[[DataFrame, int], None], ckpt: str, mode: str = "append"):
    q = stream.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


# ---------------------------------------------------------------- events to several listeners

def deliver_events(batch: DataFrame, epoch: int, root: str, listeners: Mapping[str, Callable[[DataFrame, int], None]] | None = None) -> None:
    """The events of a batch of outcomes, one table per event below ``root``; listeners get (rows, batch number).

    A listener is called once for each try of a batch; one that keeps the numbers it has seen drops repeats.
    """
    rows = R.outcome_events(batch).select("seq", "doc_key", "event").persist()
    try:
        for event in sorted(set(R.EVENT_NAMES.values())):
            mine = rows.filter(F.col("event") == event)
            _write(mine.drop("event"), f"{root}/{event}", epoch)
            if listeners and event in listeners:
                listeners[event](mine, epoch)
    finally:
        rows.unpersist()


def stream_events(outcome_stream: DataFrame, root: str, ckpt: str, listeners: Mapping[str, Callable[[DataFrame, int], None]] | None = None) -> None:
    """D10 on a stream: one read of the stream, one sink per event."""
    _run(outcome_stream, lambda batch, epoch: deliver_events(batch, epoch, root, listeners), ckpt)


_EVENT = T.StructType([T.StructField("seq", T.LongType()), T.StructField("doc_key", T.StringType())])


def read_events(spark: SparkSession, root: str) -> DataFrame:
    """(seq, doc_key, event) of all batches."""
    out = None
    for event in sorted(set(R.EVENT_NAMES.values())):
        rows = read_batches(spark, f"{root}/{event}", _EVENT).select("seq", "doc_key", F.lit(event).alias("event"))
        out = rows if out is None else out.unionByName(rows)
    return out


# ---------------------------------------------------------------- reports by event-time window

_KEY = ["window_start", "status", "outcome"]
_REPORT = T.StructType([T.StructField("window_start", T.TimestampType()), T.StructField("status", T.IntegerType()), T.StructField("outcome", T.StringType()),
                        T.StructField("pages", T.LongType()), T.StructField("total_centis", T.LongType()), T.StructField("max_seconds", T.DoubleType()),
                        T.StructField("failed", T.LongType())])


def window_report(outcomes: DataFrame, width: str = "1 hour") -> DataFrame:
    """D11/D12 by window of `fetched_at`: pages, seconds and failed fetches by status and outcome. Batch and stream."""
    rows = outcomes.withColumn("_t", F.col("fetched_at").cast("timestamp")) if "_t" not in outcomes.columns else outcomes
    g = rows.groupBy(F.window("_t", width).alias("_w"), "status", "outcome").agg(
        F.count(F.lit(1)).alias("pages"), F.sum(F.round(F.col("download_seconds") * 100)).cast("bigint").alias("total_centis"),
        F.round(F.max("download_seconds"), 6).alias("max_seconds"), F.count_if(F.col("status") >= 500).alias("failed"))
    return g.select(F.col("_w.start").alias("window_start"), "status", "outcome", "pages", "total_centis", "max_seconds", "failed")


def stream_report(outcome_stream: DataFrame, root: str, ckpt: str, width: str = "1 hour", delay: str = "1 day") -> int:
    """D11/D12 on a stream: each batch writes the windows that it changed, with their whole counts.

    Rule for late rows: a row counts while its window ends after the newest time
    seen so far less ``delay``; state is kept that long, and later rows are dropped.
    Their number in this run is returned. Rows without a time are in no window.
    """
    rows = outcome_stream.withColumn("_t", F.col("fetched_at").cast("timestamp")).withWatermark("_t", delay)
    q = _run(window_report(rows, width), lambda batch, epoch: _write(batch, root, epoch), ckpt, "update")
    return sum(int(s["numRowsDroppedByWatermark"]) for p in q.recentProgress for s in p["stateOperators"])


def read_report(spark: SparkSession, root: str) -> DataFrame:
    """The windows as the last batch that changed each of them left them."""
    rows = read_batches(spark, root, _REPORT)
    values = [f.name for f in _REPORT.fields if f.name not in _KEY]
    last = rows.groupBy(*_KEY).agg(F.max_by(F.struct(*values), "batch").alias("_v"))
    return last.select(*_KEY, "_v.*")


# ---------------------------------------------------------------- pages that wait for their item

def attach_batch(batch: DataFrame, epoch: int, root: str, items: Callable[[], DataFrame], header: str = "item_uri") -> None:
    """The pages of a batch and those that wait, joined with the items as they are now.

    Pages that name no item, or one that exists, go to the table `attached`; the
    others wait in `waiting`, with the batch in which they came, until their item
    appears. A page is in one of the two.
    """
    spark = batch.sparkSession
    pages = batch.withColumn("since", F.lit(epoch).cast("long"))
    waiting = read_batches(spark, f"{root}/waiting", pages.schema, epoch)
    last = waiting.agg(F.max("batch").alias("batch"))
    waiting = waiting.join(last, "batch", "left_semi").drop("batch").filter("since IS NOT NULL")  # what the batch before left
    all_pages = pages.unionByName(waiting).persist()
    try:
        it = items()
        missing = EN.missing_items(all_pages, it, header).drop("outcome", "reason").persist()
        found = all_pages.join(EN.item_uri(it).select(F.col("item_uri").alias("_iu")), F.col(header) == F.col("_iu"), "left_semi")
        unnamed = all_pages.filter(F.coalesce(F.col(header), F.lit("")) == "")
        _write(EN.join_items(found.unionByName(unnamed), it, header), f"{root}/attached", epoch)
        # a row marks the batch even when nobody waits
        none = spark.createDataFrame([tuple([None] * len(pages.columns))], T.StructType([T.StructField(f.name, f.dataType, True) for f in pages.schema.fields]))
        _write(missing.unionByName(none), f"{root}/waiting", epoch)
        missing.unpersist()
    finally:
        all_pages.unpersist()


def stream_items(page_stream: DataFrame, root: str, ckpt: str, items: Callable[[], DataFrame], header: str = "item_uri") -> None:
    """E1/E2 on a stream; ``items`` is asked for the items anew with every batch."""
    _run(page_stream, lambda batch, epoch: attach_batch(batch, epoch, root, items, header), ckpt)


def attached_pages(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/attached").drop("batch", "since")


def waiting_pages(spark: SparkSession, root: str) -> DataFrame:
    """The pages that wait after the last batch, as E2 reports them."""
    rows = spark.read.parquet(f"{root}/waiting")
    rows = rows.join(rows.agg(F.max("batch").alias("batch")), "batch", "left_semi").drop("batch").filter("since IS NOT NULL")
    return rows.withColumn("outcome", F.lit(R.ITEM_MISSING)).withColumn("reason", F.format_string("Item not found: %s", "item_uri"))


# ---------------------------------------------------------------- the frontier of a growing graph

#: Levels of a batch after which ways without a choice are followed by doubling.
LONG_WAY = 16

_DEPTH = T.StructType([T.StructField("node", T.LongType()), T.StructField("depth", T.IntegerType())])


def _level(met: DataFrame, levels: str, level: int, max_depth: int) -> DataFrame:
    """The nodes of ``met`` that lie less deep than in all levels so far, written as the next one."""
    spark, none = met.sparkSession, F.lit(None).cast("int")
    if max_depth > 0:
        met = met.filter(F.col("depth") <= max_depth)
    known = read_batches(spark, levels, _DEPTH).select("node", none.alias("depth"), F.col("depth").alias("_was"))
    both = met.select("node", "depth", none.alias("_was")).unionByName(known)
    least = both.groupBy("node").agg(F.min("depth").alias("depth"), F.min("_was").alias("_was"))
    _write(least.filter("depth IS NOT NULL AND (_was IS NULL OR depth < _was)").drop("_was"), levels, level)
    return spark.read.schema(_DEPTH).parquet(_folder(levels, level))


def _ways(frontier: DataFrame, links: DataFrame, known: DataFrame, least: int) -> DataFrame:
    """(node, depth) of the frontier and of the ways on from it without a choice, each as long as it is.

    A link can still help if its end is unknown or deeper than the frontier's least
    depth and one. Nodes with one such link jump to its end; jumps of jumps are twice
    as long, so a way takes as many rounds as its length has binary digits. The depths
    are those of real ways, maybe not the shortest.
    """
    deep = known.groupBy(F.col("node").alias("dst")).agg(F.min("depth").alias("_was"))
    open_ends = links.filter("src <> dst").join(deep, "dst", "left").filter(F.col("_was").isNull() | (F.col("_was") > least + 1))
    jump = stored(open_ends.groupBy("src").agg(F.min("dst").alias("dst"), F.count("*").alias("_n")).filter("_n = 1").drop("_n"))
    found, steps, before = frontier.select("node", "depth"), 1, None
    while True:
        on = found.join(jump, found["node"] == jump["src"]).select(F.col("dst").alias("node"), (F.col("depth") + steps).cast("int").alias("depth"))
        found = stored(found.unionByName(on).groupBy("node").agg(F.min("depth").alias("depth")))
        now = found.agg(F.count("*"), F.sum("depth")).first()
        if now == before:
            return found
        before, steps = now, 2 * steps
        jump = stored(jump.join(jump.select(F.col("src").alias("dst"), F.col("dst").alias("_next")), "dst").select("src", F.col("_next").alias("dst")))


def reach_batch(edges: DataFrame, epoch: int, root: str, seeds: DataFrame, max_depth: int = 0) -> None:
    """Least depths after a batch of edges (src, dst), wherever in the graph they lie.

    The batch's edges are kept, hashed by source; then the nodes whose depth falls
    are followed level by level through all edges so far, and only these are
    written. A late short cut corrects all that lies behind it; a node seen before
    at no greater depth goes no further. Long ways without a choice are followed by
    doubling, which finds upper bounds; it ends when no link makes a depth less.
    Levels are stored as Parquet: a checkpoint hands on size estimates, here
    products whose digits double with each level.
    """
    spark = edges.sparkSession
    edge = T.StructType([T.StructField("src", T.LongType()), T.StructField("dst", T.LongType())])
    new = edges.select(F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst")).dropna().distinct()
    _write(new.repartition("src"), f"{root}/edges", epoch)
    every = stored(read_batches(spark, f"{root}/edges", edge, epoch + 1).select("src", "dst").distinct())
    start = seeds.select(F.col("node").cast("long").alias("node"), F.lit(0).alias("depth")).dropna().distinct()
    known = read_batches(spark, f"{root}/depths", _DEPTH, epoch).select("node", "depth").unionByName(start)
    levels, level, steps = scratch(spark, "levels"), 0, 0  # level 0 is what was known
    frontier = _level(known, levels, level, 0)
    links = spark.read.schema(edge).parquet(_folder(f"{root}/edges", epoch))
    while True:
        met = frontier.join(links, frontier["node"] == links["src"]).select(F.col("dst").alias("node"), (F.col("depth") + 1).cast("int").alias("depth"))
        level, steps, links = level + 1, steps + 1, every
        frontier = _level(met, levels, level, max_depth)
        least = frontier.agg(F.min("depth")).first()[0]
        if least is None:
            break
        if steps % LONG_WAY == 0:
            level += 1
            ways = _ways(frontier, every, read_batches(spark, levels, _DEPTH, level), least)
            frontier = frontier.unionByName(_level(ways, levels, level, max_depth))
    fallen = read_batches(spark, levels, _DEPTH).filter("batch > 0").select("node", "depth")
    fallen = fallen.unionByName(start) if epoch == 0 else fallen
    _write(fallen.groupBy("node").agg(F.min("depth").alias("depth")), f"{root}/depths", epoch)


def stream_reach(edge_stream: DataFrame, root: str, ckpt: str, seeds: DataFrame, max_depth: int = 0) -> None:
    _run(edge_stream, lambda batch, epoch: reach_batch(batch, epoch, root, seeds, max_depth), ckpt)


def read_reach(spark: SparkSession, root: str) -> DataFrame:
    """(node, depth): the least depth of every node found so far."""
    return spark.read.parquet(f"{root}/depths").groupBy("node").agg(F.min("depth").alias("depth"))
