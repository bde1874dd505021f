"""Subtrees as intervals (G13, G14, E9): Euler tour numbers of a forest of items.

Every item has two arcs of a tour, one into it and one out of it, each naming the
arc that follows. How far an arc is from the end of the tour comes from pointer
doubling over the arcs (list ranking), log2 of their number in rounds, whatever the
depth of the tree. The numbers of the arcs into items are the items' places in
depth-first order, so a subtree is the range from an item's `enter` to its `leave`: a
comparison of two numbers that prunes row groups of a table sorted by `enter`, where
the path of ancestors has to be split and searched for every document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored


def numbered(df: DataFrame, order: list, out: str = "at") -> DataFrame:
    """``df`` with its 0-based place in the order, over all rows; stored.

    Rows are sorted by range; a row's place is its place in its partition after the
    rows of the partitions before, of which one row each meets in one task.
    """
    s = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id()))
    part, within = F.shiftright("_m", 33), F.col("_m").bitwiseAND((1 << 33) - 1)
    sizes = s.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    s = s.withColumn("_part", part).join(F.broadcast(before), "_part").withColumn(out, F.col("_before") + within)
    return s.drop("_m", "_part", "_before")


def tour_intervals(items: DataFrame, node: str = "item_no", parent: str = "parent_no") -> DataFrame:
    """(node, enter, leave): places in depth-first order, siblings and roots by their ids; ``leave`` is the place of
    the last item of the subtree.

    An item whose parent is null or not in the table is a root. Rows without an id
    and repeated rows are ignored; two parents of one item, or items in a cycle of
    parents, are an error. An empty table gives no rows.
    """
    rows = items.select(F.col(node).alias("node"), F.col(parent).alias("parent")).filter("node IS NOT NULL").distinct()
    known = rows.select(F.col("node").alias("parent")).distinct().withColumn("_known", F.lit(True)).hint("merge")
    rows = rows.join(known, "parent", "left").select("node", F.when(F.col("_known"), F.col("parent")).alias("parent"))
    rows = stored(numbered(rows, [F.col("parent").asc_nulls_first(), "node"]))
    n = rows.count()
    if rows.select("node").distinct().count() < n:
        raise ValueError("an item with two parents")
    sibling = rows.select((F.col("at") - 1).alias("at"), F.col("parent").alias("_p"), F.col("at").alias("_next"))
    first = rows.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.min("at").alias("_child"))
    up = rows.select(F.col("node").alias("parent"), F.col("at").alias("_up"))
    rows = (rows.join(sibling.hint("merge"), "at", "left").join(first.hint("merge"), "node", "left").join(up.hint("merge"), "parent", "left")
            .withColumn("_next", F.when(F.col("_p").eqNullSafe(F.col("parent")), F.col("_next"))))
    into = F.struct((F.col("at") * 2).alias("arc"), F.coalesce(F.col("_child") * 2, F.col("at") * 2 + 1).alias("to"), F.lit(1).cast("long").alias("n"))
    out = F.struct((F.col("at") * 2 + 1).alias("arc"), F.coalesce(F.col("_next") * 2, F.col("_up") * 2 + 1).alias("to"), F.lit(0).cast("long").alias("n"))
    arcs, reach = stored(rows.select(F.inline(F.array(into, out)))), 1
    while not arcs.filter("to IS NOT NULL").isEmpty():
        if reach > 2 * n:
            raise ValueError("items in a cycle of parents")
        t = arcs.select(F.col("arc").alias("to"), F.col("to").alias("_to"), F.col("n").alias("_n")).hint("merge")
        going = arcs.filter("to IS NOT NULL").join(t, "to").select("arc", F.col("_to").alias("to"), (F.col("n") + F.col("_n")).alias("n"))
        arcs, reach = stored(arcs.filter("to IS NULL").unionByName(going)), reach * 2
    ranks = arcs.groupBy(F.floor(F.col("arc") / 2).alias("at")).agg(
        F.max(F.when(F.col("arc") % 2 == 0, F.lit(n) - F.col("n"))).alias("enter"), F.max(F.when(F.col("arc") % 2 == 1, F.lit(n) - F.col("n") - 1)).alias("leave"))
    return rows.select("at", "node").join(ranks.hint("merge"), "at").select(F.col("node").alias(node), "enter", "leave")
