"""Operator 11: hard negatives by anchor spanning-tree bounds.

Vectors are quantized to integers, and a row's score for an anchor is their
integer inner product. An anchor's positives are its best other rows of the same
label; for each positive, its hard negatives are the best rows of another label
whose score lies in a window below the positive's.

Anchors met in a task are joined, ``TREE`` at a time, into a minimum spanning
tree. The root scores every candidate. Along an edge of length d a candidate of
norm r changes its score by d * r at most, so the bounds of a parent's score, plus
or minus d * r, bound the child's. Only candidates whose bounds overlap the
child's window (from the worst score it still has use for, up) are scored again;
the others hand their wider bounds down. Unit vectors without clusters lie so far
apart that nearly all windows overlap; then the scoring is one matrix product.

Layout: the rows are put in the order (dimension, label, id) by ranges and cut
into blocks of bounded bytes. Positives look only into the blocks that hold the
anchor's label, negatives into all blocks of its dimension. Each block is sent to
a task once, followed by a stream of the anchors that need it, so a task holds one
block and one tree; each block gives an anchor its few best, and those meet in a
shuffle that keeps the best per task first. No label and no anchor is one group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import forget, global_rank, shuffle_parts, table, written

SCALE = 256
N_POSITIVE = 5
N_NEGATIVE = 5
#: A negative's score is from LOW to HIGH percent of the positive's.
LOW, HIGH = 80, 100
#: Anchors in one spanning tree, candidates scored at once.
TREE, TILE = 256, 2048
#: Bytes of the quantized vectors of one block.
BLOCK_BYTES = 16 << 20
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


class SpanningTree:
    """Minimum spanning tree of vectors, as levels of (nodes, parents, edge lengths)."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        n = len(vectors)
        square = np.einsum("ij,ij->i", vectors, vectors)
        self.norms = np.sqrt(square)
        near, parent, depth = np.full(n, np.inf), np.zeros(n, int), np.zeros(n, int)
        edge, out = np.zeros(n), np.ones(n, bool)
        at = int(np.argmin(((vectors - vectors.mean(0)) ** 2).sum(1)))
        for _ in range(n):
            out[at] = False
            gap = vectors - vectors[at]
            length = np.einsum("ij,ij->i", gap, gap)
            closer = out & (length < near)
            near[closer], parent[closer] = length[closer], at
            if out.any():
                nxt = int(np.argmin(np.where(out, near, np.inf)))
                edge[nxt], depth[nxt] = np.sqrt(near[nxt]), depth[parent[nxt]] + 1
                at = nxt
        self.levels = [(nodes, parent[nodes], edge[nodes]) for nodes in (np.flatnonzero(depth == k) for k in range(depth.max() + 1))]

    def scores(self, rows: np.ndarray, norms: np.ndarray, low: np.ndarray, high: np.ndarray, fit: np.ndarray):
        """(node, row, score) of all pairs in ``fit`` whose score is from low to high of the node; pairs scored."""
        lo, hi = np.empty((2, len(self.vectors), len(rows)))
        found, scored = [], 0
        for depth, (nodes, parents, edges) in enumerate(self.levels):
            if depth == 0:
                need, columns = fit[nodes], np.arange(len(rows))
            else:
                reach = edges[:, None] * norms * (1 + 1e-9) + 0.5
                most = self.norms[nodes][:, None] * norms * (1 + 1e-9) + 0.5
                lo[nodes], hi[nodes] = np.maximum(lo[parents] - reach, -most), np.minimum(hi[parents] + reach, most)
                need = (hi[nodes] >= low[nodes][:, None]) & (lo[nodes] <= high[nodes][:, None]) & fit[nodes]
                columns = np.flatnonzero(need.any(0))
            exact = product(self.vectors[nodes], rows[columns] if len(columns) < len(rows) else rows)
            scored += exact.size
            lo[nodes[:, None], columns] = hi[nodes[:, None], columns] = exact.astype(float)
            kept = need[:, columns] & (exact >= low[nodes][:, None]) & (exact <= high[nodes][:, None])
            i, j = np.nonzero(kept)
            found.append((nodes[i], columns[j], exact[i, j]))
        return (*(np.concatenate(x) for x in zip(*found)), scored)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of the rows of two integer-valued matrices, exactly: doubles where they hold them, else Python integers."""
    most = np.sqrt((a * a).sum(1).max(initial=0)) * np.sqrt((b * b).sum(1).max(initial=0))
    if most < _EXACT:
        return a @ b.T
    whole = np.vectorize(int, otypes=[object])
    return whole(a) @ whole(b).T if a.size and b.size else np.zeros((len(a), len(b)))


def best(group: np.ndarray, score: np.ndarray, ident: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each group: greatest score first, ties to the smaller id."""
    rank = np.unique(score, return_inverse=True)[1] if score.dtype == object else score
    order = np.lexsort((ident, -rank, group))
    g = group[order]
    first = np.searchsorted(g, g, "left")
    return order[np.arange(len(g)) - first < k]


def search(tree: SpanningTree, rows: np.ndarray, ids: np.ndarray, fit, low: np.ndarray, high: np.ndarray, k: int):
    """The k best rows of every window of every anchor: (anchor, window, id, score).

    ``low`` and ``high`` have a row per anchor and a column per window (an empty
    window has low over high); ``fit(a, b)`` tells which rows a to b may answer
    which anchor. A window's low end rises to the k-th best score found so far.
    """
    norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    n, w = low.shape
    low = low.copy()
    held = (np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0))
    for a in range(0, len(rows), TILE):
        b = min(len(rows), a + TILE)
        top = tree.norms * norms[a:b].max() * (1 + 1e-9) + 0.5
        lows = np.where(low <= high, low, np.inf).min(1)
        if not (top >= lows).any():
            continue  # no row of the tile is long enough
        node, row, score, _ = tree.scores(rows[a:b], norms[a:b], lows, np.where(low <= high, high, -np.inf).max(1), fit(a, b))
        if not len(node):
            continue
        group, ident, value = [held[0]], [held[1]], [held[2]]
        for j in range(w):
            inside = (score >= low[node, j]) & (score <= high[node, j])
            group.append(node[inside] * w + j)
            ident.append(ids[a + row[inside]])
            value.append(score[inside])
        group, ident, value = np.concatenate(group), np.concatenate(ident), np.concatenate(value)
        keep = best(group, value, ident, k)
        held = group[keep], ident[keep], value[keep]
        full, size = np.unique(held[0], return_counts=True)
        for g in full[size == k]:  # its worst kept score; equal scores may still win by their id
            low[g // w, g % w] = float(held[2][np.searchsorted(held[0], g, "right") - 1])
    return held[0] // w, held[0] % w, held[1], held[2]


def _meet(blocks: DataFrame, anchors: DataFrame, parts: int, scale: int, k: int, windows) -> DataFrame:
    """Every anchor against the block it names: (at, place, other, score), the k best of each window in the block.

    ``windows`` gives (low, high, same label?) of anchors with scores ``held``.
    """
    fields = ["dims", "block", "kind", "at", "id", "label", "vec", "held"]
    none = F.lit(None).cast("array<long>")
    rows = (blocks.select("dims", "block", F.lit(0).alias("kind"), "at", "id", "label", "vec", none.alias("held"))
            .unionByName(anchors.select("dims", "block", F.lit(1).alias("kind"), "at", "id", "label", "vec", "held"))
            .repartition(parts, "dims", "block").sortWithinPartitions("dims", "block", "kind", "at").select(*fields))

    def matrix(pieces: list[pa.RecordBatch], dims: int) -> np.ndarray:
        flat = np.concatenate([p.column("vec").flatten().to_numpy(zero_copy_only=False).astype(float) for p in pieces])
        return np.nan_to_num(np.floor(scale * flat)).reshape(-1, dims) if dims else np.zeros((sum(p.num_rows for p in pieces), 0))

    def numbers(pieces: list[pa.RecordBatch], name: str) -> np.ndarray:
        return np.concatenate([p.column(name).to_numpy(zero_copy_only=False) for p in pieces]).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        now, block, waiting = None, [], []
        data = None

        def answer():
            nonlocal data
            if data is None:
                data = matrix(block, now[0]), numbers(block, "id"), numbers(block, "label")
            vectors, ids, labels = data
            at, own, kinds = numbers(waiting, "at"), numbers(waiting, "id"), numbers(waiting, "label")
            low, high, same = windows([h for p in waiting for h in p.column("held").to_pylist()])
            waiting_vectors = matrix(waiting, now[0])
            waiting.clear()

            def fit(a, b):
                alike = kinds[:, None] == labels[a:b]
                return (alike if same else ~alike) & (own[:, None] != ids[a:b])

            node, place, other, score = search(SpanningTree(waiting_vectors), vectors, ids, fit, low, high, k)
            score = [max(-_LONG - 1, min(_LONG, int(s))) for s in score]
            return pa.RecordBatch.from_arrays([pa.array(at[node], pa.int64()), pa.array(place, pa.int32()), pa.array(other, pa.int64()),
                                               pa.array(score, pa.int64())], names=["at", "place", "other", "score"])

        for batch in batches:
            key = np.stack([batch.column(n).to_numpy() for n in ("dims", "block", "kind")], 1)
            cuts = np.r_[0, np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1, len(key)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if b == a:
                    continue
                piece, here = batch.slice(a, b - a), tuple(key[a][:2].tolist())
                if here != now:
                    if waiting:
                        yield answer()
                    now, data = here, None
                    block.clear()
                if key[a][2] == 0:
                    block.append(piece)
                    continue
                while piece.num_rows:
                    room = TREE - sum(p.num_rows for p in waiting)
                    waiting.append(piece.slice(0, room))
                    piece = piece.slice(min(room, piece.num_rows))
                    if sum(p.num_rows for p in waiting) == TREE:
                        yield answer()
        if waiting:
            yield answer()

    return rows.mapInArrow(run, "at long, place int, other long, score long")


def _first(found: DataFrame, k: int) -> DataFrame:
    """The k best answers of each (at, place), numbered from 1."""
    order = Window.partitionBy("at", "place").orderBy(F.desc("score"), "other")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", scale: int = SCALE,
         n_positive: int = N_POSITIVE, n_negative: int = N_NEGATIVE, low: int = LOW, high: int = HIGH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where ``is_anchor`` holds.

    Scores are inner products of floor(scale * component). Rows with a null id,
    label or vector, or with a null or non-finite component, take no part; equal
    rows (id, label and vector) count once. A row answers anchors of another id
    and of its own dimension only; empty vectors score 0. Equal scores go to the
    smaller id. An anchor without positives, or a positive without negatives in
    its window, gives no rows; neither does an empty table. Windows of scores
    over 2**53 are cut in doubles, and scores beyond a long are shown as the
    nearest long. Other columns are ignored.
    """
    spark = rows.sparkSession
    good = (rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).alias("vec"), is_anchor.alias("anchor"))
            .filter("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL")
            .filter(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
            .withColumn("anchor", F.coalesce("anchor", F.lit(False))).withColumn("dims", F.size("vec"))
            .dropDuplicates(["id", "label", "vec"]))
    ranked = global_rank(good, ["dims", "label", "id"], "at")
    size = ranked.agg(F.count("*").alias("n"), F.max("dims").alias("dims")).first()
    parts = shuffle_parts(spark)
    per = max(1, min(max(1024, -(-size["n"] // parts)), block_bytes // (8 * max(1, size["dims"] or 1))))
    ranked = ranked.withColumn("block", F.expr(f"at DIV {per}L"))
    anchors = ranked.filter("anchor").drop("block")
    parts = max(parts, -(-size["n"] // per))

    def to_blocks(some: DataFrame, *by: str) -> DataFrame:
        reach = ranked.groupBy(*by).agg(F.min("block").alias("_a"), F.max("block").alias("_b"))
        return some.join(reach, list(by)).withColumn("block", F.explode(F.sequence("_a", "_b"))).drop("_a", "_b")

    def any_score(held):
        return np.full((len(held), 1), -np.inf), np.full((len(held), 1), np.inf), True

    def below(held):
        lows, highs = np.full((2, len(held), n_positive), 0.0)
        lows += 1  # no window where there are fewer positives
        for i, scores in enumerate(held):
            for j, s in enumerate(scores):
                lows[i, j], highs[i, j] = -(-low * s // 100), high * s // 100
        return lows, highs, False

    near = _meet(ranked, to_blocks(anchors, "dims", "label").withColumn("held", F.lit(None).cast("array<long>")), parts, scale, n_positive, any_score)
    positives = _first(near, n_positive).select("at", (F.col("rank") - 1).alias("place"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
    positives = written(positives.join(anchors.select("at", F.col("id").alias("anchor_id")), "at"), "positives")
    held = positives.groupBy("at").agg(F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("_p"))  # at most n_positive each
    asking = anchors.join(held, "at").withColumn("held", F.col("_p.positive_score")).drop("_p")
    far = _meet(ranked, to_blocks(asking, "dims"), parts, scale, n_negative, below)
    return (_first(far, n_negative).join(positives, ["at", "place"])
            .select("anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mine(rows, F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH good AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor, a.label = r.label AS alike, r.vec_id AS other, list_dot_product(a.q, r.q)::BIGINT AS score
  FROM good a JOIN good r ON a.vec_id <> r.vec_id AND len(a.q) = len(r.q) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor, other, score FROM scores WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5)
SELECT p.anchor AS anchor_id, p.other AS positive_id,
       (row_number() OVER w)::INTEGER AS rank, n.other AS negative_id,
       p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor = p.anchor AND NOT n.alike AND 80 * p.score <= 100 * n.score AND n.score <= p.score
WINDOW w AS (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other)
QUALIFY row_number() OVER w <= 5
"""
