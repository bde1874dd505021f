"""Operator 3: nearest neighbours by inner product, with vantage-point trees per shard.

Rows are dealt by hash into shards of bounded size, and each shard gets a tree.
The rows of a shard are cut into bands by norm, with a tree for each, so that a few
long rows do not spoil the others' distances. Inner products become distances by
one more component: with M the largest norm of the band, a row x becomes
(x, sqrt(M^2 - |x|^2)) and a query q becomes (M q / |q|, 0); then
|q' - x'|^2 = 2 M^2 - 2 M q.x / |q|, so the nearest rows are those of largest inner
product, whatever the query's length, and the triangle inequality holds. A branch is
passed over if no point in it can be nearer than ``factor`` times the distance of the
query's k-th best so far. Factor 1, the default, is exact search for any vectors;
smaller factors prune more, and what they lose depends on the vectors.

Queries go in blocks of bounded size, each block to every shard by an equi-join
on the shard. Equal vectors of a shard are one point with a list of ids. Scores
are computed again in double precision from the original vectors, row by row, so
equal vectors have equal scores in every shard.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

K = 20
SHARD_ROWS = 16_384
QUERY_BLOCK = 512
LEAF = 1024
#: 1.0 is exact. A smaller factor that suits some vectors loses most neighbours of others.
FACTOR = 1.0
#: A band of at least LEAF rows ends where norms fall below this share of its largest.
BAND = 0.8
#: Rounding of distances, as a share of M, and of inner products, as a share of the largest possible.
_SLACK, _ROUNDING = 1e-7, 1e-12
SEED = 5


class VPTree:
    """Trees over points x' (rows of ``points``, already permuted so that a node is a run of rows), one for each band of norms."""

    def __init__(self, points: np.ndarray, ids: list[np.ndarray]):
        """``points``: by falling norm."""
        self.points, self.ids = points, ids
        norms = np.sqrt((points.astype(np.float64) ** 2).sum(axis=1))
        self.lift = np.zeros(len(points))
        #: (root, M) of each band, by falling M
        self.bands: list[tuple[int, float]] = []
        #: node: (first, last, vantage row, inner child, outer child, bounds of the children's distances)
        self.nodes: list[tuple] = []
        place = np.arange(len(points))
        rng = np.random.default_rng(SEED)
        first = 0
        while first < len(points):
            last = max(min(first + LEAF, len(points)), int(np.searchsorted(-norms, -BAND * norms[first], "right")))
            self.lift[first:last] = np.sqrt(np.maximum(norms[first] ** 2 - norms[first:last] ** 2, 0))
            self.bands.append((self._split(place, first, last, rng), float(norms[first])))
            first = last
        self.points, self.lift, self.ids = points[place], self.lift[place], [ids[i] for i in place]

    @classmethod
    def build(cls, vectors: np.ndarray, ids: np.ndarray) -> VPTree:
        points, of = np.unique(vectors, axis=0, return_inverse=True)
        order = np.lexsort((ids, of))
        cuts = np.flatnonzero(np.diff(of[order])) + 1
        ids = np.split(ids[order], cuts)
        falling = np.argsort(-(points.astype(np.float64) ** 2).sum(axis=1), kind="stable")
        return cls(points[falling], [ids[i] for i in falling])

    def _split(self, place: np.ndarray, first: int, last: int, rng) -> int:
        node = len(self.nodes)
        self.nodes.append(())
        if last - first <= LEAF:
            self.nodes[node] = (first, last, None, -1, -1, None)
            return node
        rows = place[first:last]
        vantage = rows[rng.integers(len(rows))]
        v, lift = self.points[vantage].astype(np.float64), self.lift[vantage]
        away = np.sqrt(((self.points[rows] - v) ** 2).sum(axis=1) + (self.lift[rows] - lift) ** 2)
        order = np.argsort(away, kind="stable")
        place[first:last], away = rows[order], away[order]
        half = len(rows) // 2
        bounds = (away[0], away[half - 1], away[half], away[-1])
        inner = self._split(place, first, first + half, rng)
        outer = self._split(place, first + half, last, rng)
        self.nodes[node] = (first, last, v, inner, outer, bounds)
        return node

    def search(self, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, int]:
        """(scores, looked at): inner products of queries and points, -inf where pruned or below the k-th best."""
        q = queries.astype(np.float64)
        length = np.maximum(np.sqrt((q ** 2).sum(axis=1)), 1e-300)
        points = self.points.astype(np.float64)
        scores = np.full((len(q), len(points)), -np.inf)
        best = np.full((len(q), k), -np.inf)
        seen = 0

        def visit(node: int, who: np.ndarray, reach: float) -> None:
            nonlocal seen
            if not len(who):
                return
            first, last, vantage, inner, outer, bounds = self.nodes[node]
            if vantage is None:
                got = q[who] @ points[first:last].T
                scores[who, first:last] = got
                seen += got.size
                both = np.concatenate([best[who], got], axis=1)
                best[who] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
                return
            away = np.sqrt(np.maximum(2 * reach * (reach - q[who] @ vantage / length[who]), 0))
            near = away <= (bounds[1] + bounds[2]) / 2
            visit(inner, who[near], reach)
            visit(outer, who[~near], reach)
            for child, lo, hi, rest in ((outer, bounds[2], bounds[3], near), (inner, bounds[0], bounds[1], ~near)):
                some, d = who[rest], away[rest]
                worst = best[some].min(axis=1)
                known = np.isfinite(worst)
                radius = np.sqrt(np.maximum(2 * reach * (reach - np.where(known, worst, 0) / length[some]), 0))
                radius = np.where(known, factor * radius + _SLACK * reach, np.inf)
                visit(child, some[(d - radius <= hi) & (d + radius >= lo)], reach)

        for root, reach in self.bands:  # no point of a band has a larger inner product than |q| M
            visit(root, np.flatnonzero(best.min(axis=1) <= length * reach * (1 + _ROUNDING)), reach)
        scores[scores < (best.min(axis=1) - _ROUNDING * length * self.bands[0][1])[:, None]] = -np.inf
        return scores, seen

    def nearest(self, queries: np.ndarray, own: np.ndarray, k: int, factor: float) -> Iterator[tuple[int, int, float]]:
        """(query, id, score) of the k best ids of each query, its own left out, ties to smaller ids."""
        most = min(k + 1, len(self.points))  # one of them may hold nothing but the query's own id
        scores, _ = self.search(queries, most, factor)
        row, point = np.nonzero(np.isfinite(scores))
        exact = (queries[row].astype(np.float64) * self.points[point].astype(np.float64)).sum(axis=1)
        found: dict[int, list[tuple[float, int]]] = {}
        for r, p, s in zip(row.tolist(), point.tolist(), exact.tolist(), strict=True):
            found.setdefault(r, []).extend((-s, int(i)) for i in self.ids[p][:k + 1] if i != own[r])
        for r, pairs in found.items():
            for s, i in sorted(pairs)[:k]:
                yield r, i, -s


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null or empty, all components finite, not all zero."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(good, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def nearest(rows: DataFrame, queries: DataFrame, k: int = K, factor: float = FACTOR, id_col: str = "vec_id",
            vector_col: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its ``k`` best rows found, all candidates if fewer.

    Candidates are all usable rows but those of the query's own id, with vectors
    of the query's length. Rows without an id are no candidates and no queries;
    of repeated ids with equal vectors one counts. Unusable vectors (null, empty,
    zero, with null or non-finite components) take no part. Empty tables give no
    rows; other columns are ignored.
    """
    def cleaned(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).filter(
            F.col("id").isNotNull() & usable(F.col("v"))).withColumn("dim", F.size("v"))

    points = written(cleaned(rows).distinct(), "vectors")
    asked = written(cleaned(queries).distinct(), "queries")
    n = points.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))
    m = asked.groupBy("dim").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("blocks"))
    sharded = points.join(F.broadcast(n), "dim").withColumn("shard", F.expr("CAST(pmod(xxhash64(id), shards) AS INT)"))  # a row per vector length

    def plant(key, part: pd.DataFrame) -> pd.DataFrame:
        tree = VPTree.build(np.stack(part["v"].to_numpy()), part["id"].to_numpy(np.int64))
        return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "tree": [pickle.dumps(tree)]})

    trees = written(sharded.groupBy("dim", "shard").applyInPandas(plant, "dim int, shard int, tree binary"), "trees")
    blocks = (asked.join(F.broadcast(m), "dim").withColumn("block", F.expr("CAST(pmod(xxhash64(id, 1), blocks) AS INT)"))
              .groupBy("dim", "block").agg(F.collect_list(F.struct("id", "v")).alias("asked"))
              .join(F.broadcast(n), "dim").withColumn("shard", F.explode(F.expr("sequence(0, shards - 1)"))))

    def look(part: pd.DataFrame) -> pd.DataFrame:
        tree = pickle.loads(part["tree"].iloc[0])
        own = np.array([a["id"] for a in part["asked"].iloc[0]], np.int64)
        vectors = np.stack([np.asarray(a["v"]) for a in part["asked"].iloc[0]])
        found = [(own[r], i, s) for r, i, s in tree.nearest(vectors, own, k, factor)]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    found = (blocks.select("dim", "shard", "block", "asked").join(trees, ["dim", "shard"])
             .groupBy("dim", "shard", "block").applyInPandas(look, "query_id long, vec_id long, score double"))
    found = found.dropDuplicates(["query_id", "vec_id", "score"])
    order = "row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)"
    return found.selectExpr("query_id", f"{order} AS rank", "vec_id", "score").filter(F.col("rank") <= k)


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return nearest(rows, rows.filter("vec_id % 20 = 0")).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
