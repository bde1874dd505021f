import math
import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

from sitesift.llm import hardneg

SF = "/root/testdata/sf0.1"
ODD = [(None, [1.0] * 4, 1), (500, None, 1), (501, [], 1), (600, [], 1), (601, [], 2), (502, [0.0] * 4, 2), (503, [1.0, None, 1.0, 1.0], 1), (504, [float("nan"), 1.0, 1.0, 1.0], 1),
       (505, [float("-inf"), 1.0, 1.0, 1.0], 1), (300, [1.0, 2.0], 1), (521, [2.0, 2.0], 1), (522, [2.0, 1.9], 2), (10, [3.0] * 4, None), (7, [3.0] * 4, 0)]


def brute(rows, every, scale=256, k=5):
    good = {(i, tuple(v), lab) for i, v, lab in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    good = [(i, [math.floor(scale * x) for x in v], lab) for i, v, lab in good]
    out = []
    for i, a, lab in good:
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, v)), j, m == lab) for j, v, m in good if j != i and len(v) == len(a))
        for p, j, _ in [s for s in scored if s[2]][:k]:
            p = -p
            near = [(j2, -s) for s, j2, alike in scored if not alike and 80 * p <= -100 * s <= 100 * p]
            out += [(i, j, n, j2, p, s) for n, (j2, s) in enumerate(near[:k], 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_is_brute_force(spark, monkeypatch):
    r = random.Random(1)
    centres = [[r.gauss(0, 1) for _ in range(4)] for _ in range(5)]
    rows = [(i, [x + r.gauss(0, 0.2) for x in centres[i % 5]], r.randrange(4) if i % 3 else i % 5) for i in range(700)]
    rows += ODD + [(1000 + i, [1.0, 0.5, 0.25, 0.0], i % 2) for i in range(60)] + rows[:20] + [(20, [9.0] * 4, 1), (20, [9.0] * 4, 2)]
    df = spark.createDataFrame([(*x, "extra", 1) for x in rows], "vec_id long, embedding array<float>, label int, at string, block int")
    rows = [tuple(x)[:3] for x in df.collect()]  # floats as stored
    want = brute(rows, 10)
    assert want and found(hardneg.mine(df, F.col("vec_id") % 10 == 0)) == want
    assert found(hardneg.mine(df, F.col("vec_id") % 10 == 0, block_bytes=3000)) == want
    assert hardneg.mine(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert hardneg.mine(df, F.lit(None).cast("boolean")).count() == 0


def test_large_components_are_exact(spark):
    r = random.Random(2)
    rows = [(i, [r.randrange(-9, 10) * 1e8 + r.randrange(5) for _ in range(3)], i % 2) for i in range(80)]
    rows += [(100 + i, [3.0e8, 1.0e8, float(i % 3)], i % 2) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = brute(rows, 5, 1)
    assert found(hardneg.mine(df, F.col("vec_id") % 5 == 0, scale=1)) == want and max(y[4] for y in want) > 2**53


def test_bounds_leave_rows_out():
    r = np.random.default_rng(5)
    centres = r.normal(size=(6, 8)) * 1000
    near = lambda n: np.floor(centres[r.integers(6, size=n)] + r.normal(size=(n, 8)) * 20)
    anchors, rows = near(120), near(3000)
    tree = hardneg.SpanningTree(anchors)
    assert sum(len(n) for n, _, _ in tree.levels) == len(anchors)
    exact = anchors @ rows.T
    low = np.sort(exact, axis=1)[:, -50]
    node, row, score, scored = tree.scores(rows, np.linalg.norm(rows, axis=1), low, np.full(120, np.inf), np.ones(exact.shape, bool))
    want = {(i, j) for i, j in zip(*np.nonzero(exact >= low[:, None]))}
    assert set(zip(node.tolist(), row.tolist())) == want and np.array_equal(score, exact[node, row])
    assert scored < 0.9 * exact.size


def test_query_is_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    rel = con.sql(hardneg.OP11_SQL)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert rel.columns == names and sorted(rel.fetchall()) == found(hardneg.op11_hard_negatives(spark, SF))
