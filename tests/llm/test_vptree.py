import random

import numpy as np

from sitesift.llm import vptree

ODD = [(None, [1.0] * 4), (500, None), (501, []), (502, [0.0] * 4), (503, [1.0, None, 1.0, 1.0]), (504, [float("nan"), 1.0, 1.0, 1.0]),
       (505, [float("inf"), 1.0, 1.0, 1.0]), (520, [1.0, 2.0]), (521, [2.0, 2.0]), (540, [9.0] * 5), (7, [3.0] * 4)]


def brute(rows, k=20):
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for i, q in good:
        if i % 20 == 0:
            near = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i and len(v) == len(q))
            out += [(i, n, j, -s) for n, (s, j) in enumerate(near[:k], 1)]
    return sorted(out)


def test_factor_one_is_exact(spark):
    r = random.Random(1)
    rows = [(i, [float(r.randrange(-3, 4)) for _ in range(4)]) for i in range(300)] + ODD + [(600 + i, [2.0] * 4) for i in range(100)] + [(600, [2.0] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = vptree.nearest(df, df.filter("vec_id % 20 = 0"), factor=1.0, shard_rows=100)
    assert sorted(tuple(x) for x in got.select("query_id", "rank", "vec_id", "score").collect()) == brute(rows)


def test_pruning_keeps_exact_results_at_one():
    r = np.random.default_rng(2)
    centres = r.normal(size=(12, 6)) * 8
    x = (centres[r.integers(12, size=9000)] + r.normal(size=(9000, 6))).astype(np.float32)
    tree = vptree.VPTree.build(x, np.arange(len(x)))
    q = x[:50]
    scores, seen = tree.search(q, 21, 1.0)
    assert seen < 0.95 * len(q) * len(x)
    want = np.sort(q.astype(float) @ x.astype(float).T, axis=1)[:, -21:]
    assert np.allclose(np.sort(scores, axis=1)[:, -21:], want)


def test_default_finds_all_whatever_the_norms():
    r = np.random.default_rng(4)
    unit = r.normal(size=(9000, 64))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    long = np.ones((len(unit), 1))
    long[0] = 5
    for x in (unit * long, unit * np.exp(0.3 * r.normal(size=long.shape)), unit * np.exp(5 * r.normal(size=long.shape))):
        x = x.astype(np.float32)
        q = np.concatenate([x[100:130], x[130:160] * np.float32(0.01), x[160:190] * np.float32(100)])
        scores, _ = vptree.VPTree.build(x, np.arange(len(x))).search(q, 21, vptree.FACTOR)
        want = np.sort(q.astype(float) @ x.astype(float).T, axis=1)[:, -21:]
        assert np.allclose(np.sort(scores, axis=1)[:, -21:], want)


def test_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r["embedding"] for r in rows], float)
    ids = np.array([r["vec_id"] for r in rows])
    got = {}
    for r in vptree.op3_neighbours(spark, sf).collect():
        got.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    hits = 0
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        s[i] = -np.inf
        best = np.argsort(-s, kind="stable")[:20]
        hits += sum(int(ids[j]) in got[ids[i]] for j in best)
        assert all(abs(got[ids[i]][int(ids[j])] - s[j]) < 1e-12 for j in best if int(ids[j]) in got[ids[i]])
    assert hits >= 0.9 * 20 * len(got)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vptree.nearest(df, df).count() == 0
