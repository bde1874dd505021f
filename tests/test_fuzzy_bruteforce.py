"""The segment join of term expansion equals brute force; a page of hits takes a group limit."""

import itertools
import random

import numpy as np

from sitesift.operators import search as SR


def lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def brute(terms, vocab):
    out = set()
    for t, m in terms:
        if len(t) <= 1.0 / (1.0 - m):
            if t in vocab:
                out.add((t, m, t, 1.0))
            continue
        for v in vocab:
            mn = min(len(t), len(v))
            k = int((1.0 - m) * mn)
            d = lev(t, v)
            if d <= k and np.float32(1.0) - np.float32(d / mn) > np.float32(m):
                out.add((t, m, v, round(((1.0 - d / mn) - m) / (1.0 - m), 6)))
    return out


def _frames(spark, terms, vocab):
    tdf = spark.createDataFrame([("content", v, 1) for v in vocab], "field string, term string, df long")
    return spark.createDataFrame([("content", t, m) for t, m in terms], "field string, term string, min_sim double"), tdf


def _expanded(spark, terms, vocab):
    return {(r["term"], r["min_sim"], r["vterm"], round(r["weight"], 6)) for r in SR.expand_terms(*_frames(spark, terms, vocab)).collect()}


def test_expansion_matches_brute_force(spark):
    rng = random.Random(7)
    alpha = "aeiourstnlé"
    vocab = sorted({"".join(rng.choice(alpha) for _ in range(rng.randint(1, 18))) for _ in range(600)})
    terms = [(rng.choice(vocab) if i % 2 else "".join(rng.choice(alpha) for _ in range(rng.randint(2, 17))), m)
             for i in range(40) for m in (0.5, 0.7)]
    assert _expanded(spark, terms, vocab) == brute(set(terms), vocab)


def test_expansion_of_long_terms_with_many_edits(spark):
    rng = random.Random(8)
    vocab = {"".join(rng.choice("abcd") for _ in range(rng.randint(1, 60))) for _ in range(120)}
    terms = []
    for v in sorted(vocab):  # edited copies, up to 30 edits
        t = list(v)
        for _ in range(rng.randint(0, max(1, len(v) // 2))):
            at = rng.randrange(len(t)) if t else 0
            t[at:at + rng.randint(0, 1)] = rng.choice([[], ["a"], ["b"]])
        terms.append(("".join(t) or "a", rng.choice([0.0, 0.3, 0.5, 0.7])))
    assert _expanded(spark, terms, sorted(vocab)) == brute(set(terms), sorted(vocab))


def test_no_match_is_dropped(spark):
    vocab = ["".join(p) for p in itertools.product("abcdefghijkl", repeat=4)][:2000]
    vocab = ["stem" + v for v in vocab]
    terms = [("stemabcd", 0.5)]
    got = _expanded(spark, terms, vocab)
    assert len(got) > 1024 and got == brute(set(terms), vocab)


def test_page_takes_a_group_limit(spark):
    hits = spark.range(100).selectExpr("id % 3 AS query_id", "cast(id AS string) AS path", "cast(id % 7 AS double) AS score")
    page = SR.rank_hits(hits, 2, 3)
    assert "WindowGroupLimit" in page._jdf.queryExecution().executedPlan().toString()
    whole = {(r["query_id"], r["position"]): r["path"] for r in SR.rank_hits(hits, None, None).collect()}
    assert {(r["query_id"], r["position"]): r["path"] for r in page.collect()} == {k: v for k, v in whole.items() if 2 <= k[1] < 5}
