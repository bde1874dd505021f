import math
import zlib
from collections import Counter

import numpy as np
import pytest

from sitesift.llm import pitman_yor as H

SF = "/root/testdata/sf0.001"


def words(text):
    return [*(text or "").encode().lower().split(), None]


def check_counts(rows, docs):
    held = [r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 for r in docs]
    count = Counter(w for r, h in zip(docs, held) if not h for w in words(r["text"]))
    n, v = sum(count.values()), len(count)
    want = []
    for r, h in zip(docs, held):
        ws = words(r["text"])
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        want.append((str(r["doc_id"]), h, len(ws), sum(count[w] > 0 for w in ws), n, round(base, 5)))
    got = [(str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in rows]
    assert sorted(got) == sorted(want)


def test_counts_and_better_than_base(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = H.score_documents(docs).collect()
    check_counts(rows, docs.collect())
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    again = {r["doc_id"]: r["score"] for r in H.score_documents(docs.repartition(3)).collect()}
    assert all(abs(again[r["doc_id"]] - r["score"]) < 0.02 * abs(r["score"]) for r in rows)


def test_odd_rows(spark, odd_docs):
    check_counts(H.score_documents(odd_docs).collect(), odd_docs.collect())
    assert H.score_documents(odd_docs.limit(0)).count() == 0


def test_slabs_and_parts_do_not_matter(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    monkeypatch.setattr(H, "PARTS_PER_PARTITION", 9)
    whole = {r["doc_id"]: r["score"] for r in H.score_documents(docs).collect()}
    for r in H.score_documents(docs.repartition(5)).collect():
        assert abs(whole[r["doc_id"]] - r["score"]) < 1e-6 * abs(r["score"])


@pytest.mark.parametrize("customers", [2, 7, 40, 400])
def test_seating_follows_the_restaurant(customers):
    """The mean number of tables of one dish, all of whose customers are alone in the restaurant, is known exactly."""
    strength, discount = 2.0, 0.5
    n = 20000
    got = H.seat(np.full(n, customers), np.full(n, strength), np.full(n, discount), discount, H.mix(np.arange(n, dtype=np.uint64))).mean()
    rise = np.prod([(strength + discount + i) / (strength + i) for i in range(customers)])
    assert abs(got - strength / discount * (rise - 1)) < 0.03 * got


def test_probabilities_sum_to_one(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(["a b a c", "b a d", "c c c a"] * 5)], "doc_id long, text string")
    parts = 3
    docs = rows.selectExpr("doc_id", "text", "false AS held_out")
    kept = H.written(H.state(H.packets(docs, np.zeros(0, np.uint64), parts)), "parts", compression="none").filter("part >= 0")
    model = H.learn(kept, np.zeros(0, np.uint64))
    assert model.words == 5 and model.tokens == 70
    total = 0.0
    s = len(model.sweeps) - 1
    for row in kept.collect():
        p = H.Part.read(row.asDict(), model)
        *_, tables = p.sweeps(s)
        total += model.parent(p.word_tables(tables, s), p.word, s).sum()
    unknown = model.parent(np.zeros(1, np.int64), np.array([12345], np.uint64), s)[0]
    assert abs(total + unknown - 1) < 1e-9


def test_more_words_than_a_packed_key_holds(spark):
    r = np.random.default_rng(1)
    part, at, context, doc = (r.integers(n, size=5000) for n in (3, 9, 4, 2))
    many = H._counted(part, at + (1 << 22), context, doc)
    few = H._counted(part, at, context, doc)
    assert all(np.array_equal(a, b + ((1 << 22) if i == 1 else 0)) for i, (a, b) in enumerate(zip(many, few)))
    n = (1 << 21) + 50_000
    text = " ".join(f"{i:x}" for i in range(n)) + " 0 1"
    docs = spark.createDataFrame([(1, text), (2, "0 1 zz")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in H.score_documents(docs).collect()}
    tokens, known = n + 2 + 1 + 4, n + 2  # all the words, zz, the ends
    weight = lambda c: math.log10((c + 0.1) / (tokens + 0.1 * (known + 1)))
    assert got[1]["n_tokens"] == n + 3 and got[1]["train_tokens"] == tokens
    assert got[1]["base_score"] == pytest.approx((n - 2) * weight(1) + 4 * weight(3) + weight(2), rel=1e-9)
