import zlib
from collections import Counter

from sitesift.llm.sharding import interleave, op1_sharding

SF = "/root/testdata/sf0.001"


def test_law_slots_and_mixture(spark):
    rows = op1_sharding(spark, SF).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))
    for r in rows:
        text = docs[r["doc_id"]]["text"].encode()
        assert r["size"] == len(text) + 1 and r["text_crc32"] == zlib.crc32(text) and r["law"] == "rows" and r["grown_shard"] is None
    per = Counter((r["source"], r["shard"]) for r in rows)
    whole = Counter(r["source"] for r in rows)
    for source, n in whole.items():
        assert all(abs(per[source, s] - n / 8) <= 1 for s in range(8))


def test_shuffled_and_repeatable(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a = {r["id"]: (r["shard"], r["slot"]) for r in interleave(docs).collect()}
    assert a == {r["id"]: (r["shard"], r["slot"]) for r in interleave(docs.repartition(7)).collect()}
    assert a != {r["id"]: (r["shard"], r["slot"]) for r in interleave(docs, seed=1).collect()}


def test_odd_rows(spark, odd_docs):
    rows = interleave(odd_docs, n_shards=3).collect()
    assert len(rows) == odd_docs.count()
    assert {r["size"] for r in rows if r["id"] in (100, 101)} == {1}
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert interleave(odd_docs.limit(0)).count() == 0
