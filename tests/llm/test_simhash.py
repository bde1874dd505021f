import itertools
import random

import numpy as np
import xxhash

from sitesift.llm import simhash


def brute_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(prints):
    prints = sorted(set(prints))
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p
    for a, b in itertools.combinations(prints, 2):
        if (a ^ b).bit_count() <= 3:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {p: find(p) for p in prints}


def test_every_pair_within_the_radius_meets():
    masks = simhash.covering_masks()
    for bits in itertools.combinations(range(64), 3):
        assert any(not any(m >> b & 1 for b in bits) for m in masks)
    levels = simhash._levels()
    assert max(64 - m.bit_count() for ms in levels[-1].values() for m in ms) <= 8
    for above, below in list(levels[1].items()) + list(levels[2].items())[::30]:
        free = [b for b in range(64) if not above >> b & 1]
        for bits in itertools.combinations(free, 3):
            assert any(not any(m >> b & 1 for b in bits) for m in below)


def test_fingerprints(odd_docs):
    texts = [r["text"] for r in odd_docs.collect()]
    assert [simhash.fingerprint(t) for t in texts] == [brute_print(t) for t in texts]


def test_links_keep_components(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 16)  # so that buckets are covered again, down to the last level
    r = random.Random(2)
    prints = [r.getrandbits(64) for _ in range(200)]
    for _ in range(600):  # chains and crowds around some of them
        p = r.choice(prints[-50:] if r.random() < 0.5 else prints[:5])
        for _ in range(r.randint(0, 5)):
            p ^= 1 << r.randrange(64)
        prints.append(p)
    prints = sorted(set(prints))
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(i, p) for i, p in enumerate(signed)], "id long, fp long")
    got = {r["id"]: r["component_id"] for r in simhash.from_prints(df).collect()}
    roots = brute_roots(prints)
    least = {}
    for i, p in enumerate(prints):
        least[roots[p]] = min(i, least.get(roots[p], i))
    assert got == {i: least[roots[p]] for i, p in enumerate(prints)}


def test_odd_rows_and_keep_one(spark, odd_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    docs = odd_docs.collect()
    assert len(rows) == len(docs)
    roots = brute_roots([brute_print(r["text"]) for r in docs])
    least = {}
    for r in docs:
        if r["doc_id"] is not None:
            root = roots[brute_print(r["text"])]
            least[root] = min(r["doc_id"], least.get(root, r["doc_id"]))
    want = sorted(((r["doc_id"], least.get(roots[brute_print(r["text"])])) for r in docs), key=str)
    assert sorted(((r["id"], r["component_id"]) for r in rows), key=str) == want
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    no_id = {roots[brute_print(r["text"])] for r in docs} - set(least)
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([*least.values(), *[None] * len(no_id)], key=str)
    assert simhash.near_duplicates(odd_docs.limit(0)).count() == 0 and simhash.keep_one(odd_docs.limit(0)).count() == 0
