import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from sitesift.llm import importance

SF = "/root/testdata/sf0.001"


def runs(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(words), [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(docs, target, buckets=10000):
    """{(id, n_features, weight, score, rank): times} by the contract, one run at a time."""
    place = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(place(f) for _, t in docs for f in runs(t)[1])
    t = Counter(place(f) for x in target for f in runs(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (S + buckets) / ((s[b] + 1.0) * (T + buckets)))) for b in range(buckets)]
    rows = []
    for i, text in docs:
        n, f = runs(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[place(x)] for x in f)
        rows.append([i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    fit = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], -1 if r[0] is None else r[0], r[1]))
    for k, r in enumerate(fit[:5 * len(fit) // 100], 1):
        r[4] = k
    return Counter(map(tuple, rows))


def test_query_is_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"], r["n_words"]) for r in importance.op13_importance(spark, SF).collect())
    assert got == brute(docs, target) and sum(k[4] is not None for k in got) > 5


def test_odd_rows(spark, odd_docs):
    target = spark.createDataFrame([("the river",), (None,), ("",), ("house of the river",)], "text string")
    docs = odd_docs.withColumnRenamed("pos", "rank").withColumnRenamed("n_chars", "weight")
    got = importance.resample(docs, target)
    assert set(got.columns) == {"doc_id", "lang", "source", "n_words", "n_features", "weight", "score", "rank"}
    rows = Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"], r["n_words"]) for r in got.collect())
    assert rows == brute([(r["doc_id"], r["text"]) for r in odd_docs.collect()], ["the river", None, "", "house of the river"])
    assert importance.resample(odd_docs.limit(0), target).count() == 0
    assert importance.resample(odd_docs, target.limit(0)).count() == odd_docs.count()


def test_hot_ties_are_all_ranked(spark):
    text = " ".join(["same"] * 30)
    docs = spark.createDataFrame([(7, text)] * 400 + [(8, text)] * 100, "doc_id long, text string")
    got = [r for r in importance.resample(docs, docs.limit(1)).collect() if r["rank"] is not None]
    assert sorted(r["rank"] for r in got) == list(range(1, 26))


def test_long_words_and_long_texts(monkeypatch):
    r = random.Random(3)
    words = [bytes(r.choice(b"abcxyz019") for _ in range(n)) for n in (1, 2, 255, 256, 257, 511, 512, 513, 3000, 70000)] + [b"\xc3\xa9" * 40]
    text = b" ".join(words * 3)
    want = [zlib.crc32(b" ".join((words * 3)[i:i + n])) % 10000 for n in (1, 2, 3) for i in range(len(words) * 3 - n + 1)]
    n, got = importance.text_buckets([text], 10000)[0]
    assert n == len(words) * 3 and got.tolist() == want
    monkeypatch.setattr(importance, "SLAB_BYTES", 700)
    texts = [text, b"", b"a b", b" ".join(r.choice([b"a", b"bc", b"d,e"]) for _ in range(2000)), b"--", text[:5000]]
    for t, (n, got) in zip(texts, importance.text_buckets(texts, 10000)):
        count, f = runs(t.decode())
        assert n == count and Counter(got.tolist()) == Counter(zlib.crc32(x.encode()) % 10000 for x in f)


def test_wide_buckets():
    texts = [b"one two three four"]
    _, got = importance.text_buckets(texts, 1 << 20)[0]
    assert got.dtype == np.uint32 and got[0] == zlib.crc32(b"one") % (1 << 20)
