import hashlib
import random
import tempfile
from collections import Counter

import numpy as np
import pytest

from sitesift.llm import induced, repeats

SF = "/root/testdata/sf0.001"


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, kept bytes) of each text, by counting every string."""
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        out.append((len(t), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), bytes(np.frombuffer(t, np.uint8)[~gone[:-1]])))
    return out


def sorted_brute(text, cap):
    t = text.tolist()
    order = sorted(range(len(t) - 1), key=lambda i: t[i:], reverse=True)
    common = [0] * len(order)
    for k in range(1, len(order)):
        a, b = order[k - 1], order[k]
        while common[k] < cap and t[a + common[k]] == t[b + common[k]]:
            common[k] += 1
    return order, common


def induced_rows(text, sigma, cap, memory):
    with tempfile.TemporaryDirectory() as folder:
        rows = [np.zeros(0, induced._ROW), *induced.sort_suffixes(text, sigma, induced.Scratch(folder, memory), cap).pieces()]
    return np.concatenate(rows)["pos"].tolist(), np.concatenate(rows)["lcp"].tolist()


@pytest.mark.parametrize("small", [False, True])
def test_induced_order_and_prefixes(monkeypatch, small):
    if small:  # many batches, ranges and files; recursion on disk to the end
        for name, value in (("_LEAST", 2), ("_MOST", 8), ("_CHUNK", 7), ("_RANGES", 4)):
            monkeypatch.setattr(induced, name, value)
    r = random.Random(7)
    for _ in range(400):
        n, sigma = r.randrange(60), r.choice([1, 2, 3, 5, 30])
        x = [1 + r.randrange(sigma) for _ in range(n)]
        if r.random() < 0.4:
            x = (x[:r.randrange(1, 8)] * 60)[:n]
        text = np.array(x + [0])
        memory = r.choice([1 << 20, 200])
        assert induced_rows(text, sigma + 1, 100, memory) == sorted_brute(text, 100)
        cap = r.randrange(1, 6)
        pos, lcp = induced_rows(text, sigma + 1, cap, memory)
        heads = [x[i:i + cap] + [0] for i in pos]
        assert sorted(pos) == list(range(n)) and all(a[:cap] >= b[:cap] for a, b in zip(heads, heads[1:]))
        for a, b, c in zip(pos, pos[1:], lcp[1:]):
            assert x[a:a + c] == x[b:b + c] and (c == cap or x[a + c:a + c + 1] != x[b + c:b + c + 1])


def test_long_runs_and_periods():
    for x in ([1] * 3000, [1, 2] * 1500, [3, 1, 1, 2] * 700, list(range(1, 1500)), list(range(1500, 0, -1))):
        text = np.array(x + [0])
        pos, lcp = induced_rows(text, max(x) + 1, 50, 1 << 14)
        assert sorted(pos) == list(range(len(x)))
        for a, b, c in zip(pos, pos[1:], lcp[1:]):
            assert x[a:a + c] == x[b:b + c] and (c == 50 or x[a + c:a + c + 1] != x[b + c:b + c + 1])


def test_values_are_the_least_of_the_window(monkeypatch):
    monkeypatch.setattr(repeats, "SLAB_BYTES", 64)
    r = random.Random(2)
    texts = [bytes(r.choice(b"ab") for _ in range(n)) for n in (0, 5, 11, 12, 13, 40, 200, 500)] + [b"a" * 300]
    runs = {(int(i), int(a) + j): int(v) for i, first, n, value, _ in zip(*(np.concatenate(x) for x in zip(*repeats.text_runs(texts, 12, 4)))) for a, v in [(first, value)] for j in range(int(n))}
    assert set(runs) == {(i, a) for i, t in enumerate(texts) for a in range(len(t) - 11)}
    by_content = {}
    for (i, a), v in runs.items():
        assert by_content.setdefault(texts[i][a:a + 12], v) == v


def rows_of(df):
    return Counter((r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), bytes(r["kept"])) for r in df.collect())


def test_is_brute_force_on_short_strings(spark):
    r = random.Random(3)
    word = lambda: r.choice(["river", "house", "über", "été", "😀", "a", "of the"])
    passage = [" ".join(word() for _ in range(12)) for _ in range(6)]
    texts = [" ".join(word() if r.random() < 0.7 else r.choice(passage) for _ in range(r.randrange(60))) for _ in range(150)]
    texts += [None, "", "x", "ab" * 100, "b" * 90, "b" * 39, "b" * 40, texts[0], texts[0], texts[1], "q" + texts[2]]
    docs = spark.createDataFrame([(None if i % 9 == 0 else i % 50, t, i, "extra") for i, t in enumerate(texts)], "doc_id long, text string, key int, spans string").repartition(5)
    want = Counter(brute(texts, 40))
    got = repeats.without_repeats(docs, length=40, gram=10)
    assert got.columns == ["doc_id", "key", "n_bytes", "spans", "kept"] and rows_of(got) == want
    assert rows_of(repeats.without_repeats(docs, length=40, gram=10, shard_bytes=500, memory=2000)) == want
    assert repeats.without_repeats(docs.limit(0), length=40, gram=10).count() == 0


def test_query_is_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {d["doc_id"]: (a, b, c, hashlib.sha256(k).hexdigest()) for d, (a, b, c, k) in zip(docs, brute([d["text"] for d in docs], 400))}
    got = {r["doc_id"]: tuple(r)[1:] for r in repeats.op12_repeats(spark, SF).collect()}
    assert got == want and sum(x[1] > 0 for x in want.values()) > 5


def test_odd_rows(spark, odd_docs):
    texts = [r["text"] for r in odd_docs.collect()]
    assert rows_of(repeats.without_repeats(odd_docs, length=20, gram=8)) == Counter(brute(texts, 20))
