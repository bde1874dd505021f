import hashlib
import re

import numpy as np
import tiktoken

import corpus_pipeline as C
from sitesift.llm import bpe
from tests.llm.test_decontaminate import distance
from tests.llm.test_pii import PATTERNS
from tests.llm.test_simhash import brute_print, brute_roots

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    import public_tokenizers as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {0: docs}
    for i, (_, stage) in enumerate(C.STAGES):
        kept[i + 1] = C.written(stage(spark, kept[i], SF), "s")
        assert i == len(C.STAGES) - 1 or kept[i + 1].columns == docs.columns
    rows = {i: {r["doc_id"]: r for r in df.collect()} for i, df in kept.items()}
    assert set(rows[1]) == set(rows[0])  # all are prose in a known language
    prints = {d: brute_print(r["text"]) for d, r in rows[1].items()}
    roots = brute_roots(prints.values())
    least = {}
    for d, p in prints.items():
        least[roots[p]] = min(d, least.get(roots[p], d))
    assert set(rows[2]) == set(least.values())
    bench = [re.findall(r"\w+", r["text"].lower()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for d, r in rows[2].items():
        ws = re.findall(r"\w+", r["text"].lower())
        assert (d in rows[3]) == all(distance(b, ws) > 0.2 * len(b) for b in bench)
    for d, r in rows[4].items():
        assert not re.search(PATTERNS["email"], r["text"]) and r["n_chars"] == len(r["text"])
        if not re.search("[0-9@]", rows[3][d]["text"]):
            assert r["text"] == rows[3][d]["text"]
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(bpe.vocabulary_path()), special_tokens={})
    assert set(rows[5]) == set(rows[4])
    for d, r in rows[5].items():
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == lib.encode_ordinary(rows[4][d]["text"])
        assert r["decoded_sha256"] == hashlib.sha256(rows[4][d]["text"].encode()).hexdigest()
    assert {r["doc_id"]: r["n_tokens"] for r in C.run(spark, SF).collect()} == {d: r["n_tokens"] for d, r in rows[5].items()}


def test_odd_rows_go_through(spark, odd_docs, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(odd_docs.drop("pos"))
    for _, stage in C.STAGES:
        docs = C.written(stage(spark, docs, SF), "s")
    assert docs.count() > 0
    none = odd_docs.limit(0)
    for _, stage in C.STAGES:
        none = C.written(stage(spark, none, SF), "s")
    assert none.count() == 0


def test_own_columns_of_the_stages_names_stay(spark):
    names = ["language", "probability", "text_language", "accepted", "fingerprint", "component_id", "spans", "ids", "n_tokens", "key", "id", "text_crc32"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.selectExpr("*", *[f"concat('mine ', doc_id, ' {n}') AS {n}" for n in names])
    for _, stage in C.STAGES[:-1]:
        docs = C.written(stage(spark, docs, SF), "s")
        assert docs.columns[-len(names):] == names
    rows = docs.collect()
    assert rows and all(r[n] == f"mine {r['doc_id']} {n}" for r in rows for n in names)
    assert C.STAGES[-1][1](spark, docs, SF).count() == len(rows)
