import numpy as np
import pytest
from tokenizers import Tokenizer

from sitesift.llm import tokenbin
from sitesift.llm.common import shared_path


@pytest.mark.parametrize(("block", "plane"), [(1 << 16, "byte"), (500, "bit")])
def test_files_hold_every_document(spark, odd_docs, block, plane):
    path = shared_path(spark, "t")
    tokenbin.write_tokens(odd_docs, path, block_ids=block, plane=plane)
    lib = Tokenizer.from_file(tokenbin.tokenizer_path())
    want = []
    for r in odd_docs.collect():
        ids = [*lib.encode(r["text"] or "", add_special_tokens=False).ids, tokenbin.END_ID]
        want.append((str(r["doc_id"]), len(ids), np.array(ids, "<u4").tobytes()))
    got = sorted((r["start"], r["id"], r["n_tokens"], bytes(r["ids"])) for r in tokenbin.read_documents(spark, path).collect())
    assert sorted((str(i), n, x) for _, i, n, x in got) == sorted(want)
    at = 0
    for start, _, n, _ in got:
        assert start == at
        at += n
    order = [(i is not None, i or 0) for _, i, *_ in got]
    assert order == sorted(order)
    index = spark.read.parquet(f"{path}/index")
    assert index.agg({"n_ids": "sum"}).first()[0] == at
    assert {len(r["plane_bytes"]) for r in index.collect()} == {4 if plane == "byte" else 32}


def test_planes_round_trip():
    ids = np.random.default_rng(1).integers(0, 1 << 32, 1001, dtype=np.uint64).astype("<u4")
    for plane in ("byte", "bit"):
        for n in (0, 1, 7, 8, 1001):
            assert (tokenbin.from_planes(tokenbin.to_planes(ids[:n], plane), n, plane) == ids[:n]).all()


def test_empty_table(spark, odd_docs):
    path = shared_path(spark, "t")
    tokenbin.write_tokens(odd_docs.limit(0), path)
    assert tokenbin.read_documents(spark, path).count() == 0


def test_words_alone_are_the_text():
    texts = ["don't STOP  <|endoftext|> now", "Ünïcodé ΣΑΣ x\x1cy 　z 12a3 'll", "ﬁ ǅ İstanbul", "Word, WORD... (x) a_b _ ÀÉÎ! ß? ſ ŉ Ǆ ÿ: it's É\u0301 e\u0301 A\u030a. ʰa", "STRASSE;ÆØÅ"]
    texts += [chr(c) + "a " + chr(c).upper() + "." for c in range(0xA1, 0x24F)]
    lib = Tokenizer.from_file(tokenbin.tokenizer_path())
    got = tokenbin.WordEncoder(tokenbin.tokenizer_path()).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [lib.encode(t, add_special_tokens=False).ids for t in texts]
