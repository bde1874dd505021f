import random

import numpy as np
import tiktoken

from sitesift.llm import bpe


def library():
    import public_tokenizers as P

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(bpe.vocabulary_path()), special_tokens={})


def test_replay_equals_library():
    r = random.Random(1)
    signs = "ab '\n\t   　é1\x1c ßstΣ.!?漢字́😀Ⅷ٣"
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 60))) for _ in range(2000)]
    texts += ["", "   ", " ", "a" * 5000, "ab" * 3000, "\n\n a  b", "don't  we'll\n"]
    lib = library()
    assert [np.frombuffer(x, "<u4").tolist() for x in bpe.Encoder(bpe.vocabulary_path()).encode(texts)] == [lib.encode_ordinary(t) for t in texts]


def test_merges_of_many_words_at_once(monkeypatch):
    monkeypatch.setattr(bpe, "MANY", 1)
    r = random.Random(2)
    lib, replay = library(), bpe.MergeReplay(bpe.load_ranks(bpe.vocabulary_path()))
    words = {"".join(r.choice(s) for _ in range(r.randint(1, 40))) for s in ("ab", "a", "aé漢😀", "thehin", "abcdefghijklmnopqrstuvwxyz") for _ in range(3000)}
    words |= {"a" * n for n in range(1, 200)} | {"ab" * n for n in range(1, 100)} | {"aba" * n for n in range(1, 100)}
    raw = [w.encode() for w in sorted(words)]
    got = replay.encode_all(raw)
    assert got == [np.array(ids, "<u4").tobytes() for ids in replay.encode(raw)]
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [lib._encode_single_piece(w) for w in raw]
    assert replay.encode_all([]) == [] and replay.encode_all([b""]) == [b""]


def test_words_that_went_are_merged_again(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 8)
    enc, lib = bpe.Encoder(bpe.vocabulary_path()), library()
    texts = [f"some words {i} and others {i * i}" for i in range(50)]
    for t in texts + texts:
        assert np.frombuffer(enc.encode([t])[0], "<u4").tolist() == lib.encode_ordinary(t)


def test_round_trip_and_odd_rows(spark, odd_docs):
    rows = bpe.decode_documents(bpe.encode_documents(odd_docs)).collect()
    assert len(rows) == odd_docs.count()
    lib = library()
    for r in rows:
        assert bytes(r["decoded"]).decode() == (r["text"] or "") and r["pos"] == "extra"
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == lib.encode_ordinary(r["text"] or "")
        assert r["n_tokens"] * 4 == len(r["ids"])
    assert bpe.encode_documents(odd_docs.limit(0)).count() == 0
    both = bpe.round_trip(odd_docs)
    assert "text" not in both.columns
    assert sorted((bytes(r["ids"]), bytes(r["decoded"])) for r in both.collect()) == sorted((bytes(r["ids"]), bytes(r["decoded"])) for r in rows)
    small = bpe.round_trip(odd_docs, chars=10, most=2)
    assert sorted(bytes(r["ids"]) for r in small.collect()) == sorted(bytes(r["ids"]) for r in rows)
    clash = odd_docs.withColumnRenamed("pos", "ids")
    assert bpe.encode_documents(clash).columns.count("ids") == 1
