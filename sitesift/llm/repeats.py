"""Operator 12: bytes covered by a string of ``LENGTH`` bytes that begins anywhere else too.

Suffixes are sorted with their common prefixes by external induced sorting
(`induced`), shard by shard. So that equal strings meet in one shard, texts are cut
by content: every window of ``LENGTH`` bytes has a value, the least hash of its
``GRAM``-byte strings, and neighbouring windows of one value form a piece. Equal
windows have equal values, so a piece whose value occurs only once repeats
nothing and is left out at once; the others are dealt to shards by value.

Layout: (1) values, a few bytes for every 150 bytes of text, are summed up by a
shuffle of two bounds for each value and task; (2) the runs whose value occurs twice
go back to one text of each group of equal texts, which is cut into pieces; (3) equal
pieces become one row before and in the shuffle, so a passage that a third of all
texts hold is one piece, and one whose value no other piece has is not sorted; (4) each shard, of about ``SHARD_BYTES``, is written to a
scratch file of the task and its suffixes are sorted in bounded memory, whatever the
shard's size: neighbours that share ``LENGTH`` bytes mark their windows; (5) the
marked windows go back to the texts by the pieces' checksums. Equal texts of that
length are covered as a whole. Scratch files hold nothing that another task reads.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget, table, written
from .induced import Scratch, Tape, sort_suffixes
from .words import _powers, mix

LENGTH = 400
GRAM = 100
#: Bytes of pieces in a shard, on average.
SHARD_BYTES = 2 << 20
#: Bytes that a sort keeps in memory for its queues and tapes.
SORT_MEMORY = 96 << 20
#: Bytes of text whose windows are handled at once.
SLAB_BYTES = 1 << 19


def window_values(data: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all grams, and the least of them in each window of ``length`` bytes."""
    a = np.frombuffer(data, np.uint8)
    up, down = _powers(1 << max(20, len(a).bit_length()))
    total = np.zeros(len(a) + 1, np.uint64)
    np.cumsum((a.astype(np.uint64) + np.uint64(1)) * up[:len(a)], out=total[1:])
    h = mix((total[gram:] - total[:-gram]) * down[:len(a) - gram + 1])
    wide = length - gram + 1
    rows = np.full(-(-len(h) // wide) * wide, ~np.uint64(0))
    rows[:len(h)] = h
    rows = rows.reshape(-1, wide)
    ahead = np.minimum.accumulate(rows, 1).ravel()  # least from the start of the block
    behind = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()  # least to the end of the block
    n = len(a) - length + 1
    return h, np.minimum(behind[:n], ahead[wide - 1:wide - 1 + n])


def _met_twice(hashes: np.ndarray, value: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Whether the value of a run is the hash of two or more of the grams first to last."""
    known, which = np.unique(value, return_inverse=True)
    at = np.flatnonzero(hashes <= known[-1])
    near = np.searchsorted(known, hashes[at])
    same = known[near] == hashes[at]
    place = np.sort(near[same] * len(hashes) + at[same])
    base = which * len(hashes)
    return np.searchsorted(place, base + last, "right") - np.searchsorted(place, base + first) > 1


def text_runs(texts: list[bytes], length: int, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, first window, windows, value, value met twice in it?) of runs of neighbouring windows of one value, slab by slab."""
    parts = [(i, a, t[a:a + SLAB_BYTES + length - 1]) for i, t in enumerate(texts) for a in range(0, max(0, len(t) - length + 1), SLAB_BYTES)]
    slab: list[tuple[int, int, bytes]] = []
    for k, part in enumerate(parts):
        slab.append(part)
        if k + 1 < len(parts) and sum(len(p[2]) for p in slab) < SLAB_BYTES:
            continue
        sizes = np.array([len(p[2]) for p in slab])
        begin = np.cumsum(sizes) - sizes
        hashes, values = window_values(b"".join(p[2] for p in slab), length, gram)
        owner = np.repeat(np.arange(len(slab)), sizes)[:len(values)]
        inside = np.arange(len(values)) <= (begin + sizes - length)[owner]
        at = np.flatnonzero(inside)
        new = np.r_[True, (values[at[1:]] != values[at[:-1]]) | (owner[at[1:]] != owner[at[:-1]])]
        first = at[new]
        count = np.diff(np.r_[np.flatnonzero(new), len(at)])
        own = owner[first]
        again = _met_twice(hashes, values[first], first, first + count - 1 + length - gram)
        yield (np.array([p[0] for p in slab])[own], first - begin[own] + np.array([p[1] for p in slab])[own], count, values[first].view(np.int64), again)
        slab = []


def repeated_windows(pieces: Iterator[bytes], length: int, scratch: Scratch) -> Iterator[tuple[int, int, int]]:
    """(piece, first window, windows) of the runs of windows that begin anywhere else in the pieces too."""
    tape, sizes, filed = bytearray(), [], None
    for piece in pieces:
        sizes.append(len(piece))
        tape += piece
        tape += b"\0"
        if len(tape) > scratch.memory // 4:  # large shards go to disk as they come
            filed = filed or scratch.path()
            with open(filed, "ab") as f:
                f.write(tape)
            tape.clear()
    size = np.array(sizes, np.int64)
    begin = np.cumsum(size + 1) - size - 1
    n = int((size + 1).sum())
    text = scratch.array(n + 1, np.uint16)  # 0 ends the text, 1 a piece, byte b is b + 2
    at = 0
    if filed:
        with open(filed, "rb") as f:
            while chunk := f.read(1 << 20):
                text[at:at + len(chunk)] = np.frombuffer(chunk, np.uint8)
                at += len(chunk)
    text[at:n] = np.frombuffer(tape, np.uint8)
    for a in range(0, n, 1 << 20):
        text[a:min(n, a + (1 << 20))] += 2
    text[begin + size] = 1
    found: Tape = sort_suffixes(text, 258, scratch, length)
    mark, before = scratch.array(n, bool), -1
    for rows in found.pieces():
        pos, alike = rows["pos"], np.flatnonzero(rows["lcp"] >= length)
        mark[pos[alike]] = True
        mark[np.r_[before, pos[:-1]][alike]] = True
        before = int(pos[-1])
    found.drop()
    for i in range(len(size)):
        here = mark[begin[i]:begin[i] + max(0, size[i] - length + 1)]
        if here.any():
            edge = np.flatnonzero(np.diff(np.r_[False, here, False]))
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                yield i, a, b - a


_SPANS = "array<struct<start:long,end:long>>"


def repeated_spans(docs: DataFrame, id_col: str, text_col: str, length: int = LENGTH, gram: int = GRAM,
                   shard_bytes: int = SHARD_BYTES, memory: int = SORT_MEMORY) -> DataFrame:
    """(key, spans): the maximal covered runs of bytes, [start, end), of each different text that has any.

    ``key`` is the text's MD5 as binary; a null text counts as empty.
    """
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), data.alias("data")).filter(F.octet_length("data") >= length).withColumn("key", F.unhex(F.md5("data")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in (whole.slice(a, 1000) for whole in batches for a in range(0, whole.num_rows, 1000)):
            texts, keys = batch.column("data").to_pylist(), batch.column("key")
            for text, start, count, value, again in text_runs(texts, length, gram):
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(text)), pa.array(start, pa.int64()), pa.array(count, pa.int64()), pa.array(value, pa.int64()), pa.array(again)],
                                                 names=["key", "start", "n", "value", "again"])

    texts = rows.groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.min(F.octet_length("data")).alias("size"))
    texts = written(texts, "texts")
    runs = written(rows.select("key", "data").mapInArrow(cut, "key binary, start long, n long, value long, again boolean"), "runs")
    apart = F.expr("a <> b OR c <> d").alias("apart")  # at two places: texts a and b, or starts c and d

    places = [F.min(F.xxhash64("key")).alias("a"), F.max(F.xxhash64("key")).alias("b"), F.min("start").alias("c"), F.max("start").alias("d")]
    twice = runs.groupBy("value").agg(*places, F.max("again").alias("again")).filter(apart | F.col("again")).select("value")
    # copies of a text give the same runs: one of each goes on
    asked = runs.join(twice, "value", "left_semi").distinct()
    asked = asked.groupBy("key").agg(F.collect_list(F.struct("start", "n", "value", "again")).alias("runs"))  # of one text
    asked = written(asked.join(texts.select("key", "id"), "key"), "asked")

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        names = ["key", "start", "value", "again", "piece"]
        for batch in batches:
            for data, key, some in zip(batch.column("data"), batch.column("key"), batch.column("runs")):
                text, some = data.as_buffer(), some.as_py()
                pieces = [text[r["start"]:r["start"] + r["n"] + length - 1].to_pybytes() for r in some]
                yield pa.RecordBatch.from_arrays([pa.array([key.as_py()] * len(some), pa.binary()), pa.array([r["start"] for r in some], pa.int64()),
                                                  pa.array([r["value"] for r in some], pa.int64()), pa.array([r["again"] for r in some], pa.bool_()),
                                                  pa.array(pieces, pa.binary())], names=names)

    # texts and runs meet by a sort merge at every size: the runs grow with the texts
    one = rows.join(asked.hint("merge"), (rows["key"] == asked["key"]) & rows["id"].eqNullSafe(asked["id"])).select(rows["key"], "data", "runs")
    pieces = written(one.mapInArrow(pick, "key binary, start long, value long, again boolean, piece binary"), "pieces")
    shared = pieces.groupBy("value", "piece").agg(*places, F.max("again").alias("again")).select("value", "piece", "again", apart.alias("twice"))
    total = pieces.agg(F.sum(F.octet_length("piece") + 1)).first()[0] or 0  # an upper bound of what the shards hold

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        sums, whole, sizes, sorted_ones = [], [], [], []

        def arriving():
            # pieces of one value come one after another; one that is alone repeats nothing but itself
            value, first = None, None
            for batch in batches:
                sums.extend(batch.column("sum").to_pylist())
                whole.extend(batch.column("twice").to_pylist())
                for v, again, piece in zip(batch.column("value").to_pylist(), batch.column("again").to_pylist(), batch.column("piece").to_pylist()):
                    at = len(sizes)
                    sizes.append(len(piece))
                    if v != value:
                        value, first = v, (at, piece)
                        if not again:
                            continue
                    if first is not None:
                        sorted_ones.append(first[0])
                        yield first[1]
                        if first[0] == at:
                            first = None
                            continue
                        first = None
                    sorted_ones.append(at)
                    yield piece

        with tempfile.TemporaryDirectory() as folder:
            last, spans = -1, []
            out: list[tuple[bytes, list]] = []
            for i, first, n in repeated_windows(arriving(), length, Scratch(folder, memory)):
                i = sorted_ones[i]
                if i != last and last >= 0:
                    if not whole[last]:
                        out.append((sums[last], spans))
                    spans = []
                last = i
                spans.append({"start": first, "end": first + n + length - 1})
            if last >= 0 and not whole[last]:
                out.append((sums[last], spans))
        out += [(s, [{"start": 0, "end": n}]) for s, w, n in zip(sums, whole, sizes) if w]
        for a in range(0, len(out), 10_000):
            some = out[a:a + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in some], pa.binary()), pa.array([x for _, x in some], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                                             names=["sum", "spans"])

    dealt = shared.withColumn("sum", F.unhex(F.md5("piece"))).repartition(max(1, -(-total // shard_bytes)), "value").sortWithinPartitions("value")
    dealt = dealt.select("value", "sum", "again", "twice", "piece")
    found = written(dealt.mapInArrow(sort, f"sum binary, spans {_SPANS}"), "spans")
    met = pieces.select("key", F.col("start").alias("at"), F.unhex(F.md5("piece")).alias("sum"))
    spans = (met.join(found, "sum").select("key", F.explode(F.transform("spans", lambda s: F.struct((s["start"] + F.col("at")).alias("start"), (s["end"] + F.col("at")).alias("end")))).alias("s"))
             .groupBy("key").agg(F.array_sort(F.collect_list("s")).alias("spans")))  # of one text
    # spans that touch or overlap become one
    merged = F.aggregate("spans", F.array().cast(_SPANS), lambda acc, s: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= s["start"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end")))),
    ).otherwise(F.concat(acc, F.array(s))))
    copied = texts.filter("copies > 1").select("key", F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("size").cast("long").alias("end"))).alias("spans"))
    single = spans.join(texts.filter("copies > 1"), "key", "left_anti").withColumn("spans", F.when(F.size("spans") > 1, merged).otherwise(F.col("spans")))
    return written(single.unionByName(copied), "covered")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                    shard_bytes: int = SHARD_BYTES, memory: int = SORT_MEMORY) -> DataFrame:
    """``docs`` without the text, with n_bytes, spans (removed bytes, [start, end)) and kept (the other bytes).

    Texts are UTF-8 bytes, a null text is empty; a string is never taken across
    texts. Texts under ``length`` bytes keep all. Every row of a repeated text of that length or more
    loses all of it, whatever its id. Other columns pass through; those named like
    a column made here give way. An empty table gives no rows.
    """
    made = ["n_bytes", "spans", "kept"]
    docs = docs.drop(*[c for c in docs.columns if c in made and c not in (id_col, text_col)])
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    spans = repeated_spans(docs, id_col, text_col, length, gram, shard_bytes, memory).withColumnsRenamed({"key": "_key", "spans": "_spans"})
    rows = docs.withColumn("kept", data).drop(text_col).withColumn("_key", F.unhex(F.md5("kept"))).withColumn("n_bytes", F.octet_length("kept").cast("long"))
    rows = rows.join(spans.hint("merge"), "_key", "left").withColumn("spans", F.coalesce("_spans", F.array().cast(_SPANS)))
    rest = [c for c in docs.columns if c != text_col]
    rows = rows.select(*rest, "n_bytes", "spans", "kept")
    schema = rows.schema

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        at = schema.names.index("kept")
        for batch in batches:
            kept = []
            for text, some in zip(batch.column("kept"), batch.column("spans")):
                if len(some):
                    edges = [0] + [x for s in some.as_py() for x in (s["start"], s["end"])]
                    text = text.as_buffer()
                    kept.append(b"".join(text[a:b].to_pybytes() for a, b in zip(edges[::2], edges[1::2] + [len(text)])))
                else:
                    kept.append(text.as_py())
            yield batch.set_column(at, batch.schema.field(at), pa.array(kept, batch.schema.field(at).type))

    return rows.mapInArrow(drop, schema)


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return kept.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
