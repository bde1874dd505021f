"""Operator 5: token ids in a binary format of compressed byte or bit planes.

Documents are put in the order of their ids by range partitioning; each
partition is one file (numbered in that order) of a stream of ids, cut into
blocks of a fixed number of ids. A block is transposed, so that the lowest bytes
(or bits) of all its ids stand together, then the next ones, and each of these
planes is compressed with zstandard. Blocks lie in an uncompressed Parquet table,
so they are written and read through Spark's own file systems; beside it lies the
chunk index: for each block its file, place, ids and the size of each plane.

The tokenizer splits at white space, so a task encodes each distinct word once
and puts documents together from their words' ids. A task holds one block and one
slab of texts at a time. Nothing but the texts is shuffled, once.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .bpe import ID, KEPT_WORDS, Kept
from .common import keep, shared_path, shuffle_parts, slabs, table, texts_of

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
BLOCK_IDS = 1 << 16
LEVEL = 3

BLOCK_SCHEMA = """file long, block long, first long, n_ids long, open long, plane string, planes array<binary>, crc32 long,
 docs array<struct<id: long, start: long, n_tokens: long>>"""


def to_planes(ids: np.ndarray, plane: str = "byte") -> list[bytes]:
    """The ids' bytes (4 planes) or bits (32 planes), lowest first, each compressed."""
    import zstandard

    cells = np.ascontiguousarray(ids, ID).view(np.uint8).reshape(-1, ID.itemsize)
    if plane == "bit":
        rows = np.packbits(np.unpackbits(cells, axis=1, bitorder="little").T, axis=1, bitorder="little")
    else:
        rows = np.ascontiguousarray(cells.T)
    squeeze = zstandard.ZstdCompressor(level=LEVEL)
    return [squeeze.compress(r.tobytes()) for r in rows]


def from_planes(planes: list[bytes], n_ids: int, plane: str = "byte") -> np.ndarray:
    import zstandard

    if not n_ids:
        return np.zeros(0, ID)
    rows = np.stack([np.frombuffer(zstandard.ZstdDecompressor().decompress(p), np.uint8) for p in planes])
    if plane == "bit":
        cells = np.packbits(np.unpackbits(rows, axis=1, count=n_ids, bitorder="little").T, axis=1, bitorder="little")
    else:
        cells = np.ascontiguousarray(rows.T)
    return np.ascontiguousarray(cells).view(ID).ravel()


#: Texts of ASCII and composed Latin letters (to U+017F but U+0130, whose lower case is two signs): normal form and lower case are plain here.
_PLAIN = re.compile(r"[\x00-\x7F\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u017F]*").fullmatch
#: Fixed value: the tokenizer's own split, with its classes of letters, digits and white space within such texts.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00DF-\u00F6\u00F8-\u017F]+|[0-9]|[^\s0-9a-z\u00DF-\u00F6\u00F8-\u017F]+", re.ASCII).findall


class WordEncoder:
    """Encodes texts by the tokenizer, each distinct piece or word once; keeps them up to a bound.

    The tokenizer lower-cases, splits into pieces, drops white space, and merges
    within pieces alone. Plain texts are split here, and new pieces are encoded
    as one text, whose ids are told apart by the tokens that end a piece. Other
    texts go by words: none of the tokenizer's steps looks across white space.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.pieces, self.words = Kept(2 * KEPT_WORDS), Kept(KEPT_WORDS // 4)

    def _learn_pieces(self, pieces: list[str]) -> None:
        if not pieces:
            return
        ids = np.array(self.tokenizer.encode(" ".join(pieces), add_special_tokens=False).ids, ID)
        cuts = (np.flatnonzero(self.ends[ids]) + 1) * ID.itemsize
        raw, start, now = ids.tobytes(), 0, self.pieces.now
        for piece, end in zip(pieces, cuts.tolist(), strict=True):
            now[piece] = raw[start:end]
            start = end

    def _learn_words(self, words: list[bytes]) -> None:
        for w, e in zip(words, self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False), strict=True):
            self.words.now[w] = np.array(e.ids, ID).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [bool(_PLAIN(t)) and "<|" not in t for t in texts]
        cut = [_PIECES(t.lower()) if p else t.encode().split() for t, p in zip(texts, plain, strict=True)]
        for kept, learn, of in ((self.pieces, self._learn_pieces, True), (self.words, self._learn_words, False)):
            met: set = set()
            for parts, p in zip(cut, plain, strict=True):
                if p is of:
                    met.update(parts)
            learn(kept.missing(met))
        return [b"".join(map((self.pieces if p else self.words).now.__getitem__, parts)) for parts, p in zip(cut, plain, strict=True)]


def word_encoder(path: str) -> WordEncoder:
    return keep(f"words {path}", lambda: WordEncoder(path))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
                 end_id: int = END_ID, block_ids: int = BLOCK_IDS, plane: str = "byte") -> None:
    """Write the ids of all rows, each with ``end_id`` after it, to ``path/blocks`` and ``path/index``.

    Rows go in ascending id order (rows without an id first; rows of equal id by
    a hash of their text). Every row is written, whole; a null or empty text is its end id
    alone. An empty table gives an empty blocks table. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tie"))
    # by narrow keys: the range bounds come from a sample of them on the driver
    rows = rows.repartitionByRange(shuffle_parts(spark), "id", "tie").sortWithinPartitions("id", "tie", "text").select("id", "text")
    ending = np.array([end_id], ID).tobytes()

    arrow = to_arrow_schema(T._parse_datatype_string(BLOCK_SCHEMA))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = word_encoder(tokenizer or tokenizer_path())
        file = TaskContext.get().partitionId()
        held, begun, opened = b"", [], None  # ids not yet in a block, the documents begun in it, the one that goes on
        at = number = 0
        size = block_ids * ID.itemsize

        def block(ids: bytes) -> dict:
            nonlocal at, number, begun, opened
            n = len(ids) // ID.itemsize
            row = {"file": file, "block": number, "first": at, "n_ids": n, "open": opened, "plane": plane,
                   "planes": to_planes(np.frombuffer(ids, ID), plane), "crc32": zlib.crc32(ids),
                   "docs": [d for d in begun if d["start"] < at + n]}
            at, number = at + n, number + 1
            last = row["docs"][-1]["start"] if row["docs"] else opened
            begun = [d for d in begun if d["start"] >= at]
            opened = None if begun and begun[0]["start"] == at else last
            return row

        def frame(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, schema=arrow)

        start = 0
        for batch in batches:
            texts, names = texts_of(batch, "text"), batch.column("id").to_pylist()
            for a, b in slabs(texts):
                parts = [held]
                for name, ids in zip(names[a:b], enc.encode(texts[a:b]), strict=True):
                    n = len(ids) // ID.itemsize + 1
                    begun.append({"id": name, "start": start, "n_tokens": n})
                    start += n
                    parts += [ids, ending]
                held = b"".join(parts)
                full = len(held) // size * size
                for lo in range(0, full, 16 * size):
                    yield frame([block(held[i:i + size]) for i in range(lo, min(full, lo + 16 * size), size)])
                held = held[full:]
        if held:
            yield frame([block(held)])

    rows.mapInArrow(run, BLOCK_SCHEMA).write.option("compression", "none").parquet(f"{path}/blocks")
    blocks = _blocks(spark, path)
    blocks.select("file", "block", "first", "n_ids", "plane", "crc32", F.transform("planes", F.octet_length).alias("plane_bytes"),
                  F.size("docs").alias("n_docs")).write.parquet(f"{path}/index")


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")


def file_starts(spark: SparkSession, path: str) -> DataFrame:
    """(file, before): ids of all files before each file, from the chunk index; one row per file."""
    sizes = spark.read.parquet(f"{path}/index").groupBy("file").agg(F.sum("n_ids").alias("n"))
    return sizes.selectExpr("file", "sum(n) OVER (ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS before")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n_tokens, ids) of every document, from the files.

    A document within one block is read there; the pieces of one that goes over
    blocks are brought together by its place. Damaged blocks raise an error.
    """

    piece = "file long, doc long, at long, id long, n_tokens long, ids binary"

    arrow = to_arrow_schema(T._parse_datatype_string(piece))

    def pieces(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (r for i in range(len(batch)) for r in batch.slice(i, 1).to_pylist()):
                first, end, docs, out = row["first"], row["first"] + row["n_ids"], row["docs"], []
                if whole:
                    docs = [d for d in docs if d["start"] + d["n_tokens"] <= end]
                else:
                    goes_on = [] if row["open"] is None else [{"id": None, "start": row["open"], "n_tokens": None, "to": docs[0]["start"] if docs else end}]
                    docs = goes_on + [d | {"to": end} for d in docs[-1:] if d["start"] + d["n_tokens"] > end]
                if not docs:
                    continue
                ids = from_planes(row["planes"], row["n_ids"], row["plane"]).tobytes()
                if zlib.crc32(ids) != row["crc32"]:
                    raise ValueError(f"block {row['block']} of file {row['file']} is damaged")
                for d in docs:
                    a = max(d["start"], first)
                    to = d["start"] + d["n_tokens"] if whole else d["to"]
                    out.append((row["file"], d["start"], a, d["id"], d["n_tokens"], ids[(a - first) * ID.itemsize:(to - first) * ID.itemsize]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), arrow.types, strict=True)], schema=arrow)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [b"".join(p["ids"] for p in sorted(parts, key=lambda p: p["at"])) for parts in batch.column("parts").to_pylist()]
            yield batch.drop_columns(["parts"]).append_column("ids", pa.array(ids, pa.binary()))

    blocks = _blocks(spark, path)
    broken = (blocks.mapInArrow(lambda batches: pieces(batches, False), piece).groupBy("file", "doc")
              .agg(F.max("id").alias("id"), F.max("n_tokens").alias("n_tokens"), F.collect_list(F.struct("at", "ids")).alias("parts"))
              .mapInArrow(join, "file long, doc long, id long, n_tokens long, ids binary"))
    docs = blocks.mapInArrow(lambda batches: pieces(batches, True), piece).drop("at").unionByName(broken)
    return (docs.join(F.broadcast(file_starts(spark, path)), "file")  # one row per file
            .select("id", (F.col("before") + F.col("doc")).alias("start"), "n_tokens", "ids"))


def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents", "doc_id", "text"), path)
    return read_documents(spark, path).select(F.col("id").alias("doc_id"), "start", "n_tokens",
                                              F.crc32("ids").alias("ids_crc32"))
