"""Operator 13: target-distribution importance resampling with hashed word runs.

Every text is a bag of its runs of 1 to 3 consecutive words, hashed into buckets
by CRC-32. A bucket's gain is the log ratio of its smoothed shares in the target
(`benchmark`) and in the raw texts (`documents`); a text's weight is the sum of
its gains, and Gumbel noise drawn from its id turns the greatest scores into a
sample without replacement.

CRCs come from length-bucketed matrices. The words of a slab of texts lie in one
blob with one space between neighbours, so that every run of words is a slice of
it. The distinct runs of a slab are grouped by length; the bytes of each group
form a two-dimensional uint8 array, and all its CRCs are updated column by
column; the buckets are then scattered back to every place of a run. Runs over
``LONG`` bytes are laid out as several rows of ``LONG`` bytes, whose CRCs are
chained by the linear step of CRC-32 over ``LONG`` zero bytes.

A text's buckets are computed once and kept, two bytes a run, in the shared
folder; counts per bucket and weights both read them from there. Tasks hold one
slab (texts over ``SLAB_BYTES`` go in parts that share two words). Counts are
summed by a shuffle of at most one row per task and bucket; the gains, one per
bucket, are the only thing broadcast. The drawn rows are ranked by range
partitions, so no task sees all scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_columns, forget, global_rank, table, written

BUCKETS = 10_000
LONGEST = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: Bytes of a matrix row; longer runs take several rows.
LONG = 256
#: Bytes of text whose runs are handled at once.
SLAB_BYTES = 1 << 20

_WORD = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_TO_BLANKS = bytes(c if c in _WORD else (c + 32 if 0x41 <= c <= 0x5A else 0x20) for c in range(256))


def _crc_steps() -> np.ndarray:
    """CRC-32 of each byte value, for the reflected polynomial EDB88320."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


_STEP = _crc_steps()


def _over_zeros(n: int) -> np.ndarray:
    """Four tables: the register after ``n`` zero bytes is the xor of an entry for each of its bytes."""
    reg = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).ravel()
    for _ in range(n):
        reg = _STEP[reg & 0xFF] ^ (reg >> 8)
    return reg.reshape(4, 256)


_ZEROS = _over_zeros(LONG)


def _columns(matrix: np.ndarray, reg: np.ndarray) -> np.ndarray:
    """The registers after the rows of a uint8 matrix, all rows at once, column by column."""
    for column in np.ascontiguousarray(matrix.T):
        reg = _STEP[(reg ^ column) & 0xFF] ^ (reg >> 8)
    return reg


def slice_crcs(blob: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of the slices ``blob[start:start + length]``."""
    out = np.zeros(len(start), np.uint32)
    order = np.argsort(length, kind="stable")
    cuts = np.flatnonzero(np.diff(length[order])) + 1
    for rows in np.split(order, cuts) if len(order) else []:
        size, at = int(length[rows[0]]), start[rows]
        reg = np.full(len(rows), 0xFFFFFFFF, np.uint32)
        head = size % LONG if size > LONG else size
        if head:
            reg = _columns(np.lib.stride_tricks.sliding_window_view(blob, head)[at], reg)
        if size > LONG:
            per = max(1, SLAB_BYTES // LONG // len(rows))  # whole rows of LONG bytes, some at a time
            for first in range(head, size, per * LONG):
                n = min(per, (size - first) // LONG)
                places = (at[:, None] + first + LONG * np.arange(n)).ravel()
                own = _columns(np.lib.stride_tricks.sliding_window_view(blob, LONG)[places], np.zeros(len(places), np.uint32))
                for block in own.reshape(len(rows), n).T:
                    reg = _ZEROS[0][reg & 0xFF] ^ _ZEROS[1][(reg >> 8) & 0xFF] ^ _ZEROS[2][(reg >> 16) & 0xFF] ^ _ZEROS[3][reg >> 24] ^ block
        out[rows] = reg ^ np.uint32(0xFFFFFFFF)
    return out


def run_buckets(words: list[bytes], owner: np.ndarray, buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2, 3 words: (first words, buckets) of all runs whose words have one owner."""
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    blob = np.frombuffer(b" ".join(words), np.uint8)
    begin = np.cumsum(sizes + 1) - sizes - 1
    out, key = [], np.zeros(len(words), np.int64)
    for n in range(1, LONGEST + 1):
        last = ids[n - 1:]
        key = key[:len(last)] * len(number) + last
        _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        key = inverse  # distinct runs by number, so that the key of the next length stays small
        whole = owner[:len(last)] == owner[n - 1:]
        used = np.zeros(len(first), bool)
        used[inverse[whole]] = True  # runs that only cross from text to text need no CRC
        at = np.flatnonzero(used)
        crc = np.zeros(len(first), np.uint32)
        crc[at] = slice_crcs(blob, begin[first[at]], (begin + sizes)[first[at] + n - 1] - begin[first[at]])
        where = np.flatnonzero(whole)
        out.append((where, (crc % np.uint32(buckets))[inverse[where]]))
    return out


def _parts(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text, in parts of about ``SLAB_BYTES``; a part begins with the last words of the one before."""
    if len(text) <= SLAB_BYTES:
        yield text.translate(_TO_BLANKS).split()
        return
    carried: list[bytes] = []
    at = 0
    while at < len(text):
        end = min(len(text), at + SLAB_BYTES)
        while end < len(text) and text[end:end + 1].translate(_TO_BLANKS) != b" ":
            end = min(len(text), end + 1)
        words = carried + text[at:end].translate(_TO_BLANKS).split()
        yield words
        carried, at = words[-(LONGEST - 1):], end


def text_buckets(texts: list[bytes], buckets: int) -> list[tuple[int, np.ndarray]]:
    """(words, bucket of every run of 1 to 3 words) of each text, buckets as uint16 (uint32 over 65,536)."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32
    counts, held = [], [[] for _ in texts]
    batch: list[bytes] = []
    owner: list[np.ndarray] = []

    def flush() -> None:
        if batch:
            own = np.concatenate(owner)
            for where, bucket in run_buckets(batch, own, buckets):
                edge = np.searchsorted(own[where], np.arange(own[0], own[-1] + 2))
                for i in range(own[0], own[-1] + 1):
                    held[i].append(bucket[edge[i - own[0]]:edge[i - own[0] + 1]].astype(kind))
        batch.clear()
        owner.clear()

    size = 0
    for i, text in enumerate(texts):
        n = 0
        for p, words in enumerate(_parts(text)):
            again = min(LONGEST - 1, n) if p else 0  # carried words were counted before
            if p:
                flush()
                # runs inside the carried words belong to the part before
                made = run_buckets(words, np.zeros(len(words), np.int64), buckets)
                for length, (where, bucket) in enumerate(made, 1):
                    held[i].append(bucket[where + length > again].astype(kind))
            elif words:
                batch.extend(words)
                owner.append(np.full(len(words), i))
            n += len(words) - again
        counts.append(n)
        size += len(text)
        if size > SLAB_BYTES:
            flush()
            size = 0
    flush()
    return [(n, np.concatenate(h) if h else np.zeros(0, kind)) for n, h in zip(counts, held)]


def bucketed(docs: DataFrame, text_col: str, buckets: int) -> DataFrame:
    """``docs`` with n_words and runs (the bucket of every run, little-endian) in place of the text."""
    def make(texts, rows):
        made = text_buckets([t.encode("utf-8", "surrogatepass") for t in texts], buckets)
        return {"_words": [n for n, _ in made], "_runs": [b.tobytes() for _, b in made]}

    return add_columns(docs, {"_words": "long", "_runs": "binary"}, text_col, make, drop=(text_col,))


def _counts(runs: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs in all rows."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += np.bincount(np.frombuffer(value.as_buffer(), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    summed = runs.select("_runs").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(buckets, np.int64)
    for r in summed.collect():  # one row a bucket
        total[r["bucket"]] = r["n"]
    return total


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) of each bucket, in doubles."""
    size = float(len(raw))
    more, less = float(raw.sum()) + size, float(target.sum()) + size
    return np.array([math.floor(1000 * math.log((t + 1.0) * more / ((s + 1.0) * less))) for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
             buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """``docs`` without the text, with n_words, n_features, weight, score and rank (null: not drawn).

    Of the rows with at least ``least_words`` words, ``percent`` percent (rounded
    down) are drawn: the greatest scores, ties to the smaller id, then to the
    smaller number of features. A null or blank text has no words, weight 0 and a
    score from its id; it is never drawn. A null id counts as an empty id in the
    noise and sorts first. Repeated rows are each scored and may each be drawn.
    An empty target gives every bucket its smoothed share. An empty table gives no
    rows. Other columns pass through; those named like a column made here give way.
    """
    made = ["n_words", "n_features", "weight", "score", "rank"]
    docs = docs.drop(*[c for c in docs.columns if c in made and c not in (id_col, text_col)])
    own = written(bucketed(docs, text_col, buckets), "runs")
    gain = gains(_counts(own, buckets), _counts(bucketed(target.select(F.col(target_text).alias("text")), "text", buckets), buckets))
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32
    sent = docs.sparkSession.sparkContext.broadcast(gain)  # one number a bucket

    @F.pandas_udf("long")
    def weight(runs):
        return runs.map(lambda b: int(sent.value[np.frombuffer(b, kind)].sum()))

    noise = (F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("long") + 0.5) / 4294967296.0
    size = np.dtype(kind).itemsize
    scored = (own.withColumn("n_features", F.expr(f"octet_length(_runs) DIV {size}"))
              .withColumn("weight", weight("_runs")).drop("_runs").withColumnRenamed("_words", "n_words")
              .withColumn("score", F.col("weight") + F.floor(-1000.0 * F.log(-F.log(noise)))))
    scored = written(scored, "scores")
    fit = scored.filter(F.col("n_words") >= least_words)
    most = fit.agg(F.count("*").alias("n")).first()["n"] * percent // 100
    ranked = global_rank(fit.withColumn("_down", -F.col("score")), ["_down", id_col, "n_features"], "_at").drop("_down")
    ranked = ranked.withColumn("rank", F.when(F.col("_at") < most, F.col("_at") + 1)).drop("_at")
    rest = scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest)


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "text"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank", "n_words")
