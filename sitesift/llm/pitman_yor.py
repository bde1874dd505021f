"""Operator 7: a hierarchical Pitman-Yor language model, seated by Gibbs sampling.

The restaurant of a context holds the words that followed it; the context of a
word is the class of the word before it (one of CLASSES, by hash) or the start of
the text. All context restaurants share one parent, whose customers are their
tables; its base spreads evenly over the V known words and one unknown. A word's
probability is the average of the predictive probabilities of several samples of
the seating.

Layout. The counts of all training tokens are dealt by word: a part owns some
words with all their contexts, so the parent's customers of a word and its own
tables stay in one part. Words so frequent that one would fill a part (found
first; fewer than a fixed number for each part) are dealt by word and context,
and their parent sums go through the totals. A Gibbs sweep reseats every
(context, word) group given the totals of the sweep before; only totals (tables of
each context, of each frequent word, and two sums) are gathered between sweeps.
Random numbers are hashes of (sweep, word, context, draw): a lost task repeats
the same draws, so parts keep nothing between sweeps and replay them from the
totals.

Texts are tokenized once; occurrences (word, context, document) travel as packed
and compressed arrays in one shuffle, are kept as one row per part, and come back
as partial sums of each document. No text is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shuffle_parts, slabs, table, texts_of, written
from .words import hashed_words, mix

CLASS_BITS = 14
CLASSES = 1 << CLASS_BITS
START = CLASSES
#: Discounts and strengths of the context restaurants and of their parent.
DISCOUNT, STRENGTH = 0.75, 2.0
PARENT_DISCOUNT, PARENT_STRENGTH = 0.7, 10.0
SWEEPS, BURN_IN = 4, 1
PARTS_PER_PARTITION = 4
MAX_PARTS = 1 << 16
SLAB_CHARS = 3_000_000
SLAB_DOCS = 4096
#: Customers of a group seated one by one; the later ones by the distance to the next new table.
ONE_BY_ONE = 48
SEED = 77
END = np.uint64(0xE4D0E4D0E4D0E4D1)
_BLANK = np.array([b in b"\x20\x09\x0a\x0b\x0c\x0d" for b in range(256)])
_TOKEN_BUCKETS = 20


def _squeeze(a: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def _expand(b: bytes, dtype) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype) if b else np.zeros(0, dtype)


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, context, document) of every word and end of the texts, in order."""
    data = [t.encode().lower() for t in texts]
    at, words = hashed_words(b"\n".join(data), _BLANK)
    doc = np.searchsorted(np.cumsum([len(d) + 1 for d in data]), at, "right")
    counts = np.bincount(doc, minlength=len(texts))
    token = np.empty(len(words) + len(texts), np.uint64)
    token[np.arange(len(words)) + doc] = words
    ends = np.cumsum(counts + 1) - 1
    token[ends] = END
    context = np.empty(len(token), np.int64)
    context[1:] = (token[:-1] >> np.uint64(64 - CLASS_BITS)).astype(np.int64)
    context[0] = START
    context[ends[:-1] + 1] = START
    return token, context, np.repeat(np.arange(len(texts)), counts + 1)


def _slabs(texts: list[str]) -> Iterator[tuple[int, int]]:
    for a, b in slabs(texts, SLAB_CHARS):
        for i in range(a, b, SLAB_DOCS):
            yield i, min(b, i + SLAB_DOCS)


def frequent_words(docs: DataFrame, parts: int) -> np.ndarray:
    """Sorted hashes of the words that may have over 1 / (4 * parts) of all tokens; 8 * parts at most.

    A word with that share has it in some slab, so each slab names its own.
    """
    share = 1 / (4 * parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch, "text")
            for a, b in _slabs(texts):
                token = tokens(texts[a:b])[0]
                bucket = (token >> np.uint64(64 - _TOKEN_BUCKETS)).astype(np.int64)
                large = np.bincount(bucket, minlength=1 << _TOKEN_BUCKETS) > share / 2 * len(token)
                word, n = np.unique(token[large[bucket]], return_counts=True)
                some = n > share / 2 * len(token)
                word, n = np.r_[word[some].view(np.int64), 0], np.r_[n[some], len(token)]
                whole = np.r_[np.zeros(some.sum(), bool), True]
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(n), pa.array(whole)], names=["word", "n", "whole"])

    found = written(docs.select("text").mapInArrow(run, "word long, n long, whole boolean")
                    .groupBy("whole", "word").agg(F.sum("n").alias("n")), "frequent")
    total = found.filter("whole").agg(F.sum("n")).first()[0] or 0
    rows = found.filter(~F.col("whole") & (F.col("n") > share / 2 * total)).select("word").collect()
    return np.sort(np.array([r["word"] for r in rows], np.int64).view(np.uint64))


def _among(words: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each word is in the sorted array ``of``, and its place there."""
    if not len(of):
        return np.zeros(len(words), bool), np.zeros(len(words), np.int64)
    at = np.minimum(np.searchsorted(of, words), len(of) - 1)
    return of[at] == words, at


def _counted(part: np.ndarray, at: np.ndarray, context: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """The different (part, word, context, document) in order, and how often each occurs."""
    if at.max(initial=0) >> 21 == 0:  # all four fit in 64 bits
        key = part.astype(np.uint64) << np.uint64(48) | at.astype(np.uint64) << np.uint64(27) | context.astype(np.uint64) << np.uint64(12) | doc.astype(np.uint64)
        key.sort()
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        n, key = np.diff(np.r_[first, len(key)]), key[first]
        part, at, context, doc = key >> np.uint64(48), key >> np.uint64(27) & np.uint64((1 << 21) - 1), key >> np.uint64(12) & np.uint64((1 << 15) - 1), key & np.uint64(4095)
    else:
        order = np.lexsort((doc, context, at, part))
        part, at, context, doc = part[order], at[order], context[order], doc[order]
        first = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (at[1:] != at[:-1]) | (context[1:] != context[:-1]) | (doc[1:] != doc[:-1])])
        n, part, at, context, doc = np.diff(np.r_[first, len(order)]), part[first], at[first], context[first], doc[first]
    return part.astype(np.int64), at.astype(np.int64), context.astype(np.uint16), doc.astype(np.uint16), n


def packets(docs: DataFrame, frequent: np.ndarray, parts: int) -> DataFrame:
    """(part, slab, body, docs): one row per slab and part with its occurrences, one per slab with its documents."""
    schema = "part int, slab long, body binary, docs array<struct<doc_id: long, held_out: boolean, n_tokens: long>>"
    docs_type = pa.list_(pa.struct([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64())]))
    names = ["part", "slab", "body", "docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slab = TaskContext.get().partitionId() << 28
        for batch in batches:
            texts, ids, held = texts_of(batch, "text"), batch.column("doc_id").to_pylist(), batch.column("held_out").to_numpy(zero_copy_only=False)
            for a, b in _slabs(texts):
                token, context, doc = tokens(texts[a:b])
                word, at = np.unique(token, return_inverse=True)
                hot = _among(word, frequent)[0]
                by_word = mix(word, 1) % np.uint64(parts)
                part = np.where(hot[at], mix(token ^ mix(context.astype(np.uint64), 2), 1) % np.uint64(parts), by_word[at])
                part, at, context, doc, n = _counted(part, at, context, doc)
                held_out = held[a:b][doc]
                cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
                found = []
                for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                    w = at[lo:hi]
                    new = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
                    count = n[lo:hi] << 1 | held_out[lo:hi]
                    wide = np.uint16 if count.max() < 1 << 16 else np.uint32
                    body = [np.array([len(new), hi - lo, np.dtype(wide).itemsize], np.uint32), word[w[new]], np.diff(np.r_[new, hi - lo]).astype(np.uint32),
                            context[lo:hi], doc[lo:hi], count.astype(wide)]
                    found.append((int(part[lo]), _squeeze(np.frombuffer(b"".join(x.tobytes() for x in body), np.uint8))))
                sizes = np.bincount(doc, n, b - a).astype(np.int64)
                meta = [{"doc_id": i, "held_out": bool(h), "n_tokens": int(s)} for i, h, s in zip(ids[a:b], held[a:b], sizes, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([-1 - slab % 1024] + [p for p, _ in found], pa.int32()), pa.array([slab] * (len(found) + 1), pa.int64()),
                     pa.array([None] + [x for _, x in found], pa.binary()), pa.array([meta] + [None] * len(found), docs_type)], names=names)
                slab += 1

    return docs.mapInArrow(run, schema)


def _unpack(body: bytes) -> tuple[np.ndarray, ...]:
    raw = _expand(body, np.uint8)
    words, rows, wide = raw[:12].view(np.uint32).tolist()
    out, at = [], 12
    for n, dtype in ((words, np.uint64), (words, np.uint32), (rows, np.uint16), (rows, np.uint16), (rows, np.uint16 if wide == 2 else np.uint32)):
        size = n * np.dtype(dtype).itemsize
        out.append(np.frombuffer(raw[at:at + size].tobytes(), dtype))
        at += size
    return tuple(out)


STATE = ("part int, slab long, docs array<struct<doc_id: long, held_out: boolean, n_tokens: long>>, words binary, groups binary, "
         "context binary, customers binary, slabs binary, at_group binary, at_doc binary, times binary")


def state(packed: DataFrame) -> DataFrame:
    """One row per part: its words, their (context, customers) groups, and the occurrences that point to groups."""

    def gather(key, rows: pd.DataFrame) -> pd.DataFrame:
        empty = dict.fromkeys(("words", "groups", "context", "customers", "slabs", "at_group", "at_doc", "times"))
        if key[0] < 0:
            return pd.DataFrame([{"part": key[0], "slab": s, "docs": d} | empty for s, d in zip(rows["slab"], rows["docs"], strict=True)])
        rows = rows.sort_values("slab")
        each = [_unpack(b) for b in rows["body"]]
        word, of = np.unique(np.concatenate([np.repeat(w, n) for w, n, *_ in each]), return_inverse=True)
        context = np.concatenate([x[2] for x in each]).astype(np.int64)
        doc = np.concatenate([x[3] for x in each])
        count = np.concatenate([x[4].astype(np.uint32) for x in each])
        group, at = np.unique(of << 15 | context, return_inverse=True)
        customers = np.bincount(at, (count >> 1) * (1 - (count & 1).astype(np.float64)), len(group)).astype(np.int64)
        slab = np.stack([rows["slab"].to_numpy(np.int64), np.array([len(x[2]) for x in each], np.int64)])
        return pd.DataFrame([{
            "part": key[0], "slab": None, "docs": None, "words": _squeeze(word), "groups": _squeeze(np.bincount(group >> 15, minlength=len(word)).astype(np.uint32)),
            "context": _squeeze((group & 0x7FFF).astype(np.uint16)), "customers": _squeeze(customers.astype(np.uint32) if customers.max(initial=0) < 1 << 32 else customers),
            "slabs": _squeeze(slab), "at_group": _squeeze(np.diff(at, prepend=0).astype(np.int32)), "at_doc": _squeeze(doc), "times": _squeeze((count >> 1).astype(np.uint32))}])

    return packed.groupBy("part").applyInPandas(gather, STATE)


def seat(customers: np.ndarray, new: np.ndarray, more: np.ndarray, discount: float, draw: np.ndarray) -> np.ndarray:
    """Tables of groups of ``customers`` of one dish, seated one after another.

    With t tables and j customers seated the next one opens a table with weight
    ``new + more * t`` and joins one with weight ``j - discount * t``. ``draw``:
    a 64-bit seed of each group.
    """
    tables = (customers > 0).astype(np.int64)
    who = np.flatnonzero(customers > 1)
    c, a, b, s, t = customers[who], new[who], more[who], draw[who], np.ones(len(who))
    for j in range(1, ONE_BY_ONE):
        if not len(who):
            return tables
        open_ = a + b * t
        t += _uniform(s, j) * (open_ + j - discount * t) < open_
        go = c > j + 1
        if not go.all():
            tables[who[~go]] = t[~go]
            who, c, a, b, s, t = who[go], c[go], a[go], b[go], s[go], t[go]
    j, step = np.full(len(who), float(ONE_BY_ONE)), ONE_BY_ONE
    while len(who):
        # the chance that m more customers all join is about ((x + r) / (x + m + r)) ** open, r = (open - 1) / 2
        open_ = a + b * t
        x = j - discount * t + (open_ - 1) / 2
        with np.errstate(over="ignore"):
            j = j + np.floor(x * np.expm1(-np.log(_uniform(s, step)) / open_)) + 1
        go = j <= c
        t[go] += 1
        tables[who[~go]] = t[~go]
        who, c, a, b, s, t, j = who[go], c[go], a[go], b[go], s[go], t[go], j[go]
        step += 1
    return tables


def _uniform(seed: np.ndarray, step: int) -> np.ndarray:
    return ((mix(seed, step) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


@dataclass
class Totals:
    """What a sweep gathers from all parts."""

    context: np.ndarray  # tables of each context
    frequent: np.ndarray  # tables of each frequent word, over all contexts
    parent_tables: float = 0.0


@dataclass
class Model:
    frequent: np.ndarray
    customers: np.ndarray  # of each context
    frequent_customers: np.ndarray
    tokens: int = 0
    words: int = 0
    sweeps: list[Totals] = field(default_factory=list)

    def parent_tables_of(self, tables: np.ndarray, word: np.ndarray, s: int) -> np.ndarray:
        """Parent tables of words with ``tables`` customers in the parent, seated in sweep ``s``."""
        if s == 0:
            return (tables > 0).astype(np.int64)
        base = 1 / (self.words + 1)
        new = (PARENT_STRENGTH + PARENT_DISCOUNT * max(0.0, self.sweeps[s - 1].parent_tables - 1)) * base
        return seat(tables, np.full(len(tables), new), np.full(len(tables), PARENT_DISCOUNT * base), PARENT_DISCOUNT, mix(word, SEED + 1000 + s))

    def parent(self, tables: np.ndarray, word: np.ndarray, s: int) -> np.ndarray:
        """The parent's probability of words with ``tables`` customers there after sweep ``s``."""
        above = (PARENT_STRENGTH + PARENT_DISCOUNT * self.sweeps[s].parent_tables) / (self.words + 1)
        own = np.maximum(tables - PARENT_DISCOUNT * self.parent_tables_of(tables, word, s), 0)
        return (own + above) / (PARENT_STRENGTH + self.sweeps[s].context.sum())


@dataclass
class Part:
    """One part's groups, replayed sweep by sweep."""

    word: np.ndarray
    of: np.ndarray
    context: np.ndarray
    customers: np.ndarray
    model: Model

    @classmethod
    def read(cls, row: dict, model: Model) -> Part:
        word, groups = _expand(row["words"], np.uint64), _expand(row["groups"], np.uint32)
        context = _expand(row["context"], np.uint16).astype(np.int64)
        raw = _expand(row["customers"], np.uint8)
        customers = raw.view(np.uint32 if len(raw) == 4 * len(context) else np.int64).astype(np.int64)
        return cls(word, np.repeat(np.arange(len(word)), groups), context, customers, model)

    def __post_init__(self):
        self.hot, self.hot_at = _among(self.word, self.model.frequent)
        self.own = np.bincount(self.of, self.customers, len(self.word)).astype(np.int64)
        self.seeds = mix(self.word)[self.of] ^ mix(self.context.astype(np.uint64), 3)

    def word_tables(self, tables: np.ndarray, s: int) -> np.ndarray:
        out = np.bincount(self.of, tables, len(self.word)).astype(np.int64)
        out[self.hot] = self.model.sweeps[s].frequent[self.hot_at[self.hot]]
        return out

    def sweeps(self, upto: int) -> Iterator[np.ndarray]:
        """Tables of each group after sweeps 0 (one table a group) to ``upto``."""
        tables = (self.customers > 0).astype(np.int64)
        yield tables
        for s in range(1, upto + 1):
            p = self.model.parent(self.word_tables(tables, s - 1), self.word, s - 1)[self.of]
            others = np.maximum(self.model.sweeps[s - 1].context[self.context] - tables, 0)
            tables = seat(self.customers, (STRENGTH + DISCOUNT * others) * p, DISCOUNT * p, DISCOUNT, mix(self.seeds, SEED + s))
            yield tables


def _parts(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[tuple[dict, Part]]:
    for batch in batches:
        for i in range(len(batch)):
            row = batch.slice(i, 1).to_pylist()[0]
            yield row, Part.read(row, model)


def _totals(parts: DataFrame, model: Model, s: int) -> dict[str, dict[int, float]]:
    """Sums over all parts after sweep ``s``; contexts and frequent words bound their number."""
    shared = parts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        kinds = ("customers", "tables", "hot_customers", "hot_tables", "words", "parent")
        sums = [np.zeros(CLASSES + 1), np.zeros(CLASSES + 1), np.zeros(len(m.frequent)), np.zeros(len(m.frequent)), np.zeros(1), np.zeros(1)]
        for _, p in _parts(batches, m):
            *_, tables = p.sweeps(s)
            sums[1] += np.bincount(p.context, tables, CLASSES + 1)
            by_word = np.bincount(p.of, tables, len(p.word))
            np.add.at(sums[3], p.hot_at[p.hot], by_word[p.hot])
            if s == 0:
                sums[0] += np.bincount(p.context, p.customers, CLASSES + 1)
                np.add.at(sums[2], p.hot_at[p.hot], p.own[p.hot])
                sums[4] += (p.own[~p.hot] > 0).sum()
            else:
                cold = by_word[~p.hot].astype(np.int64)
                sums[5] += m.parent_tables_of(cold, p.word[~p.hot], s).sum()
        for kind, x in zip(kinds, sums, strict=True):
            at = np.flatnonzero(x)
            yield pa.RecordBatch.from_arrays([pa.array([kind] * len(at), pa.string()), pa.array(at), pa.array(x[at])], names=["kind", "at", "n"])

    rows = (parts.select("words", "groups", "context", "customers").mapInArrow(run, "kind string, at long, n double")
            .groupBy("kind", "at").agg(F.sum("n").alias("n")).collect())
    out: dict[str, dict[int, float]] = {}
    for r in rows:
        out.setdefault(r["kind"], {})[r["at"]] = r["n"]
    return out


def _filled(found: dict[int, float] | None, n: int) -> np.ndarray:
    out = np.zeros(n)
    for at, x in (found or {}).items():
        out[at] = x
    return out


def learn(parts: DataFrame, frequent: np.ndarray, sweeps: int = SWEEPS) -> Model:
    """The totals of sweeps 0 to ``sweeps`` over the parts' training counts."""
    model = Model(frequent, np.zeros(CLASSES + 1), np.zeros(len(frequent)))
    for s in range(sweeps + 1):
        got = _totals(parts, model, s)
        if s == 0:
            model.customers = _filled(got.get("customers"), CLASSES + 1)
            model.frequent_customers = _filled(got.get("hot_customers"), len(frequent))
            model.tokens = int(model.customers.sum())
            model.words = int(got.get("words", {}).get(0, 0) + (model.frequent_customers > 0).sum())
        now = Totals(_filled(got.get("tables"), CLASSES + 1), _filled(got.get("hot_tables"), len(frequent)))
        now.parent_tables = float(model.words) if s == 0 else (
            got.get("parent", {}).get(0, 0.0) + model.parent_tables_of(now.frequent.astype(np.int64), frequent, s).sum())
        model.sweeps.append(now)
    return model


def score(parts: DataFrame, model: Model) -> DataFrame:
    """(slab, at, score, base, known): partial sums of documents."""
    shared = parts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        held: dict[int, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for slab, x in held.items():
                at = np.flatnonzero(x.any(axis=0))
                yield pa.RecordBatch.from_arrays([pa.array([slab], pa.int64()), pa.array([_squeeze(at.astype(np.uint16))], pa.binary()),
                                                  pa.array([_squeeze(x[:, at])], pa.binary())], names=["slab", "at", "sums"])
            held.clear()

        for row, p in _parts(batches, m):
            mean = np.zeros(len(p.of))
            for s, tables in enumerate(p.sweeps(len(m.sweeps) - 1)):
                if s > BURN_IN:
                    prior = m.parent(p.word_tables(tables, s), p.word, s)
                    mean += (np.maximum(p.customers - DISCOUNT * tables, 0) + (STRENGTH + DISCOUNT * m.sweeps[s].context[p.context]) * prior[p.of]) / (
                        STRENGTH + m.customers[p.context])
            logs = np.log10(mean / (len(m.sweeps) - 1 - BURN_IN))
            count = p.own.astype(np.float64)
            count[p.hot] = m.frequent_customers[p.hot_at[p.hot]]
            base = np.log10((count + 0.1) / (m.tokens + 0.1 * (m.words + 1)))[p.of]
            known = (count > 0)[p.of].astype(np.float64)
            group = np.cumsum(_expand(row["at_group"], np.int32).astype(np.int64))
            doc, n = _expand(row["at_doc"], np.uint16).astype(np.int64), _expand(row["times"], np.uint32).astype(np.float64)
            slab, size = _expand(row["slabs"], np.int64).reshape(2, -1)
            lo = 0
            for one, hi in zip(slab.tolist(), np.cumsum(size).tolist(), strict=True):
                into = held.setdefault(one, np.zeros((3, SLAB_DOCS)))
                for k, values in enumerate((logs, base, known)):
                    into[k] += np.bincount(doc[lo:hi], n[lo:hi] * values[group[lo:hi]], SLAB_DOCS)
                lo = hi
            if len(held) * 3 * SLAB_DOCS * 8 > 64 << 20:
                yield from flush()
        yield from flush()

    return parts.drop("part", "slab", "docs").mapInArrow(run, "slab long, at binary, sums binary")


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    Rows whose crc32 of the id as text is divisible by 10 are held out; the model
    learns from all others, rows without an id included. Tokens are the words and
    one end for each row; a null or empty text is its end alone. Repeated rows
    count and are scored as often as they come. An empty table gives no rows;
    other columns are ignored. If nothing is learned from, every token has the
    base probability 1.
    """
    spark = docs.sparkSession
    parts = min(MAX_PARTS - 1, PARTS_PER_PARTITION * shuffle_parts(spark))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.coalesce(F.crc32(F.col(id_col).cast("string")) % 10 == 0, F.lit(False)).alias("held_out"))
    frequent = frequent_words(rows, parts)
    kept = written(state(packets(rows, frequent, parts)), "parts", compression="none")
    of_words = kept.filter("part >= 0")
    model = learn(of_words, frequent)
    sums = score(of_words, model)
    whole = (kept.filter("part < 0").select("slab", "docs", F.lit(None).cast("binary").alias("at"), F.lit(None).cast("binary").alias("sums"))
             .unionByName(sums.withColumn("docs", F.lit(None).cast(kept.schema["docs"].dataType))))
    tokens_learned = model.tokens

    def add_up(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((3, SLAB_DOCS))
        for at, sums in sorted((a, s) for a, s in zip(rows["at"], rows["sums"], strict=True) if a is not None):
            at = _expand(at, np.uint16).astype(np.int64)
            total[:, at] += _expand(sums, np.float64).reshape(3, -1)
        docs = next(d for d in rows["docs"] if d is not None)
        out = pd.DataFrame(list(docs), columns=["doc_id", "held_out", "n_tokens"])
        n = len(out)
        return out.astype({"doc_id": "Int64"}).assign(
            n_known=np.rint(total[2, :n]).astype(np.int64), train_tokens=tokens_learned, base_score=total[1, :n], score=total[0, :n])

    return whole.groupBy("slab").applyInPandas(
        add_up, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op7_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents", "doc_id", "text"))
