"""Operator 6: benchmark passages in documents, under edits.

A passage counts as found if some part of a document is within ``MAX_EDITS`` of
its words in word edit distance. Candidates come from windows about the size of
the items: the CGK random walk reads a window's words, staying on a word or
going on as a random bit of (step, word) says, and so turns edits into few
differing places of the walk. Samples of places, hashed, are the keys of several
tables, for several walks; windows that share a key with a window of an item are
candidates. Each is verified by the exact edit distance of the whole item to the
document's words around it.

Documents' windows start at every eighth of the window class, items' windows at
every word, so the corpus is walked sparsely and any alignment still meets.
Before walking, windows with too few words of any item are passed over. What the
walks miss comes from a second source, which is complete: an item with e edits
allowed is cut into e + 1 runs of words, one of which any accepted match holds
unchanged, wherever its edits are. These runs, of 2 to 5 words, are looked up at
every word of the documents. So every accepted match is found. The benchmark is a stated query set: it is taken in blocks of bounded size,
and each block goes to all tasks. Documents are read once per block and never
shuffled.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import forget, table, texts_of
from .words import hashed_words, mix, slab_bounds

#: Edits per word of the item up to which a match is accepted (similarity 0.8 or more).
MAX_EDITS = 0.2
#: Items of fewer words say too little; they are not searched.
MIN_WORDS = 3
#: Items of fewer words are too short for walks; the runs alone find them.
WALKED = 8
WALKS, TABLES, SAMPLED = 3, 10, 7
#: Share of a window's words that must be words of the items.
KNOWN = 0.7
#: Words of benchmark items searched for in one pass over the documents (expected).
BLOCK_WORDS = 100_000
SEED = 11
#: Signs and white space of ASCII count as blanks; letters of other scripts are kept.
_PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: Letters of scripts without spaces between words (Thai, Lao, Tibetan, Burmese, Khmer, Chinese, Japanese, Yi and their signs): each is a word.
_UNSPACED = re.compile("([\u0e00-\u109f\u1780-\u17ff\u19e0-\u19ff\u2e80-\u312f\u31a0-\u4dbf\u4e00-\ua4cf\ua9e0-\ua9ff\uaa60-\uaa7f\uf900-\ufaff"
                       "\ufe30-\ufe4f\uff00-\uff0f\uff1a-\uff20\uff5b-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff])")
_BLANK = np.array([b == 32 for b in range(256)])


def plain(text: str | None) -> bytes:
    text = (text or "").lower()
    return (text if text.isascii() else _UNSPACED.sub(r" \1 ", text)).encode().translate(_PLAIN)


def edit_end(item: list[int], text: list[int]) -> tuple[int, int]:
    """(edits, end): the least word edits that turn the item into a run of the text, and the run's first such end."""
    m = len(item)
    at: dict[int, int] = defaultdict(int)
    for i, w in enumerate(item):
        at[w] |= 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, w in enumerate(text, 1):
        eq = at.get(w, 0)
        x = eq | minus
        d = ((((x & plus) + plus) ^ plus) | x) & full
        hp, hm = minus | (~(d | plus) & full), plus & d
        if hp & high:
            score += 1
        elif hm & high:
            score -= 1
        hp, hm = hp << 1 & full, hm << 1 & full
        plus, minus = hm | (~(d | hp) & full), hp & d
        if score < best:
            best, end = score, j
    return best, end


class WindowClass:
    """Items of ``base`` to 2 * ``base`` - 1 words: window, stride, steps and the tables of their windows' keys."""

    def __init__(self, base: int):
        self.length, self.stride, self.steps = base * 3 // 4, max(1, base // 8), base * 3 // 2
        rng = np.random.default_rng([SEED, base])
        self.samples = [[np.sort(rng.choice(self.steps * 3 // 4, SAMPLED, replace=False)) for _ in range(TABLES)] for _ in range(WALKS)]
        self.items: list[int] = []
        self.keys: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def walk(self, words: np.ndarray, start: np.ndarray, w: int) -> Iterator[np.ndarray]:
        """Keys of the windows at ``start`` for each table of walk ``w``. ``words`` ends with zeros to run into."""
        bits = mix(words, 100 * w + 1)
        met = np.empty((self.steps * 3 // 4, len(start)), np.uint64)
        at = start.copy()
        for t in range(len(met)):
            if t and t % 64 == 0:
                bits = mix(words, 100 * w + 1 + t)
            met[t] = words[at]
            at += (bits[at] >> np.uint64(t % 64) & np.uint64(1)).astype(np.int64)
        for sample in self.samples[w]:
            key = np.zeros(len(start), np.uint64)
            for t in sample:
                key = mix(key ^ met[t], int(t) + 1)
            yield key

    def build(self, items: list[np.ndarray]) -> None:
        whole, start, owner, offset, at = [], [], [], [], 0
        for i in self.items:
            n = len(items[i])
            places = np.arange(n - self.length + 1)
            start.append(places + at)
            owner.append(np.full(len(places), i))
            offset.append(places)
            whole += [items[i], np.zeros(2 * self.length, np.uint64)]
            at += n + 2 * self.length
        words, start = np.concatenate(whole), np.concatenate(start)
        owner, offset = np.concatenate(owner), np.concatenate(offset)
        for w in range(WALKS):
            for key in self.walk(words, start, w):
                order = np.argsort(key, kind="stable")
                self.keys.append((key[order], owner[order], offset[order]))


def run_keys(words: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """Keys of the runs of ``length`` words at ``start``."""
    key = words[start]
    for t in range(1, length):
        key = mix(key, t) ^ words[start + t]
    return mix(key, length)


class Runs:
    """Runs of one length, cut from items: an item with e edits allowed gives e + 1 runs side by side."""

    def __init__(self, length: int):
        self.length = length
        self.found: list[tuple[int, int]] = []  # (item, place in it)

    def build(self, items: list[np.ndarray]) -> None:
        whole = np.stack([items[i][at:at + self.length] for i, at in self.found])
        keys = run_keys(whole.ravel(), np.arange(len(whole)) * self.length, self.length)
        order = np.argsort(keys, kind="stable")
        self.keys, (self.owner, self.offset) = keys[order], np.array(self.found)[order].T
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(keys >> np.uint64(44)).astype(np.int64)] = True

    def meet(self, words: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``words``, item, place in the item) of every run of an item among those at ``start``."""
        keys = run_keys(words, start, self.length)
        some = self.maybe[(keys >> np.uint64(44)).astype(np.int64)]
        start, keys = start[some], keys[some]
        lo = np.searchsorted(self.keys, keys)
        n = np.searchsorted(self.keys, keys, "right") - lo
        each = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        return np.repeat(start, n), self.owner[each], self.offset[each]


class PassageIndex:
    """The items of one block, ready for lookup."""

    def __init__(self, ids: list, texts: list[str]):
        self.ids = ids
        self.items = [hashed_words(plain(t), _BLANK)[1] for t in texts]
        self.most = [int(MAX_EDITS * len(x)) for x in self.items]
        self.classes: dict[int, WindowClass] = {}
        self.runs: dict[int, Runs] = {}
        self.known = np.zeros(1 << 20, bool)
        for i, x in enumerate(self.items):
            if len(x) >= WALKED:
                base = 1 << (len(x).bit_length() - 1)
                self.classes.setdefault(base, WindowClass(base)).items.append(i)
            if len(x) >= MIN_WORDS:
                self.known[(x >> np.uint64(44)).astype(np.int64)] = True
                cuts = [k * len(x) // (self.most[i] + 1) for k in range(self.most[i] + 2)]
                for a, b in zip(cuts, cuts[1:], strict=False):
                    self.runs.setdefault(b - a, Runs(b - a)).found.append((i, a))
        for c in (*self.classes.values(), *self.runs.values()):
            c.build(self.items)
        self.sizes, self.edits = np.array([len(x) for x in self.items]), np.array(self.most)

    def _candidates(self, words: np.ndarray, doc: np.ndarray) -> set[tuple[int, int, int]]:
        """(document, item, place in ``words`` where the item would begin)."""
        n = len(words)
        hits = np.r_[0, np.cumsum(self.known[(words >> np.uint64(44)).astype(np.int64)])]
        found: set[tuple[int, int, int]] = set()
        for c in self.classes.values():
            start = np.arange(0, n - c.length + 1, c.stride)
            start = start[(hits[start + c.length] - hits[start] >= KNOWN * c.length) & (doc[start] == doc[start + c.length - 1])]
            if not len(start):
                continue
            padded = np.r_[words, np.zeros(2 * c.length, np.uint64)]
            tables = iter(c.keys)
            for w in range(WALKS):
                for key in c.walk(padded, start, w):
                    keys, owner, offset = next(tables)
                    lo = np.searchsorted(keys, key)
                    hit = np.flatnonzero(keys[np.minimum(lo, len(keys) - 1)] == key)
                    hi = np.searchsorted(keys, key[hit], "right")
                    for s, a, b in zip(start[hit], lo[hit], hi, strict=True):
                        d = int(doc[s])
                        found.update((d, int(owner[k]), int(s - offset[k])) for k in range(a, b))
        for r in self.runs.values():
            start = np.flatnonzero(hits[r.length:] - hits[:-r.length] == r.length)
            start = start[doc[start] == doc[start + r.length - 1]]
            s, owner, offset = r.meet(words, start)
            place, size, most = s - offset, self.sizes[owner], self.edits[owner]
            # a match lies between these and has all but ``most`` of the item's words
            left, right = np.clip(place - most, 0, n), np.clip(place + size + 2 * most, 0, n)
            able = hits[right] - hits[left] >= size - most
            found.update(zip(doc[s[able]].tolist(), owner[able].tolist(), place[able].tolist(), strict=True))
        return found

    def find(self, texts: list[bytes]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, edits, first word, word after the last) for each text and item found, at its best place."""
        for a, b in slab_bounds([len(t) for t in texts]):
            data = b" ".join(texts[a:b])
            at, words = hashed_words(data, _BLANK)
            ends = np.cumsum([len(t) + 1 for t in texts[a:b]])
            doc = np.searchsorted(ends, at, "right")
            first = np.searchsorted(doc, np.arange(b - a + 1))
            best: dict[tuple[int, int], tuple[int, int, int]] = {}
            done: set[tuple[int, int, int]] = set()
            for d, i, place in sorted(self._candidates(words, doc)):
                item, most = self.items[i], self.most[i]
                n = len(item)
                if best.get((d, i), (n,))[0] == 0:
                    continue
                lo, hi = int(first[d]), int(first[d + 1])
                if lo <= place and place + n <= hi and np.array_equal(words[place:place + n], item):
                    best[d, i] = (0, place - lo, place + n - lo)
                    continue
                around = (d, i, place // max(1, most))  # places so near share a verification
                if around in done:
                    continue
                done.add(around)
                left, right = max(lo, place - 2 * most), min(hi, place + n + 3 * most)
                text, wanted = words[left:right].tolist(), item.tolist()
                edits, end = edit_end(wanted, text)
                if edits <= most and edits < best.get((d, i), (n,))[0]:
                    _, back = edit_end(wanted[::-1], text[:end][::-1])
                    best[d, i] = (edits, left + end - back - lo, left + end - lo)
            for (d, i), (edits, start, end) in best.items():
                yield a + d, i, edits, start, end


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[PassageIndex]:
    """The benchmark's items in blocks of about BLOCK_WORDS words."""
    rows = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // (6 * BLOCK_WORDS))
    for k in range(n):
        items = rows.filter(F.expr(f"pmod(xxhash64(text, 3), {n}) = {k}")).orderBy("id", "text").collect()
        yield PassageIndex([r["id"] for r in items], [r["text"] for r in items])


def find_passages(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc, item, edits, similarity, first_word, end_word), one row per document row and item found, at its best place.

    All rows and whole texts are searched; null and empty texts hold nothing.
    Null or empty items, and those of fewer than MIN_WORDS words, are not
    searched. A letter of a script without spaces counts as a word. Rows without an id are returned with a null id; repeated rows and
    repeated items each give their rows. Of equally good places the first counts.
    Empty tables give no rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    schema = T.StructType([
        T.StructField("doc", docs.schema[id_col].dataType), T.StructField("item", benchmark.schema[item_col].dataType),
        T.StructField("edits", T.IntegerType()), T.StructField("similarity", T.DoubleType()),
        T.StructField("first_word", T.LongType()), T.StructField("end_word", T.LongType())])
    out = docs.sparkSession.createDataFrame([], schema)
    for index in _blocks(benchmark, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, arrow = shared.value, to_arrow_schema(schema)
            for batch in batches:
                ids = batch.column("doc")
                found = [(ids[t].as_py(), index.ids[i], edits, 1 - edits / len(index.items[i]), a, b)
                         for t, i, edits, a, b in index.find([plain(x) for x in texts_of(batch, "text")])]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), arrow.types, strict=True)], schema=arrow)

        out = out.unionByName(rows.mapInArrow(run, schema))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a passage of the benchmark; all others stay as they are, nulls included."""
    for index in _blocks(benchmark, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            forget()
            for batch in batches:
                hit = {t for t, *_ in shared.value.find([plain(x) for x in texts_of(batch, text_col)])}
                yield batch.filter(pa.array([i not in hit for i in range(len(batch))], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_passages(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.withColumnsRenamed({"doc": "doc_id", "item": "item_id"})
