"""Operator 8: byte-level BPE by corpus-level merge replay.

A task takes its documents in slabs. The distinct words of a slab that the task
has not met before are laid out as one symbol array; an inverted index leads
from each token pair (named by the token it makes) to the positions where it
stands. Merges are then replayed over all these words in rank order: the merge
of lowest rank goes to its positions in all words at once, as array operations,
and only the pairs with the two touched neighbours are entered anew. Every word
so gets the result that merging it alone would give. Documents are put together
from their words' ids.

Words, not documents, carry the cost, and nothing is shuffled. Word results are
kept per task in a table of bounded size.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, keep, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Rows decoded at once.
ROWS = 500
#: Words whose ids a task keeps (a speed matter only: a word that went is merged again).
KEPT_WORDS = 300_000
#: The same for the table of this operator.
KEPT_PIECES = 450_000
#: Characters of text whose new words are merged together.
CHARS = 4_000_000
#: Words up to so many bytes are merged in arrays, if there are so many; others place by place (a speed matter only).
SHORT, MANY = 64, 5_000
ID = np.dtype("<u4")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class MergeReplay:
    """Replays the merges of one vocabulary over lists of words."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        single = [ranks[bytes([b])] for b in range(256)]
        self.single = np.array(single, np.int64)
        self.first = np.full((256, 256), -1, np.int64)  # the token that two bytes make, or -1
        for token, rank in ranks.items():
            if len(token) == 2:
                self.first[token[0], token[1]] = rank
        self._pairs: dict[int, int] = {}
        self.none = max(ranks.values()) + 1  # stands beyond both ends of a word; no pair holds it
        pairs = sorted((left * (self.none + 1) + right, rank) for token, rank in ranks.items() for i in range(1, len(token))
                       if (left := ranks.get(token[:i])) is not None and (right := ranks.get(token[i:])) is not None)
        self.pairs, self.pair_token = np.array([*pairs, (np.iinfo(np.int64).max, -1)], np.int64).T.copy()

    def _tokens_of(self, pairs: np.ndarray) -> np.ndarray:
        """The token that each pair (left * (none + 1) + right) makes, or -1."""
        at = self.pairs.searchsorted(pairs)
        made = self.pair_token[at]
        made[self.pairs[at] != pairs] = -1
        return made

    def _made(self, pair: int) -> int:
        """The token that the pair (left << 32 | right) makes, or -1."""
        if len(self._pairs) > KEPT_WORDS:
            self._pairs.clear()
        made = self._pairs[pair] = self.ranks.get(self.tokens[pair >> 32] + self.tokens[pair & 0xFFFFFFFF], -1)
        return made

    def _index(self, text: np.ndarray, last: np.ndarray) -> dict[int, list[int]]:
        """Token to the positions, in ascending order, where two bytes make it. ``last``: each word's last position."""
        made = self.first[text[:-1], text[1:]]
        made[last[:-1]] = -1
        places = np.flatnonzero(made >= 0)
        order = np.argsort(made[places], kind="stable")
        places, made = places[order], made[places][order]
        cuts = np.flatnonzero(np.diff(made)) + 1
        return {int(m[0]): p.tolist() for m, p in zip(np.split(made, cuts), np.split(places, cuts), strict=True) if len(p)}

    def encode_all(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of each word: short words together, each merge at all its places at once; long words by ``encode``.

        A merge goes to its leftmost place in every word; its other places come
        after what the new pairs make of lower rank.
        """
        out = [ID.type(r).tobytes() if (r := self.ranks.get(w)) is not None else b"" for w in words]
        rest = [i for i, w in enumerate(words) if w and not out[i]]
        short = [i for i in rest if len(words[i]) <= SHORT]
        if len(short) < MANY:
            short = []
        taken = set(short)
        alone = [i for i in rest if i not in taken]
        for i, ids in zip(alone, self.encode([words[i] for i in alone]), strict=True):
            out[i] = np.array(ids, ID).tobytes()
        if not short:
            return out
        text = np.frombuffer(b"".join([words[i] for i in short]), np.uint8)
        sizes = np.array([len(words[i]) for i in short])
        ends = np.cumsum(sizes)
        n, last, starts = len(text), ends - 1, ends - sizes
        word = np.repeat(np.arange(len(short), dtype=np.int32), sizes)
        symbols = np.append(self.single[text], self.none)
        after = np.arange(1, n + 2, dtype=np.int32)
        before = np.arange(-1, n, dtype=np.int32)
        after[last], before[starts] = n, n
        made = np.full(n + 1, -1, np.int64)  # the token that a symbol makes with the next one
        made[:n - 1] = self.first[text[:-1], text[1:]]
        made[last] = -1
        index = self._index(text, last)
        queue = list(index)
        heapify(queue)
        while queue:
            rank = heappop(queue)
            p = np.array(index.pop(rank))
            p = p[made[p] == rank]  # elsewhere a neighbour has changed since
            if len(p) > 1:
                p.sort()
                of = word[p]
                later = np.concatenate([[False], of[1:] == of[:-1]])
                if later.any():
                    index[rank] = p[later].tolist()
                    heappush(queue, rank)
                    p = p[~later]
            elif not len(p):
                continue
            q = after[p]
            right, left = after[q], before[p]
            symbols[p], symbols[q] = rank, -1
            made[q] = -1
            after[p], before[right] = right, p
            touched = np.concatenate([left, p])
            new = self._tokens_of(np.concatenate([symbols[left] * (self.none + 1) + rank, rank * (self.none + 1) + symbols[right]]))
            made[touched] = new
            held = new >= 0
            for token, at in zip(new[held].tolist(), touched[held].tolist(), strict=True):
                if token in index:
                    index[token].append(at)
                else:
                    index[token] = [at]
                    heappush(queue, token)
        stays = symbols[:n] >= 0
        raw = symbols[:n][stays].astype(ID).tobytes()
        cuts = (np.cumsum(np.add.reduceat(stays, starts, dtype=np.int64)) * ID.itemsize).tolist()
        at = 0
        for i, end in zip(short, cuts, strict=True):
            out[i] = raw[at:end]
            at = end
        return out

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word; a word that is a token itself is that token."""
        out: list[list[int]] = [[r] if (r := self.ranks.get(w)) is not None else [] for w in words]
        rest = [i for i, w in enumerate(words) if w and not out[i]]
        if not rest:
            return out
        text = np.frombuffer(b"".join([words[i] for i in rest]), np.uint8)
        ends = np.cumsum([len(words[i]) for i in rest])
        last = ends - 1
        starts = [0, *ends[:-1].tolist()]
        index = self._index(text, last)
        symbols = self.single[text].tolist()
        links = np.arange(1, len(text) + 1)
        links[last] = -1
        after = links.tolist()
        links = np.arange(-1, len(text) - 1)
        links[starts] = -1
        before = links.tolist()
        known, made_by = self._pairs, self._made
        queue = list(index)
        heapify(queue)
        while queue:
            rank = heappop(queue)
            places = index.pop(rank, None)
            if places is None:
                continue
            places.sort()
            for done, p in enumerate(places, 1):
                q = after[p]
                if q < 0 or symbols[p] < 0:
                    continue
                pair = symbols[p] << 32 | symbols[q]
                if (known[pair] if pair in known else made_by(pair)) != rank:
                    continue  # a neighbour has changed since
                symbols[p], symbols[q] = rank, -1
                right = after[p] = after[q]
                left = before[p]
                lowest = rank
                if right >= 0:
                    before[right] = p
                    pair = rank << 32 | symbols[right]
                    made = known[pair] if pair in known else made_by(pair)
                    if made >= 0:
                        if made in index:
                            index[made].append(p)
                        else:
                            index[made] = [p]
                            heappush(queue, made)
                        if made < lowest:
                            lowest = made
                if left >= 0:
                    pair = symbols[left] << 32 | rank
                    made = known[pair] if pair in known else made_by(pair)
                    if made >= 0:
                        if made in index:
                            index[made].append(left)
                        else:
                            index[made] = [left]
                            heappush(queue, made)
                        if made < lowest:
                            lowest = made
                if lowest < rank:  # the new pair goes first; come back for the other places
                    index.setdefault(rank, []).extend(places[done:])
                    heappush(queue, rank)
                    break
        for i, at in zip(rest, starts, strict=True):
            ids = out[i]
            while at >= 0:
                ids.append(symbols[at])
                at = after[at]
        return out


class Kept:
    """Word to ids (``now``). What was not asked for since the last half-filling goes when the bound is reached."""

    def __init__(self, most: int):
        self.most = most
        self.now: dict = {}
        self.old: dict = {}

    def missing(self, words: Iterable) -> list:
        """The words that are not known; those known from before are taken over."""
        if len(self.now) > self.most // 2:
            self.old, self.now = self.now, {}
        out, old, now = [], self.old, self.now
        for w in set(words).difference(now):
            ids = old.get(w)
            if ids is None:
                out.append(w)
            else:
                now[w] = ids
        return out


class Encoder:
    """Encodes texts; keeps the ids of words it has met, up to a bound."""

    def __init__(self, path: str, most: int | None = None):
        import public_tokenizers
        import regex

        self.replay = MergeReplay(load_ranks(path))
        self.words_of = regex.compile(public_tokenizers.PATTERN).findall
        self.pieces = Kept(most or KEPT_PIECES)

    def _learn(self, words: Iterable[str]) -> None:
        new = self.pieces.missing(words)
        self.pieces.now.update(zip(new, self.replay.encode_all([w.encode() for w in new]), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self.words_of(t) for t in texts]
        met: set[str] = set()
        for words in cut:
            met.update(words)
        self._learn(met)
        ids = self.pieces.now.__getitem__
        return [b"".join(map(ids, words)) for words in cut]


def encoder(path: str, most: int | None = None) -> Encoder:
    return keep(f"bpe {path} {most}", lambda: Encoder(path, most))


def encode_documents(docs: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` with ``ids`` (binary: little-endian unsigned 32-bit) and ``n_tokens``.

    Every row is encoded, whole; a null text counts as empty (no ids). Repeated
    rows get equal ids, an empty table gives none. Columns named ``ids`` or
    ``n_tokens`` in the input are replaced; all others are kept.
    """
    def make(texts: list[str], _) -> dict[str, list]:
        ids = encoder(path or vocabulary_path()).encode(texts)
        return {"ids": ids, "n_tokens": [len(x) // ID.itemsize for x in ids]}

    return add_columns(docs, {"ids": "binary", "n_tokens": "long"}, text_col, make, keeps=True, chars=CHARS)


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id."""
    ranks = load_ranks(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


def decode(ids: bytes | None, tokens: list[bytes]) -> bytes:
    return b"".join([tokens[i] for i in np.frombuffer(ids or b"", ID).tolist()])


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes that ``ids`` stand for (null ids: none)."""
    encoded = encoded.drop("decoded")
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_bytes(path or vocabulary_path())
        for batch in batches:
            for a in range(0, len(batch), ROWS):
                rows = batch.slice(a, ROWS)
                decoded = [decode(x, tokens) for x in rows.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(decoded, pa.binary())], names=[*rows.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, text_col: str = "text", path: str | None = None, chars: int = CHARS, most: int | None = None) -> DataFrame:
    """``docs`` without its text, with ``ids``, ``n_tokens`` and ``decoded``: both directions in one task.

    The bytes are decoded from the ids alone. Rows as in ``encode_documents``.
    ``chars`` (of a slab) and ``most`` (words kept) trade memory for time; results are the same.
    """
    def make(texts: list[str], _) -> dict[str, list]:
        where = path or vocabulary_path()
        ids, tokens = encoder(where, most).encode(texts), token_bytes(where)
        return {"ids": ids, "n_tokens": [len(x) // ID.itemsize for x in ids], "decoded": [decode(x, tokens) for x in ids]}

    return add_columns(docs, {"ids": "binary", "n_tokens": "long", "decoded": "binary"}, text_col, make, drop=(text_col,), keeps=True, chars=chars)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
