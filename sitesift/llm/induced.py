"""Sorted suffixes of one long string with common prefixes, by external induced sorting.

The suffixes that begin at a left-most S position (a character smaller than what
follows and than what precedes it) are sorted first: their substrings up to the
next such position are sorted by one round of induction and named, the string of
the names is sorted by recursion (in memory, once it fits), and a second round of induction sorts all
suffixes from them.

One round takes the suffixes in order and puts, for each, the suffix one to its
left into a priority queue of tuples (character, position, common prefix). Tuples
enter in the order of the suffixes that induce them, so equal characters stay first
in, first out: the queue keeps one run per range of characters, in memory up to a
bound and on disk beyond it, and sorts a range only when its turn comes. Tuples are
taken many at a time, up to the first that something induced before it could precede.

A tuple's common prefix with the one before it under the same character is one
more than the least common prefix among the suffixes since then. Prefixes are
counted up to ``cap`` only, so that least value is found in a table with the last
place of each value. Suffixes whose first ``cap`` characters are equal come out
side by side, in any order.

Sorted tuples are written to tapes, in memory up to a bound and in the scratch
folder beyond it; the string, its names and the marks are arrays that lie there too
when they are large. Scratch files belong to one task, which deletes them.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np

_ROW = np.dtype([("char", np.int32), ("pos", np.int64), ("lcp", np.uint16)])
_CHUNK = 1 << 18
#: Ranges of characters that a queue keeps apart, besides frequent single characters.
_RANGES = 64
_LEAST, _MOST = 1 << 10, 1 << 16


class Scratch:
    """Files of one sort in ``folder``, and ``memory``, the bytes kept in memory for queues and tapes at once."""

    def __init__(self, folder: str, memory: int):
        self.folder, self.memory, self.used, self.files = folder, memory, 0, 0
        self.tapes: dict[int, Tape] = {}

    def path(self) -> str:
        self.files += 1
        return os.path.join(self.folder, f"part{self.files}")

    def array(self, n: int, dtype) -> np.ndarray:
        """Zeros; on disk if large against the bound."""
        if n * np.dtype(dtype).itemsize <= self.memory // 4:
            return np.zeros(n, dtype)
        return np.memmap(self.path(), dtype, "w+", shape=(n,))

    def grew(self, n: int) -> None:
        self.used += n
        if self.used > self.memory:
            for tape in list(self.tapes.values()):
                tape.spill()


class Tape:
    """Rows in the order in which they were added; read in pieces either way, or taken from the front."""

    def __init__(self, scratch: Scratch):
        self.scratch, self.parts, self.file = scratch, [], None
        self.filed = self.held = self.taken = 0

    def __len__(self) -> int:
        return self.filed + self.held - self.taken

    def add(self, rows: np.ndarray) -> None:
        if len(rows):
            self.scratch.tapes[id(self)] = self
            self.parts.append(rows)
            self.held += len(rows)
            self.scratch.grew(rows.nbytes)

    def spill(self) -> None:
        self.scratch.tapes.pop(id(self), None)
        if self.parts:
            self.file = self.file or self.scratch.path()
            with open(self.file, "ab") as f:
                for rows in self.parts:
                    rows.tofile(f)
            self._free()

    def _free(self) -> None:
        self.scratch.used -= sum(p.nbytes for p in self.parts)
        self.filed, self.held, self.parts = self.filed + self.held, 0, []

    def rows(self, a: int, b: int) -> np.ndarray:
        out = []
        if a < self.filed:
            out.append(np.fromfile(self.file, _ROW, min(b, self.filed) - a, offset=a * _ROW.itemsize))
        if b > self.filed and self.held:
            if len(self.parts) > 1:
                self.parts = [np.concatenate(self.parts)]
            out.append(self.parts[0][max(0, a - self.filed):b - self.filed])
        return np.concatenate(out) if out else np.zeros(0, _ROW)

    def take(self, most: int) -> np.ndarray:
        """The first rows not taken yet."""
        end = min(self.taken + most, self.filed + self.held)
        out = self.rows(self.taken, end)
        self.taken = end
        if end == self.filed + self.held:
            self.drop()
        return out

    def pieces(self, backward: bool = False) -> Iterator[np.ndarray]:
        n = self.filed + self.held
        for k in range(0, n, _CHUNK):
            yield self.rows(max(0, n - k - _CHUNK), n - k)[::-1] if backward else self.rows(k, min(n, k + _CHUNK))

    def drop(self) -> None:
        self.scratch.tapes.pop(id(self), None)
        self.scratch.used -= sum(p.nbytes for p in self.parts)
        self.parts = []
        if self.file:
            os.remove(self.file)
        self.file, self.filed, self.held, self.taken = None, 0, 0, 0


def reversed_rows(tape: Tape) -> Iterator[np.ndarray]:
    """The rows last to first, each with its common prefix with the row read before it."""
    carried = 0
    for rows in tape.pieces(backward=True):
        rows = rows.copy()
        lcp = rows["lcp"].copy()
        rows["lcp"][1:], rows["lcp"][0] = lcp[:-1], carried
        carried = lcp[-1]
        yield rows


def _ranges(counts: np.ndarray, memory: int) -> np.ndarray:
    """First character of each range: about equal sums of counts; frequent characters stand alone."""
    total = sum(int(counts[a:a + _CHUNK].sum()) for a in range(0, len(counts), _CHUNK))
    target = max(_LEAST, min(total // _RANGES, memory // (8 * _ROW.itemsize)))
    first, held, part_before, alone_before = [], 0, -1, False
    for a in range(0, len(counts), _CHUNK):
        some = counts[a:a + _CHUNK]
        upto = held + np.cumsum(some)
        part, alone = (upto - some) // target, some > target
        new = (part != np.r_[part_before, part[:-1]]) | alone | np.r_[alone_before, alone[:-1]]
        first.append(a + np.flatnonzero(new))
        held, part_before, alone_before = int(upto[-1]), int(part[-1]), bool(alone[-1])
    return np.concatenate(first)


class Queue:
    """Monotone priority queue of rows by (char, order of entry); one tape for each range of characters."""

    def __init__(self, counts: np.ndarray, scratch: Scratch):
        self.first = np.r_[_ranges(counts, scratch.memory), len(counts)]
        self.tapes = [Tape(scratch) for _ in self.first[1:]]

    def add(self, rows: np.ndarray) -> None:
        """Rows sorted by char."""
        part = np.searchsorted(self.first, rows["char"], "right") - 1
        cuts = np.flatnonzero(np.diff(part)) + 1
        for piece, at in zip(np.split(rows, cuts), part[np.r_[0, cuts]] if len(rows) else []):
            self.tapes[at].add(piece)

    def in_order(self) -> Iterator[np.ndarray]:
        """All rows, when nothing is added any more."""
        for r, tape in enumerate(self.tapes):
            while len(tape):
                rows = tape.take(_CHUNK if self.first[r + 1] - self.first[r] == 1 else len(tape))
                yield rows[np.argsort(rows["char"], kind="stable")]


def _window_least(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of values[a..b], both ends included."""
    out = np.zeros(len(a), values.dtype)
    level = np.frexp(b - a + 1)[1] - 1  # exponent of the greatest power of two in the length
    table = values
    for k in range(int(level.max(initial=-1)) + 1):
        if k:
            half = 1 << (k - 1)
            table = np.minimum(table[:-half], table[half:])
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[a[at]], table[b[at] - (1 << k) + 1])
    return out


class _Seeds:
    """A stream of sorted rows, looked at before they are taken."""

    def __init__(self, pieces: Iterator[np.ndarray]):
        self.pieces, self.rows = pieces, np.zeros(0, _ROW)

    def look(self, most: int, below: int) -> tuple[np.ndarray, bool]:
        """Up to ``most`` of the next rows with char < below; whether there may be more of them."""
        while len(self.rows) < most:
            piece = next(self.pieces, None)
            if piece is None:
                break
            self.rows = np.concatenate([self.rows, piece])
        n = int(np.searchsorted(self.rows["char"][:most], below))
        return self.rows[:n], n == most

    def skip(self, n: int) -> None:
        self.rows = self.rows[n:]


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes of pairs of suffixes that differ soon."""
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    for k in range(cap):
        i, j = a[live] + k, b[live] + k
        fits = (i < len(text)) & (j < len(text))
        live = live[fits]
        live = live[text[i[fits]] == text[j[fits]]]
        if not len(live):
            break
        out[live] = k + 1
    return out


def induce(text: np.ndarray, flip: int | None, seeds: Iterator[np.ndarray], counts: np.ndarray, scratch: Scratch, cap: int,
           keep_seeds: bool, seam: int | None = None) -> Tape:
    """One round: the seeds and all suffixes that they induce, in order.

    Characters are compared as they are, or as ``flip`` minus them for the descending
    order. Among suffixes with one first character the induced come before the
    seeds; the last of the ones and the first of the others go on differently after a
    run of that character, so their common prefix is looked up in the text (or is
    ``seam``, where seeds stand for their first character only).
    ``counts``: induced suffixes by character.
    """
    queue, out, ahead = Queue(counts, scratch), Tape(scratch), _Seeds(seeds)
    last = scratch.array(len(counts), np.int64)  # 1 + place of the last row that induced the character
    latest = np.full(cap + 1, -1, np.int64)  # last place with a common prefix of at most this
    base, batch = 0, _LEAST
    before = (-1, -1, False)  # char, position, seed? of the row before
    none = np.zeros(0, _ROW)
    for r, tape in enumerate(queue.tapes):
        end = int(queue.first[r + 1])
        single = end - queue.first[r] == 1
        main, extra = none, none
        if not single and len(tape):
            main = tape.take(len(tape))
            main = main[np.argsort(main["char"], kind="stable")]
        while True:
            if single and not len(main) and len(tape):
                main = tape.take(_MOST)
            sources = [main[:batch], extra[:batch]]
            more = [len(main) > batch or (single and len(tape) > 0), len(extra) > batch]
            rows, further = ahead.look(batch, end)
            sources.append(rows)
            more.append(further)
            key = np.concatenate([s["char"] * np.int64(3) + k for k, s in enumerate(sources)])
            if not len(key):
                break
            limit = min((int(s["char"][-1]) * 3 + k for k, s in enumerate(sources) if more[k]), default=1 << 62)
            order = np.argsort(key, kind="stable")
            key = key[order]
            n = int(np.searchsorted(key, limit, "right"))
            rows, key = np.concatenate(sources)[order[:n]], key[:n]
            char, pos, seed = rows["char"], rows["pos"], key % 3 == 2
            left = text[np.maximum(pos - 1, 0)].astype(np.int64)
            if flip is not None:
                left = flip - left
            induces = (pos > 0) & ((left > char) | ((left == char) & ~seed))
            first = np.minimum.accumulate(np.where(induces, left * 3 + 1, 1 << 62))
            n = int(np.searchsorted(-np.r_[1 << 62, first[:-1]] + key, 0, "right")) if n else 0
            # rows up to the first that an induced row could precede (first falls, key rises)
            rows, char, pos, seed, left, induces = rows[:n], char[:n], pos[:n], seed[:n], left[:n], induces[:n]
            n_main, n_extra, n_seeds = np.bincount(key[:n] % 3, minlength=3)
            main, extra = main[n_main:], extra[n_extra:]
            ahead.skip(n_seeds)
            # common prefixes with the row before
            prev_char, prev_pos, prev_seed = np.r_[before[0], char[:-1]], np.r_[before[1], pos[:-1]], np.r_[before[2], seed[:-1]]
            lcp = np.where(char == prev_char, rows["lcp"], 0).astype(np.uint16)
            meet = np.flatnonzero((char == prev_char) & seed & ~prev_seed)
            if len(meet):
                lcp[meet] = _common(text, prev_pos[meet], pos[meet], cap) if seam is None else seam
            before = int(char[-1]), int(pos[-1]), bool(seed[-1])
            rows["lcp"] = lcp
            out.add(rows if keep_seeds else rows[~seed])
            # induced rows
            at = np.flatnonzero(induces)
            if len(at):
                at = at[np.argsort(left[at], kind="stable")]
                to = left[at]
                repeat = np.r_[False, to[1:] == to[:-1]]
                value = np.zeros(len(at), np.int64)
                again = np.flatnonzero(repeat)
                value[again] = 1 + _window_least(lcp, at[again - 1] + 1, at[again]).astype(np.int64)
                new = np.flatnonzero(~repeat)
                since = last[to[new]] - 1
                least = np.minimum(np.searchsorted(latest, since, "right"), np.minimum.accumulate(lcp)[at[new]])
                value[new] = np.where(since >= 0, 1 + least, 0)
                last[to[np.r_[new[1:] - 1, len(to) - 1]]] = base + at[np.r_[new[1:] - 1, len(to) - 1]] + 1
                made = np.zeros(len(at), _ROW)
                made["char"], made["pos"], made["lcp"] = to, pos[at] - 1, np.minimum(value, cap)
                if not single:
                    mine = int(np.searchsorted(to, end))
                    if mine:
                        extra = np.concatenate([extra, made[:mine]])
                        extra = extra[np.argsort(extra["char"], kind="stable")]
                    made = made[mine:]
                queue.add(made)
            tail = np.minimum.accumulate(lcp[::-1])  # falling; the last place of each value
            k = np.searchsorted(-tail.astype(np.int64), -np.arange(cap + 1), "left")
            latest = np.where(k < n, base + n - 1 - k, latest)
            base += n
            batch = min(_MOST, batch * 2) if n >= batch else max(_LEAST, batch // 2) if n < batch // 4 else batch
    return out


def _types(text: np.ndarray, sigma: int, scratch: Scratch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Left-most S positions, marks of them, and the numbers of L and S suffixes by character."""
    n = len(text)
    star = scratch.array(n, bool)
    larger, smaller = scratch.array(sigma, np.int64), scratch.array(sigma, np.int64)
    sign, nxt = 1, None  # type of the position right of the chunk, and its character
    for a in range((n - 1) // _CHUNK * _CHUNK, -1, -_CHUNK):
        b = min(n, a + _CHUNK)
        chars = text[a:b].astype(np.int64)
        diff = np.r_[np.sign(np.diff(chars)), 1 if nxt is None else np.sign(nxt - chars[-1])]
        places = np.minimum.accumulate(np.where(diff != 0, np.arange(b - a), b - a)[::-1])[::-1]
        is_s = np.r_[diff, sign][places] > 0
        if nxt is not None and sign > 0 and not is_s[-1]:
            star[b] = True
        star[a + 1:b] = is_s[1:] & ~is_s[:-1]
        for into, some in ((larger, chars[~is_s]), (smaller, chars[is_s])):
            which, times = np.unique(some, return_counts=True)
            into[which] += times
        sign, nxt = (1 if is_s[0] else -1), chars[0]
    places, k = scratch.array(sum(int(star[a:a + _CHUNK].sum()) for a in range(0, n, _CHUNK)), np.int64), 0
    for a in range(0, n, _CHUNK):
        here = a + np.flatnonzero(star[a:a + _CHUNK])
        places[k:k + len(here)] = here
        k += len(here)
    return places, star, larger, smaller


def _least_table(values: np.ndarray, scratch: Scratch) -> list[np.ndarray]:
    table, size = [values], 1
    while 2 * size <= len(values):
        row = scratch.array(len(values) - 2 * size + 1, values.dtype)
        np.minimum(table[-1][:-size], table[-1][size:], out=row)
        table.append(row)
        size *= 2
    return table


def _in_memory(text: np.ndarray, scratch: Scratch, cap: int) -> Tape:
    """What ``sort_suffixes`` gives, by doubling the compared length; the recursion ends here once the names fit."""
    n, out = len(text), Tape(scratch)
    rank = np.unique(text, return_inverse=True)[1]
    ranks, h = [rank.astype(np.int32)], 1
    while h < cap and int(rank.max()) + 1 < n:
        key = rank * np.int64(n + 1)
        key[:-h] += rank[h:] + 1
        rank = np.unique(key, return_inverse=True)[1]
        ranks.append(rank.astype(np.int32))
        h *= 2
    order = np.argsort(rank, kind="stable")[:0:-1]  # without the last suffix, which is the least
    rows = np.zeros(n - 1, _ROW)
    rows["pos"] = order
    for a in range(1, n - 1, _CHUNK):
        i, j = order[a - 1:min(n - 2, a + _CHUNK - 1)].copy(), order[a:a + _CHUNK].copy()
        shared = np.zeros(len(i), np.int64)
        for k in range(len(ranks) - 1, -1, -1):
            more = (ranks[k][i] == ranks[k][j]) * (1 << k)
            shared += more
            i += more
            j += more
        rows["lcp"][a:a + _CHUNK] = np.minimum(shared, cap)
    out.add(rows)
    return out


def sort_suffixes(text: np.ndarray, sigma: int, scratch: Scratch, cap: int) -> Tape:
    """All suffixes but the last in descending order of their first ``cap`` characters, each with the
    common prefix (up to ``cap``) that it shares with the one before. ``text`` holds characters below
    ``sigma`` and ends with its only 0."""
    if len(text) < 2:
        return Tape(scratch)
    places, star, n_larger, n_smaller = _types(text, sigma, scratch)
    k = len(places) - 1  # without the last position

    def round_of(seeds: Iterator[np.ndarray], seam: int | None = None) -> Tape:
        larger = induce(text, None, seeds, n_larger, scratch, cap, False, seam)

        def flipped():
            for rows in reversed_rows(larger):
                rows["char"] = sigma - 1 - rows["char"]
                yield rows

        out = induce(text, sigma - 1, flipped(), n_smaller[::-1], scratch, cap, True)
        larger.drop()
        return out

    def at(positions: np.ndarray) -> np.ndarray:
        rows = np.zeros(len(positions), _ROW)
        rows["char"], rows["pos"] = text[positions], positions
        return rows

    if not k:
        return round_of(iter([at(places)]))

    # the substrings between left-most S positions, sorted by a round from their last characters
    stars = scratch.array(sigma, np.int64)
    for a in range(0, k + 1, _CHUNK):
        which, times = np.unique(text[places[a:a + _CHUNK]], return_counts=True)
        stars[which] += times
    unsorted = Queue(stars, scratch)
    for a in range(0, k + 1, _CHUNK):
        rows = at(places[a:a + _CHUNK])
        rows["lcp"] = 1
        unsorted.add(rows[np.argsort(rows["char"], kind="stable")])
    substrings = round_of(unsorted.in_order(), 1)
    names, steps = scratch.array(k + 1, np.int64), []
    number, least, length = 0, cap, 0
    for rows in substrings.pieces():  # descending
        mine = np.flatnonzero(star[rows["pos"]])
        if not len(mine):
            least = min(least, int(rows["lcp"].min()))
            continue
        shared = np.minimum.reduceat(rows["lcp"][:mine[-1] + 1], np.r_[0, mine[:-1] + 1])  # over the rows since the one before
        shared[0] = min(int(shared[0]), least)
        least = int(rows["lcp"][mine[-1] + 1:].min(initial=cap))
        where = np.searchsorted(places, rows["pos"][mine])
        size = places[where + 1] - places[where] + 1
        new = shared < np.minimum(cap, np.maximum(size, np.r_[length, size[:-1]]))
        if not number:
            new[0] = True
        length = int(size[-1])
        names[where] = number + np.cumsum(new)
        steps.append(shared[new])
        number += int(new.sum())
    substrings.drop()
    names[:k] = number + 1 - names[:k]  # ascending from 1; the last position is 0
    step = scratch.array(number + 1, np.uint16)  # common prefix of a name and the one below
    step[2:] = np.concatenate(steps)[1:][::-1]
    table = _least_table(step, scratch)

    def between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The common prefix of two different substrings by their names: the least step from one to the other."""
        high = np.maximum(a, b)
        low = np.minimum(np.minimum(a, b) + 1, high)
        level = np.frexp(np.maximum(high - low + 1, 1))[1] - 1
        out = np.zeros(len(a), np.int64)
        for j in np.unique(level):
            m = np.flatnonzero(level == j)
            out[m] = np.minimum(table[j][low[m]], table[j][high[m] - (1 << j) + 1])
        return np.where(a == b, cap, out)

    def size(which: np.ndarray) -> np.ndarray:
        return places[np.minimum(which + 1, k)] - places[which] + 1

    if number == k:
        ordered = Tape(scratch)  # all differ: their names are their order
        where = scratch.array(k + 1, np.int64)
        where[names] = np.arange(k + 1)
        for end in range(k + 1, 1, -_CHUNK):
            rows = np.zeros(end - max(1, end - _CHUNK), _ROW)
            rows["pos"] = where[max(1, end - _CHUNK):end][::-1]
            ordered.add(rows)
    elif 60 * k <= scratch.memory:
        ordered = _in_memory(names, scratch, (cap + 1) // 2)  # a name moves on by two characters or more
    else:
        ordered = sort_suffixes(names, number + 1, scratch, (cap + 1) // 2)

    def sorted_seeds():
        yield at(places[-1:])
        prev = k
        for rows in reversed_rows(ordered):
            b, same = rows["pos"], rows["lcp"].astype(np.int64)
            a = np.r_[prev, b[:-1]]
            same = np.minimum(same, np.minimum(k - a, k - b))
            passed = np.minimum(places[a + same] - places[a], places[b + same] - places[b])
            shared = between(names[a + same], names[b + same])
            # a substring that ends inside the other goes on with the run of its last character
            on = np.flatnonzero((passed < cap) & (shared > 0) & (shared >= np.minimum(size(a + same), size(b + same))))
            shared[on] += _common(text, places[a + same][on] + shared[on], places[b + same][on] + shared[on], cap)
            made = at(places[b])
            made["lcp"] = np.minimum(cap, passed + shared)
            prev = int(b[-1])
            yield made

    out = round_of(sorted_seeds())
    ordered.drop()
    return out
