"""External induced sorting of suffixes with their common prefixes.

Suffixes are L (larger than the next one) or S (smaller); an S suffix after an L
one starts a block (LMS). Once the LMS suffixes are in order, all others follow
by two scans: each suffix scanned puts its predecessor behind those with the same
first symbol. What is still to be scanned is a priority queue by first symbol; the
queue of a symbol, first in first out, is that symbol's own stretch of the order
file, between what has been scanned and what has been put there, so a queue needs
no memory and what has passed through it is the result. Its tuples are a suffix
and its common prefix with the one before; the prefix of two induced neighbours is
one more than the least prefix among the suffixes scanned between their sources.

The LMS suffixes are sorted by inducing their blocks, naming them (blocks are
compared symbol by symbol), and recursion on the names, until the names fit into
a quarter of `memory`; then they are sorted there by doubled prefixes. Common
prefixes come back from the recursion in names, which add up to symbols by the
blocks' places; the first two blocks that differ are compared. Names of more than
SYMBOLS kinds are written as several digits each, so the recursion has as few
queues as the first level; where digits would not shorten the string, names stay
as they are.

Everything as long as the text (symbols with their types, LMS places, order,
prefixes) lies in memory-mapped scratch files, unlinked at once so that they end
with the task, as soon as it exceeds a share of `memory`; scans handle pieces of a
wave. A text has less than 2^31 symbols.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

MEMORY, SYMBOLS, WIDE, NAME_BYTES = 256 << 20, 1024, 8, 64
_FAR = np.int32(2**30)


class Scratch:
    """Arrays in memory, or in unlinked files from a 64th of `memory` on. spilled: bytes that went to files."""

    def __init__(self, memory: int = MEMORY):
        self.memory, self.spilled = memory, 0
        self.piece = max(64, memory // 1024)  # items that are worked on at once

    def array(self, n: int, dtype) -> np.ndarray:
        size = n * np.dtype(dtype).itemsize
        if size * 64 <= self.memory:
            return np.empty(n, dtype)
        self.spilled += size
        with tempfile.TemporaryFile() as f:
            f.truncate(size)
            return np.memmap(f, dtype, "r+", shape=(n,))

    def pieces(self, n: int, start: int = 0) -> Iterator[tuple[int, int]]:
        for a in range(start, n, self.piece):
            yield a, min(n, a + self.piece)


class Spool:
    """Bytes that are added bit by bit: in memory, or in an unlinked file from a 32nd of the memory on."""

    def __init__(self, scratch: Scratch):
        self.scratch, self.parts, self.size, self.file = scratch, [], 0, None

    def add(self, data: bytes) -> None:
        self.parts.append(data)
        self.size += len(data)
        if sum(map(len, self.parts[-64:])) * 32 > self.scratch.memory or self.size * 32 > self.scratch.memory and len(self.parts) >= 64:
            self.file = self.file or tempfile.TemporaryFile()  # noqa: SIM115
            self.file.writelines(self.parts)
            self.scratch.spilled += sum(map(len, self.parts))
            self.parts = []

    def all(self, dtype) -> np.ndarray:
        if self.file and self.parts:
            self.file.writelines(self.parts)
            self.parts = []
        if self.file:
            self.file.flush()
            return np.memmap(self.file, dtype, "r")
        return np.frombuffer(b"".join(self.parts), dtype)


class _Scan:
    """One direction of induction. Takes waves in scan order and puts their predecessors of type `small` at the end of their
    symbols' queues: order and prefix (if there is one) from `fill` on, upwards for L and downwards for S."""

    def __init__(self, u: np.ndarray, small: int, order: np.ndarray, prefix: np.ndarray | None, fill: np.ndarray):
        self.u, self.small, self.order, self.prefix, self.fill = u, small, order, prefix, fill
        self.since = np.full(len(fill), -1, np.int32)  # least common prefix scanned since the last push to a symbol

    def wave(self, suffix: np.ndarray, prefix: np.ndarray | None) -> None:
        before = suffix - np.int32(1)
        code = self.u[before]  # of suffix 0: the last one, taken out below
        at = np.flatnonzero((code & 1 == self.small) & (before >= 0))
        if not len(at):
            if prefix is not None:
                np.minimum(self.since, prefix.min(), out=self.since)
            return
        to = code[at] >> 1
        if len(at) > 1:
            order = np.argsort(to, kind="stable")
            at, to = at[order], to[order]
            first = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
            sizes = np.diff(first, append=len(at))
        else:
            first, sizes = np.zeros(1, np.int64), np.ones(1, np.int64)
        targets = to[first]
        step = np.arange(len(at)) - np.repeat(first, sizes)
        place = np.repeat(self.fill[targets], sizes) + (-1 - step if self.small else step)
        self.fill[targets] += -sizes if self.small else sizes
        self.order[place] = before[at]
        if prefix is None:
            return
        start = np.empty(len(at), np.int64)
        start[1:] = at[:-1] + 1
        start[first] = 0
        pad = np.append(prefix, _FAR)
        least = np.minimum.reduceat(pad, np.stack([start, at + 1], 1).reshape(-1))[::2]
        least[first] = np.minimum(least[first], self.since[targets])
        np.minimum(self.since, prefix.min(), out=self.since)
        tail = at[first + sizes - 1] + 1
        self.since[targets] = np.minimum.reduceat(pad, np.stack([tail, np.full(len(tail), len(prefix))], 1).reshape(-1))[::2]
        self.prefix[place] = least + np.int32(1)


class Suffixes:
    """A string of symbols from 0 with the types of its suffixes: u holds 2 * symbol + 1 for S, 2 * symbol for L."""

    def __init__(self, t: np.ndarray, scratch: Scratch):
        self.n, self.scratch = len(t), scratch
        self.symbols = max(int(t[a:b].max()) for a, b in scratch.pieces(len(t))) + 1
        self.u = scratch.array(self.n, np.uint16 if self.symbols < 1 << 15 else np.int32)
        self.counts = np.zeros(self.symbols, np.int64)
        after, small = -1, 0  # the last suffix is L
        for a, b in reversed(list(scratch.pieces(self.n))):
            part = t[a:b].astype(np.int32)
            turn = np.append(part[1:], np.int32(after)) - part
            change = np.where(turn != 0, np.arange(b - a), b - a)
            change = np.minimum.accumulate(change[::-1])[::-1]
            kinds = np.append(turn > 0, bool(small))[change]
            self.u[a:b] = 2 * part + kinds
            self.counts += np.bincount(part, minlength=self.symbols)
            after, small = int(part[0]), int(kinds[0])

    def blocks(self) -> np.ndarray:
        """Places of the LMS suffixes."""
        found = [(a, b, self._starts(a, b)) for a, b in self.scratch.pieces(self.n)]
        out, k = self.scratch.array(sum(int(s.sum()) for _, _, s in found), np.int32), 0
        for a, _, s in found:
            at = np.flatnonzero(s)
            out[k : k + len(at)] = at + a
            k += len(at)
        return out

    def _starts(self, a: int, b: int) -> np.ndarray:
        small = self.u[max(0, a - 1) : b] & 1
        return (small[1:] > small[:-1]) if a else np.append(False, small[1:] > small[:-1])

    def starts(self, suffix: np.ndarray) -> np.ndarray:
        """Which of these suffixes are LMS."""
        return (suffix > 0) & (self.u[suffix] & 1 > self.u[suffix - 1] & 1)

    def run(self, i: int) -> int:
        """Length of the run of one symbol from i on."""
        n, step = 0, 64
        while i + n < self.n:
            part = np.asarray(self.u[i + n : i + n + step]) >> 1
            off = np.flatnonzero(part != self.u[i] >> 1)
            if len(off):
                return n + int(off[0])
            n, step = n + len(part), min(2 * step, self.scratch.piece)
        return n

    def common(self, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
        """Equal symbols from a and b on, compared WIDE at a time; beyond `limit` or the text's end it stops."""
        out, left, step = np.zeros(len(a), np.int64), np.arange(len(a)), np.arange(WIDE)
        while len(left):
            x, y = a[left] + out[left], b[left] + out[left]
            room = np.minimum(WIDE, self.n - np.maximum(x, y))
            cells = lambda p: self.u[np.minimum(p[:, None] + step, self.n - 1)] >> 1
            same = (cells(x) == cells(y)) & (step < room[:, None])
            got = np.where(same.all(1), WIDE, np.argmin(same, 1))
            out[left] += got
            left = left[(got == WIDE) & (out[left] < limit)]
        return out

    def induce(self, lms: np.ndarray, lms_prefix: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
        """Order and common prefixes of all suffixes from those of the LMS suffixes, in order. Without these there are no prefixes."""
        scratch, ends = self.scratch, np.cumsum(self.counts)
        lows = ends - self.counts
        plain = lms_prefix is None
        order, prefix = scratch.array(self.n, np.int32), None if plain else scratch.array(self.n, np.int32)
        scan = _Scan(self.u, 0, order, prefix, lows.copy())
        last = int(self.u[self.n - 1] >> 1)
        order[lows[last]], scan.since[last] = self.n - 1, 0
        scan.fill[last] += 1
        heads = np.zeros(self.symbols, np.int64)
        for a, b in scratch.pieces(len(lms)):
            heads += np.bincount(self.u[lms[a:b]] >> 1, minlength=self.symbols)
        bounds = np.append(0, np.cumsum(heads)).tolist()
        for c, low in enumerate(lows.tolist()):
            at = low
            if (end := int(scan.fill[c])) > low and not plain:
                prefix[low] = 0
            while at < end:
                b = min(end, at + scratch.piece)
                scan.wave(np.asarray(order[at:b]), None if plain else np.asarray(prefix[at:b]))
                at, end = b, int(scan.fill[c])
            for a, b in scratch.pieces(bounds[c + 1], bounds[c]):
                part = None if plain else np.array(lms_prefix[a:b])
                if a == bounds[c] and not plain:
                    part[0] = self._across(order[end - 1], lms[a]) if end > low else 0
                scan.wave(np.asarray(lms[a:b]), part)
        scan = _Scan(self.u, 1, order, prefix, ends.copy())
        larger = lows.tolist()
        for c in range(self.symbols - 1, -1, -1):
            at, low, carry = int(ends[c]), larger[c], 0
            top, back = at, int(scan.fill[c])
            while at > back:  # each has its prefix with the one after it: handed up once it is scanned
                a = max(back, at - scratch.piece)
                suffix, up = np.array(order[a:at])[::-1], None if plain else np.array(prefix[a:at])
                if plain:
                    scan.wave(suffix, None)
                else:
                    if at == top:
                        up[-1] = 0
                    scan.wave(suffix, up[::-1])
                    prefix[a + 1 : min(at + 1, top)] = up[: min(at + 1, top) - a - 1]
                at, back = a, int(scan.fill[c])
            if back < top and not plain:
                carry = self._across(order[back - 1], order[back]) if back > low else 0
                prefix[back] = carry
            for b, a in self._downward(low, back):
                suffix = np.asarray(order[a:b])[::-1]
                if plain:
                    scan.wave(suffix, None)
                    continue
                p = np.asarray(prefix[a:b])[::-1]
                scan.wave(suffix, np.append(np.int32(carry), p[:-1]))
                carry = int(p[-1])
        return order, prefix

    def _across(self, large: int, small: int) -> int:
        """Common prefix of an L and an S suffix of one symbol: the shorter of their runs."""
        return min(self.run(int(large)), self.run(int(small)))

    def _downward(self, low: int, high: int) -> Iterator[tuple[int, int]]:
        while high > low:
            a = max(low, high - self.scratch.piece)
            yield high, a
            high = a


def _names(s: Suffixes, place: np.ndarray, number: np.ndarray, ranked: np.ndarray) -> tuple[np.ndarray, int]:
    """Per LMS block in order of place, the number of different smaller blocks; and how many there are."""
    names, top, before = s.scratch.array(len(place), np.int32), -1, None
    for a, b in s.scratch.pieces(len(place)):
        own = number[ranked[a:b]]
        both = own if before is None else np.append(before, own)
        size = np.where(both + 1 < len(place), place[np.minimum(both + 1, len(place) - 1)] - place[both] + 1, 0)  # the last one equals no other
        x, y = both[:-1], both[1:]
        alike = np.flatnonzero((size[:-1] == size[1:]) & (size[1:] > 0))
        new = np.ones(len(x), bool)
        for i, j in s.scratch.pieces(len(alike)):
            k = alike[i:j]
            new[k] = s.common(place[x[k]].astype(np.int64), place[y[k]].astype(np.int64), int(size[k].max())) < size[k]
        rank = np.cumsum(np.append(True, new) if before is None else new) + top
        names[own] = rank
        top, before = int(rank[-1]), own[-1]
    return names, top + 1


def _doubled(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order and common prefixes in memory, by doubled prefixes."""
    n, step = len(t), 1
    ranks = [np.unique(t, return_inverse=True)[1].astype(np.int32)]
    while True:
        key = (ranks[-1].astype(np.int64) + 1) * (n + 2)
        key[: max(0, n - step)] += ranks[-1][step:] + np.int64(1)
        values, rank = np.unique(key, return_inverse=True)
        if len(values) == n:
            break
        ranks.append(rank.astype(np.int32))
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    x, y, found = order[:-1], order[1:], np.zeros(n - 1, np.int64)
    for k in range(len(ranks) - 1, -1, -1):  # ranks[k]: equal for equal 2^k first symbols
        a, b = x + found, y + found
        ok = np.flatnonzero(np.maximum(a, b) + (1 << k) <= n)
        found[ok] += (ranks[k][a[ok]] == ranks[k][b[ok]]) << k
    return order, np.append(0, found).astype(np.int32)


def _digits(names: np.ndarray, kinds: int, scratch: Scratch) -> tuple[np.ndarray, int]:
    """The names, or each as digits with at most SYMBOLS kinds if that leaves a string with fewer blocks; and the digits of a name."""
    if kinds <= SYMBOLS:
        return names, 1
    least = 2
    while SYMBOLS**least < kinds:
        least += 1
    for k in (least, least + 1):
        base = int(np.ceil(kinds ** (1 / k)))
        base += base**k < kinds
        out, starts, last = scratch.array(k * len(names), np.int32), 0, 0
        for a, b in scratch.pieces(len(names)):
            part = names[a:b].astype(np.int64)
            digits = np.stack([part // base**i % base for i in range(k - 1, -1, -1)], 1).reshape(-1)
            out[k * a : k * b] = digits
            up = np.diff(np.append(last, digits)) > 0
            starts += int((up[1:] & ~up[:-1]).sum())  # about the blocks of the string
            last = int(digits[-1])
        if starts < 0.9 * len(names):
            return out, k
    return names, 1


def suffix_order(t: np.ndarray, limit: int = 2**30, scratch: Scratch | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of t (symbols from 0) in order, and the common prefix of each with the one before, exact below `limit`."""
    n, scratch = len(t), scratch or Scratch()
    if n < 2:
        return np.arange(n, dtype=np.int32), np.zeros(n, np.int32)
    s = Suffixes(t, scratch)
    place = s.blocks()
    if not len(place):
        return s.induce(place, np.zeros(0, np.int32))
    number = scratch.array(n, np.int32)  # of the LMS suffix at a place
    for a, b in scratch.pieces(len(place)):
        number[place[a:b]] = np.arange(a, b, dtype=np.int32)
    # LMS blocks in order, by inducing from first symbols alone.
    by_symbol = scratch.array(len(place), np.int32)
    by_symbol[:] = place[np.argsort(s.u[place], kind="stable")]
    order, prefix = s.induce(by_symbol, None)
    ranked, k = by_symbol, 0
    for a, b in scratch.pieces(n):
        part = np.asarray(order[a:b])
        part = part[s.starts(part)]
        ranked[k : k + len(part)] = part
        k += len(part)
    del order, prefix
    names, kinds = _names(s, place, number, ranked)
    ranked_prefix = scratch.array(len(place), np.int32)
    ranked_prefix[:] = 0
    if kinds < len(place):
        fits = 4 * NAME_BYTES * len(place) <= scratch.memory
        reduced, digits = (names, 1) if fits else _digits(names, kinds, scratch)
        inner, inner_prefix = _doubled(np.asarray(reduced)) if fits else suffix_order(reduced, digits * limit, scratch)
        k, low = 0, 2**30  # low: the least prefix since the last whole name
        for a, b in scratch.pieces(len(reduced)):
            at, p = np.asarray(inner[a:b]), np.append(np.asarray(inner_prefix[a:b]), _FAR)
            whole = np.flatnonzero(at % digits == 0)
            if len(whole):
                least = np.minimum.reduceat(p, np.stack([np.append(0, whole[:-1] + 1), whole + 1], 1).reshape(-1))[::2]
                least[0] = min(int(least[0]), low)
                ranked[k : k + len(whole)], ranked_prefix[k : k + len(whole)] = place[at[whole] // digits], least // digits
                low, k = int(p[whole[-1] + 1 :].min()), k + len(whole)
            else:
                low = min(low, int(p.min()))
        del inner, inner_prefix
    # From equal names to symbols, and on to the first that differs.
    for a, b in scratch.pieces(len(place), 1):
        x, y = ranked[a - 1 : b - 1].astype(np.int64), ranked[a:b].astype(np.int64)
        known = np.asarray(ranked_prefix[a:b])
        skip = place[np.minimum(number[x] + known, len(place) - 1)] - x
        ranked_prefix[a:b] = np.minimum(skip + s.common(x + skip, y + skip, limit), 2**30)
    return s.induce(ranked, ranked_prefix)
