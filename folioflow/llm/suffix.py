"""External induced suffix sorting with common-prefix values, for texts that need not fit into memory.

The text lies in a file. Suffixes are induced from the sorted left-most S suffixes: first all L suffixes in ascending
order, then all S suffixes in descending order. What waits to be visited is kept in a priority queue by first character:
in each pass a suffix is only ever put behind those already queued for its character, so a first-in-first-out list for
every character, written to disk when memory is used up, is an exact priority queue. A queue entry is the tuple of
position and common prefix with the entry before it. That value is induced too: two suffixes put one after the other
into a list share one character more than the least of the common prefixes between the suffixes they came from.

Orders and common prefixes are exact up to `depth` characters, which is all that the search for repeats of that length
needs. The seeds are sorted by recursion on disk: too many for memory are dealt to one file for each next character, and
every file is sorted by itself, in memory if it fits (refining groups of equal suffixes eight characters at a time), else by
the character after. What cannot fit is never held: text, kinds, seeds and result are files that are mapped or read in
blocks, and a visit is a block of tuples in numpy.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections import deque
from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 19
ENTRY = np.dtype([("pos", "<i8"), ("lcp", "u1")])
END, BREAK, SHIFT = 0, 1, 2  # the last character, the one between segments, and what is added to a byte (UTF-8 ends at 0xF4)
FREE = 255


class Queues:
    """A first-in-first-out list of tuples for every character; in files once `room` tuples wait in memory."""

    def __init__(self, folder: str, name: str, room: int) -> None:
        self.path = lambda c: os.path.join(folder, f"{name}.{c}")
        self.room, self.held = room, 0
        self.parts: dict[int, list[np.ndarray]] = {}

    def push(self, c: int, entries: np.ndarray) -> None:
        self.parts.setdefault(c, []).append(entries)
        self.held += len(entries)
        if self.held > self.room:
            for k, parts in self.parts.items():
                with open(self.path(k), "ab") as f:
                    for p in parts:
                        p.tofile(f)
            self.parts, self.held = {}, 0

    def blocks(self, c: int) -> list[tuple[int, int] | np.ndarray]:
        on_disk = os.path.getsize(self.path(c)) // ENTRY.itemsize if os.path.exists(self.path(c)) else 0
        parts = self.parts.get(c, [])
        held = np.concatenate(parts) if len(parts) > 1 else parts[0] if parts else np.zeros(0, ENTRY)
        self.parts.pop(c, None)
        if len(held):
            self.parts[c] = [held]
        return [(lo, min(BLOCK, on_disk - lo)) for lo in range(0, on_disk, BLOCK)] + [held[lo : lo + BLOCK] for lo in range(0, len(held), BLOCK)]

    def read(self, c: int, block) -> np.ndarray:
        if isinstance(block, tuple):
            return np.fromfile(self.path(c), ENTRY, block[1], offset=block[0] * ENTRY.itemsize)
        return block

    def drop(self, c: int) -> None:
        self.held -= sum(map(len, self.parts.pop(c, [])))
        if os.path.exists(self.path(c)):
            os.remove(self.path(c))


class Induction:
    """One pass: visits tuples in order and puts the suffixes before them into the queues of their characters."""

    def __init__(self, text: np.ndarray, kind: np.ndarray, wanted: bool, queues: Queues, depth: int) -> None:
        self.text, self.kind, self.wanted, self.queues, self.depth = text, kind, wanted, queues, depth
        self.least = np.full(256, FREE, np.uint8)  # common prefix of the sources since the last entry for a character
        self.begun = np.zeros(256, bool)

    def visit(self, pos: np.ndarray, lcp: np.ndarray, own: int) -> np.ndarray:
        """Returns the new entries for `own`, the character being visited; the others go to their queues."""
        before = pos - 1
        ok = before >= 0
        ok[ok] = self.kind[before[ok]] == self.wanted
        at = np.flatnonzero(ok)
        total = lcp.min() if len(lcp) else FREE
        if not len(at):
            self.least = np.minimum(self.least, total)
            return np.zeros(0, ENTRY)
        target = self.text[before[at]]
        order = np.argsort(target, kind="stable")
        at, target = at[order], target[order]
        first = np.empty(len(at), bool)
        first[0], first[1:] = True, target[1:] != target[:-1]
        low = np.empty(len(at), np.uint8)
        head = np.flatnonzero(first)
        sofar = np.minimum.accumulate(lcp)
        low[head] = np.minimum(self.least[target[head]], sofar[at[head]])
        rest = np.flatnonzero(~first)
        if len(rest):
            low[rest] = _range_min(lcp, at[rest - 1] + 1, at[rest])
        new = np.empty(len(at), ENTRY)
        new["pos"] = before[at]
        new["lcp"] = np.minimum(low.astype(np.int16) + 1, self.depth)
        starting = head[~self.begun[target[head]]]
        new["lcp"][starting] = 0
        last = np.append(head[1:], len(at)) - 1
        after = np.append(np.minimum.accumulate(lcp[::-1])[::-1], np.uint8(FREE))[at[last] + 1]
        self.least = np.minimum(self.least, total)
        self.least[target[head]] = after
        self.begun[target[head]] = True
        mine = np.zeros(0, ENTRY)
        for c, lo, hi in zip(target[head].tolist(), head.tolist(), (last + 1).tolist(), strict=True):
            if c == own:
                mine = new[lo:hi]
            else:
                self.queues.push(c, new[lo:hi])
        return mine


def _range_min(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """min(x[lo..hi]), both ends included, by a table of powers of two."""
    level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
    out = np.empty(len(lo), np.uint8)
    row = x
    for k in range(int(level.max()) + 1):
        if k:
            row = np.minimum(row[: len(row) - (1 << (k - 1))], row[1 << (k - 1) :])
        m = np.flatnonzero(level == k)
        out[m] = np.minimum(row[lo[m]], row[hi[m] - (1 << k) + 1])
    return out


def _words(text: np.ndarray) -> np.ndarray:
    """Eight characters from every place on, as a number that sorts like them."""
    return np.ndarray((len(text) - 7,), ">u8", text, 0, (1,))


def sorted_seeds(text: np.ndarray, seeds: np.ndarray, depth: int, folder: str, room: int, known: int = 0) -> Iterator[np.ndarray]:
    """Seeds (an array or a mapped file) in the order of their suffixes, in pieces of at most `room`; `known` characters agree already."""
    while len(seeds) > room and known < depth:
        counts = np.zeros(256, np.int64)
        for lo in range(0, len(seeds), BLOCK):
            counts += np.bincount(text[seeds[lo : lo + BLOCK] + known], minlength=256)
        known += 1
        if np.count_nonzero(counts) > 1:
            break
    else:
        if known >= depth:
            yield from (np.array(seeds[lo : lo + room]) for lo in range(0, len(seeds), room))
        elif len(seeds):
            yield sort_seeds(text, np.array(seeds), depth)
        return
    here = tempfile.mkdtemp(prefix="seeds-", dir=folder)
    for lo in range(0, len(seeds), BLOCK):
        part = seeds[lo : lo + BLOCK]
        char = text[part + known - 1]
        order = np.argsort(char, kind="stable")
        ends = np.cumsum(np.bincount(char, minlength=256))
        for c in np.flatnonzero(np.diff(ends, prepend=0)).tolist():
            with open(os.path.join(here, str(c)), "ab") as f:
                part[order[ends[c - 1] if c else 0 : ends[c]]].tofile(f)
    for c in np.flatnonzero(counts).tolist():
        yield from sorted_seeds(text, np.memmap(path := os.path.join(here, str(c)), np.int64, "r"), depth, folder, room, known)
        os.remove(path)
    os.rmdir(here)


def sort_seeds(text: np.ndarray, seeds: np.ndarray, depth: int) -> np.ndarray:
    """Seeds in the order of their suffixes, exact to `depth` characters; groups of equal ones are refined by the next eight."""
    words = _words(text)
    key = words[seeds].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    seeds, key = seeds[order], key[order]
    rank = np.cumsum(np.append(False, key[1:] != key[:-1]))
    open_ = np.arange(len(seeds))
    for off in range(8, depth, 8):
        same = np.append(False, rank[1:] == rank[:-1])
        open_ = np.flatnonzero(same | np.append(same[1:], False))
        if not len(open_):
            break
        key = words[seeds[open_] + off].astype(np.uint64)
        order = np.lexsort((key, rank[open_]))
        part, key, r = seeds[open_][order], key[order], rank[open_][order]
        seeds[open_] = part
        step = np.append(False, (r[1:] == r[:-1]) & (key[1:] != key[:-1]))
        # a new rank begins at the step and keeps the place in the list as its number
        place = np.where(step | np.append(True, r[1:] != r[:-1]), open_, 0)
        rank = rank_by_place(rank, open_, np.maximum.accumulate(place))
    return seeds


def rank_by_place(rank: np.ndarray, at: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Ranks renumbered by the first place of each group, with those of `at` replaced."""
    first = np.append(True, rank[1:] != rank[:-1])
    out = np.maximum.accumulate(np.where(first, np.arange(len(rank)), 0))
    out[at] = place
    return out


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    words = _words(text)
    out = np.full(len(a), depth, np.uint8)
    live = np.arange(len(a))
    for off in range(0, depth, 8):
        x = words[a[live] + off].astype(np.uint64) ^ words[b[live] + off].astype(np.uint64)
        ended = x != 0
        lead = sum((x[ended] < np.uint64(1 << (64 - 8 * k))).astype(np.int64) for k in range(1, 8))
        out[live[ended]] = np.minimum(off + lead, depth)
        live = live[~ended]
        if not len(live):
            break
    return out


def suffix_kinds(text: np.ndarray, path: str) -> np.ndarray:
    """True where a suffix is smaller than the next one (S), in blocks from the end; a mapped file."""
    kind = np.memmap(path, bool, "w+", shape=len(text))
    kind[-1] = True
    after = True
    for hi in range(len(text) - 1, 0, -BLOCK):
        lo = max(0, hi - BLOCK)
        a, b = text[lo:hi].astype(np.int16), text[lo + 1 : hi + 1].astype(np.int16)
        differs = a != b
        at = np.where(differs, np.arange(hi - lo), hi - lo)
        nxt = np.minimum.accumulate(at[::-1])[::-1]
        s = np.where(nxt < hi - lo, a[np.minimum(nxt, hi - lo - 1)] < b[np.minimum(nxt, hi - lo - 1)], after)
        kind[lo:hi] = s
        after = bool(s[0])
    return kind


def _run(text: np.ndarray, p: int, depth: int) -> int:
    part = np.asarray(text[p : p + depth])
    other = np.flatnonzero(part != part[0])
    return int(other[0]) if len(other) else depth


def sorted_blocks(text: np.ndarray, depth: int, folder: str, room: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes but the last in descending order (to `depth` characters) in blocks, each with its common prefix with
    the one before.

    text is uint8, ends with END and, after that, `pad(depth)` zeros.
    """
    body = text[: len(text) - pad(depth)]
    kind = suffix_kinds(body, os.path.join(folder, "kinds"))
    with open(found := os.path.join(folder, "found"), "wb") as f:
        for lo in range(1, len(body), BLOCK):
            hi = min(len(body), lo + BLOCK)
            (np.flatnonzero(kind[lo:hi] & ~kind[lo - 1 : hi - 1]) + lo).tofile(f)
    heads, last = np.zeros(257, np.int64), None
    with open(at := os.path.join(folder, "seeds"), "wb") as f, open(common := os.path.join(folder, "common"), "wb") as g:
        for part in sorted_seeds(text, _mapped(found, np.int64), depth, folder, max(room, 2)):
            for lo in range(0, len(part), BLOCK):
                pos = part[lo : lo + BLOCK]
                before = np.append(pos[:1] if last is None else last, pos[:-1])
                lcp = common_prefix(text, before, pos, depth)
                if last is None:
                    lcp[0] = 0
                pos.tofile(f)
                lcp.tofile(g)
                last = pos[-1]
                heads[1:] += np.bincount(body[pos], minlength=256)
    os.remove(found)
    heads = np.cumsum(heads)
    seeds, seed_lcp = _mapped(at, np.int64), _mapped(common, np.uint8)
    waiting, ascending = Queues(folder, "l", room), Queues(folder, "a", room)
    up = Induction(body, kind, False, waiting, depth)
    for c in range(256):
        last = -1
        line = deque(waiting.blocks(c))
        while line:
            entries = waiting.read(c, line.popleft())
            last = int(entries["pos"][-1])
            ascending.push(c, entries)
            if len(more := up.visit(entries["pos"], entries["lcp"], c)):
                line.append(more)
        waiting.drop(c)
        for lo in range(int(heads[c]), int(heads[c + 1]), BLOCK):
            hi = min(int(heads[c + 1]), lo + BLOCK)
            pos, lcp = np.array(seeds[lo:hi]), np.array(seed_lcp[lo:hi])
            if lo == heads[c]:  # what an L and an S suffix share is the run of their character
                lcp[0] = 0 if last < 0 else min(_run(body, last, depth), _run(body, int(pos[0]), depth))
            up.visit(pos, lcp, c)
    waiting = Queues(folder, "s", room)
    down = Induction(body, kind, True, waiting, depth)
    for c in range(255, -1, -1):
        last = -1
        line = deque(waiting.blocks(c))
        while line:
            entries = waiting.read(c, line.popleft())
            last = int(entries["pos"][-1])
            yield entries["pos"], entries["lcp"]
            if len(more := down.visit(entries["pos"], entries["lcp"], c)):
                line.append(more)
        waiting.drop(c)
        carry = -1
        for block in reversed(ascending.blocks(c)):
            entries = ascending.read(c, block)[::-1]
            pos = entries["pos"]
            if carry < 0:
                carry = 0 if last < 0 else min(_run(body, last, depth), _run(body, int(pos[0]), depth))
            lcp = np.append(np.uint8(carry), entries["lcp"][:-1])
            carry = int(entries["lcp"][-1])
            yield pos, lcp
            down.visit(pos, lcp, c)
        ascending.drop(c)


def _mapped(path: str, kind) -> np.ndarray:
    return np.memmap(path, kind, "r") if os.path.getsize(path) else np.zeros(0, kind)


def pad(depth: int) -> int:
    return depth + 16


def repeated_starts(path: str, depth: int, room: int = 1 << 22, folder: str | None = None) -> np.ndarray:
    """Places of the text file (as written by `Writer`) whose next `depth` characters stand elsewhere too, as booleans in a file
    mapped from `folder` (of the text, if none is given). At most about `room` tuples, and some blocks, are in memory."""
    text = np.memmap(path, np.uint8, "r")
    out = np.memmap(os.path.join(folder or os.path.dirname(path), "repeated"), bool, "w+", shape=len(text))
    work = tempfile.mkdtemp(prefix="suffix-", dir=folder or os.path.dirname(path))
    try:
        before = -1
        for pos, lcp in sorted_blocks(text, depth, work, room):
            same = np.flatnonzero(lcp >= depth)
            out[pos[same]] = True
            out[pos[same[same > 0] - 1]] = True
            if len(same) and same[0] == 0:
                out[before] = True
            before = int(pos[-1]) if len(pos) else before
    finally:
        shutil.rmtree(work, ignore_errors=True)
    return out


class Writer:
    """Writes segments, each followed by BREAK, as the text file of a sort."""

    def __init__(self, path: str, depth: int) -> None:
        self.file, self.depth, self.size = open(path, "wb"), depth, 0

    def add(self, segment: bytes) -> int:
        at = self.size
        self.file.write((np.frombuffer(segment, np.uint8) + SHIFT).tobytes() + bytes([BREAK]))
        self.size += len(segment) + 1
        return at

    def close(self) -> None:
        self.file.write(bytes([END]) + bytes(pad(self.depth)))
        self.file.close()
