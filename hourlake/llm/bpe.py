"""Byte-pair merging with a heap of adjacent pairs over a doubly linked list of symbols."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import weakref
from collections.abc import Callable
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa

#: Bits of a symbol's number. A pair table maps left << BITS | right to pair_value(rank, joined symbol).
BITS = 20
_PLACE = (1 << 32) - 1
_SYMBOL = (1 << BITS) - 1


def pair_value(rank: int, joined: int) -> int:
    """A pair's entry in a table: its rank, room for a position, and the symbol it becomes."""
    return rank + 1 << 32 + BITS | joined


def merge(symbols: list[int], table: dict[int, int]) -> tuple[list[int], int]:
    """Merge adjacent symbols, lowest rank first and leftmost among equals, until no pair is in the table.

    Works in place: symbols[i] is then the symbol that begins at place i, or -1 where place i has been
    merged into one before it. Returns symbols and the number of merges. The cost is n log n for n
    symbols, so that one very long word does no harm.
    """
    n, get = len(symbols), table.get
    pairs, heap = [0] * n, []
    for i in range(n - 1):
        if v := get(symbols[i] << BITS | symbols[i + 1]):
            pairs[i] = v
            heap.append(v + (i << BITS))
    if not heap:
        return symbols, 0
    heapify(heap)
    after, before, merges = list(range(1, n + 1)), list(range(-1, n - 1)), 0
    while heap:
        e = heappop(heap)
        i = e >> BITS & _PLACE
        if pairs[i] != e - (i << BITS):
            continue  # one of the two has been merged since
        j = after[i]
        joined = symbols[i] = e & _SYMBOL
        symbols[j] = pairs[j] = -1
        merges += 1
        k = after[i] = after[j]
        pairs[i] = 0
        if k < n:
            before[k] = i
            if v := get(joined << BITS | symbols[k]):
                pairs[i] = v
                heappush(heap, v + (i << BITS))
        h = before[i]
        if h >= 0:
            pairs[h] = v = get(symbols[h] << BITS | joined, 0)
            if v:
                heappush(heap, v + (h << BITS))
    return symbols, merges


def pair_arrays(table: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """A pair table as sorted keys and, for each, rank + 1 << BITS | joined symbol."""
    keys = np.array(sorted(table), np.int64)
    values = np.array([(v >> 32 + BITS) << BITS | v & _SYMBOL for v in map(table.__getitem__, keys.tolist())], np.int64)
    # A last key that no pair has, so that every search ends at a key.
    return np.append(keys, 1 << 2 * BITS), np.append(values, 0)


def merge_all(symbols: np.ndarray, owner: np.ndarray, arrays: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """merge() of many sequences at once: one heap of ranks, each with the places in all sequences of its pairs.

    Works in place on 64-bit symbols, with the same result. Sequences lie behind one another; before, between and behind them is a symbol that is in no pair.
    owner numbers the sequence of each place. A rank that is taken from the heap merges its leftmost pair of every sequence and goes back for the others, as
    a merge may make a pair of lower rank. A merge costs some array elements, a rank some array calls: very long sequences, which repeat ranks, are for merge().
    """
    keys, values = arrays
    n = len(symbols)
    after, before, pairs = np.arange(1, n + 1), np.arange(-1, n - 1), np.zeros(n, np.int64)
    places: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def look(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left << BITS | right
        at = keys.searchsorted(wanted)
        found = values[at]
        found[keys[at] != wanted] = 0
        return found

    def push(at: np.ndarray, found: np.ndarray) -> None:
        some = found != 0
        at, ranks = at[some], found[some] >> BITS
        if not len(at):
            return
        order = ranks.argsort(kind="stable")
        at, ranks = at[order], ranks[order]
        cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(at)]
        for rank, a, b in zip(ranks[cuts[:-1]].tolist(), cuts, cuts[1:], strict=False):
            if rank not in places:
                places[rank] = []
                heappush(heap, rank)
            places[rank].append(at[a:b])

    pairs[:-1] = look(symbols[:-1], symbols[1:])
    push(np.arange(n), pairs)
    while heap:
        rank = heappop(heap)
        at = np.concatenate(places.pop(rank))
        at = np.sort(at[pairs[at] >> BITS == rank])  # of the others, one of the two has been merged since
        again = owner[at[1:]] == owner[at[:-1]]
        if again.any():
            places[rank] = [at[1:][again]]
            heappush(heap, rank)
            at = at[np.append(True, ~again)]
        joined, gone = pairs[at] & _SYMBOL, after[at]
        right, left = after[gone], before[at]
        symbols[at], symbols[gone], pairs[gone] = joined, -1, 0
        after[at], before[right] = right, at
        changed = np.concatenate([at, left])
        pairs[changed] = found = look(np.concatenate([joined, symbols[left]]), np.concatenate([symbols[right], joined]))
        push(changed, found)
    return symbols


#: All memos of this process.
_memos: list[weakref.ref] = []


class Memo(dict):
    """Results of make(key), of which twice `most` are held: a full memo keeps what it has as the elder half."""

    def __init__(self, make: Callable, most: int = 300_000, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest, self.elder = make, most, longest, {}
        _memos.append(weakref.ref(self))

    def __missing__(self, key):
        value = self.elder.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.elder = dict(self)
                self.clear()
            self[key] = value
        return value


def give_back() -> None:
    """Give the memory that this process no longer uses back to the system."""
    gc.collect()
    release()


def release() -> None:
    """give_back for what is free already, without a search for cycles: cheap enough for between two parts of a batch."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def forget(*own: Memo) -> None:
    """Empty all memos of this process but these. Spark uses Python workers again, so another operator's tasks may have filled them; nothing but time is lost."""
    _memos[:] = [r for r in _memos if r() is not None]
    others = [m for r in _memos if (m := r()) is not None and (m or m.elder) and all(m is not x for x in own)]
    for memo in others:
        memo.clear()
        memo.elder = {}
    if others:
        give_back()
