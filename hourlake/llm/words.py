"""Hashes of all words of a buffer at once."""

from __future__ import annotations

from functools import cache

import numpy as np
import xxhash

#: Bytes that are hashed at once. Words longer than half of this are hashed one by one.
BUFFER = 1 << 20
#: The six bytes of ASCII white space, which part words.
SPACES = b" \t\n\v\f\r"
#: An odd multiplier: powers of it have inverses modulo 2**64.
_FACTOR = 0x9E3779B97F4A7C15


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A random value of each byte, which bytes are spaces, and the powers of the multiplier and of its inverse."""
    values = np.random.default_rng(11).integers(1, 1 << 64, 256, np.uint64)
    space = np.zeros(256, bool)
    space[list(SPACES)] = True

    def powers(factor: int) -> np.ndarray:
        out = np.full(BUFFER + 1, factor, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return values, space, powers(_FACTOR), powers(pow(_FACTOR, -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Each bit of the result depends on all of x."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def distinct(x: np.ndarray) -> np.ndarray:
    """np.unique by a sort. That of numpy 2.3 on puts the values in a hash table, which takes several times as long, and memory beside."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def buffer_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, starts) of the words of at most BUFFER bytes, none longer than half of that: a polynomial of each word's bytes, from differences of one running sum."""
    values, spaces, up, down = _tables()
    b = np.frombuffer(data, np.uint8)
    edge = np.zeros(len(b) + 2, np.int8)
    edge[1:-1] = ~spaces[b]
    edges = np.flatnonzero(np.diff(edge))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(values[b] * up[: len(b)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def word_hashes(data: bytes) -> np.ndarray:
    """Hashes of the words of data, of any length. Equal words have equal hashes everywhere."""
    if len(data) <= BUFFER // 2:
        return buffer_words(data)[0]
    out, held, size = [], [], 0
    for word in [*data.split(), None]:
        if held and (word is None or size + len(word) >= BUFFER):
            out.append(buffer_words(b" ".join(held))[0])
            held, size = [], 0
        if word is None:
            break
        if len(word) > BUFFER // 2:
            out.append(np.array([xxhash.xxh3_64_intdigest(word)], np.uint64))
        else:
            held.append(word)
            size += len(word) + 1
    return np.concatenate(out) if out else np.empty(0, np.uint64)
