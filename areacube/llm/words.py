"""Words, word hashes and window hashes of many texts at once (numpy).

A word is a run of bytes outside 0x20 and 0x09-0x0D.  Word hashes are
polynomials over bytes, window hashes Rabin-Karp polynomials over word
hashes; both come from prefix sums modulo 2**64, so a window costs the same
however many words it has.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .common import as_strings, text_buffer, worker_state

U = np.uint64
_MASK = (1 << 64) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit values."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _tables() -> dict:
    space = np.zeros(256, bool)
    space[[32, *range(9, 14)]] = True
    values = mixed(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
    lower = values.copy()
    lower[65:91] = values[97:123]
    return {"space": space, "values": values, "lower": lower}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (at least)."""
    have = worker_state(f"powers-{base}", dict, "word hashes")
    if len(have.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, b in (("up", base), ("down", pow(base, -1, 1 << 64))):
            x = np.full(size, b, U)
            x[0] = 1
            have[name] = np.multiply.accumulate(x)
    return have["up"][:n], have["down"][:n]


BYTE_BASE = 0x9E3779B97F4A7C15 | 1
WORD_BASE = 0xD1342543DE82EF95 | 1


def prefix_hashes(values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of values[i] * base**i, and base**-i to bring a range back to exponent 0."""
    up, down = _powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, U)
    np.cumsum(values * up[:-1], out=sums[1:])
    return sums, down


class Words:
    """The words of a slice of texts.

    buf: the bytes; at: text offsets; start, end: byte ranges of words;
    first: index of each text's first word (one more than texts).
    """

    def __init__(self, column):
        tables = worker_state("word-tables", _tables, "word hashes")
        self.buf, self.at = text_buffer(as_strings(column))
        n = len(self.buf)
        gap = tables["space"][self.buf]
        edge = np.zeros(n + 1, bool)
        edge[self.at] = True
        before = np.ones(n, bool)
        after = np.ones(n, bool)
        if n:
            before[1:] = gap[:-1]
            after[:-1] = gap[1:]
        self.start = np.flatnonzero(~gap & (before | edge[:-1]))
        self.end = np.flatnonzero(~gap & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, self.at)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """One 64-bit hash per word; ``lower``: as if A-Z were a-z."""
        tables = worker_state("word-tables", _tables, "word hashes")
        sums, down = prefix_hashes(tables["lower" if lower else "values"][self.buf], BYTE_BASE)
        h = (sums[self.end] - sums[self.start]) * down[self.start]
        return mixed(h ^ (self.end - self.start).astype(U) * U(0xA0761D6478BD642F))

    def windows(self, width: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rabin-Karp hashes of all windows of ``width`` words inside one text:
        (index of the first word, text, hash), in text order."""
        have = self.counts()
        number = np.maximum(have - width + 1, 0)
        text = np.repeat(np.arange(len(have)), number)
        inside = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        at = self.first[:-1][text] + inside
        sums, down = prefix_hashes(hashes, WORD_BASE)
        return at, text, mixed((sums[at + width] - sums[at]) * down[at])


def covered(at: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n words lie in a window of ``width`` words that starts at one of ``at``."""
    turn = np.zeros(n + 1, np.int64)
    np.add.at(turn, at, 1)
    np.add.at(turn, np.minimum(at + width, n), -1)
    return np.cumsum(turn[:-1]) > 0


def strings(values: list) -> pa.Array:
    return pa.array(values, pa.string())
