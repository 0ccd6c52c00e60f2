"""Byte-level BPE by ranks, with a segment tree over byte positions.

Each piece of a text (a match of the splitting pattern) that is not itself a
token is merged as follows.  Leaf i of a segment tree holds the rank of the
pair that starts at byte i, inner nodes the minimum of (rank, position), so
the root names the leftmost pair of least rank.  A merge changes three
leaves: the merged token's, its left neighbour's (its pair is new) and the
swallowed token's (gone); each is carried up in a logarithmic number of steps.
Live neighbours are linked, so no bytes are moved.  Short pieces of one size
are merged side by side in numpy (one tree per row of a matrix), long ones one by one.

Units repeat, so their ids are kept per Python worker (see ``tokens``).

Cases.  Null or empty text: no ids, decoded to nothing.  A piece of any
length costs n log n.  Repeated ids: one row each.  Extra columns are
ignored.  Empty table: empty result.
"""

from __future__ import annotations

import base64

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, lists_of, short_batches, slices, worker_state
from .tokens import UnitCache, space_units, stem_of

NONE = np.int64(1) << np.int64(62)
#: Pieces up to so many bytes are merged side by side.
SIDE_BY_SIDE = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """token bytes -> rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class SegmentTreeBpe:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {r: t for t, r in ranks.items()}
        self.byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        if (self.byte < 0).any():
            raise ValueError("a single byte has no rank")
        pairs = {}
        for t, r in ranks.items():
            for i in range(1, len(t)):
                a, b = ranks.get(t[:i]), ranks.get(t[i:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = r
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of tokens, NONE where they do not merge."""
        key = a << 32 | b
        i = np.searchsorted(self.keys, key)
        i[i == len(self.keys)] = 0
        return np.where(self.keys[i] == key, self.merged[i], NONE)

    def merge_one(self, piece: bytes) -> list[int]:
        """Ids of one piece of any length."""
        n = len(piece)
        size = 1 << max(0, n - 1).bit_length()
        none = int(NONE)
        token = [int(self.byte[b]) for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [none] * (2 * size)
        for i in range(n - 1):
            r = self.pairs.get(token[i] << 32 | token[i + 1])
            if r is not None:
                tree[size + i] = r << 32 | i
        for i in range(size - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def put(i, value):
            i += size
            tree[i] = value
            while i > 1:
                i >>= 1
                low = min(tree[2 * i], tree[2 * i + 1])
                if tree[i] == low:
                    break
                tree[i] = low

        def pair(i):
            j = after[i]
            r = self.pairs.get(token[i] << 32 | token[j]) if j < n else None
            return none if r is None else r << 32 | i

        while n > 1 and tree[1] < none:
            i, r = tree[1] & 0xFFFFFFFF, tree[1] >> 32
            j = after[i]
            token[i], token[j], after[i] = r, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            put(j, none)
            put(i, pair(i))
            if before[i] >= 0:
                put(before[i], pair(before[i]))
        return [t for t in token if t >= 0]

    def merge_side_by_side(self, pieces: list[bytes], size: int) -> list[np.ndarray]:
        """Ids of pieces of 2 to ``size`` bytes (a power of two)."""
        rows, shift = len(pieces), np.int64(size.bit_length())
        length = np.array([len(p) for p in pieces], np.int64)
        data = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(rows, size)
        at = np.arange(size)
        token = np.zeros((rows, size + 1), np.int64)
        token[:, :size] = self.byte[data]
        live = at < length[:, None]
        after = np.broadcast_to(np.arange(1, size + 2), (rows, size + 1)).copy()
        before = np.broadcast_to(np.arange(-1, size), (rows, size + 1)).copy()
        tree = np.full((rows, 2 * size), NONE, np.int64)
        rank = self.rank(token[:, :-1].ravel(), token[:, 1:].ravel()).reshape(rows, size)
        can = (at + 1 < length[:, None]) & (rank < NONE)
        tree[:, size:] = np.where(can, rank << shift | at, NONE)
        for i in range(size - 1, 0, -1):
            tree[:, i] = np.minimum(tree[:, 2 * i], tree[:, 2 * i + 1])
        flat_tree, flat_token, flat_after, flat_before = tree.ravel(), token.ravel(), after.ravel(), before.ravel()
        flat_live = live.ravel()

        def put(row, i, value):
            base = row * (2 * size)
            i = i + size
            flat_tree[base + i] = value
            for _ in range(size.bit_length() - 1):
                i >>= 1
                flat_tree[base + i] = np.minimum(flat_tree[base + 2 * i], flat_tree[base + 2 * i + 1])

        row = np.arange(rows)
        while True:
            top = tree[row, 1]
            row, top = row[top < NONE], top[top < NONE]
            if not len(row):
                break
            i, new = top & ((np.int64(1) << shift) - 1), top >> shift
            wide = row * (size + 1)
            j = flat_after[wide + i]
            k = flat_after[wide + j]
            flat_token[wide + i] = new
            flat_after[wide + i] = k
            flat_before[wide + np.minimum(k, size)] = i
            flat_live[row * size + j] = False
            put(row, j, NONE)
            more = k < length[row]
            r = np.where(more, self.rank(new, flat_token[wide + np.minimum(k, size)]), NONE)
            put(row, i, np.where(r < NONE, r << shift | i, NONE))
            p = flat_before[wide + i]
            has = p >= 0
            r = self.rank(flat_token[(wide + p)[has]], new[has])
            put(row[has], p[has], np.where(r < NONE, r << shift | p[has], NONE))
        ids = token[:, :size][live].astype("<u4")
        return np.split(ids, np.cumsum(live.sum(1))[:-1])

    def __call__(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces as little-endian 32-bit bytes."""
        out: list = [None] * len(pieces)
        by_size: dict[int, list[int]] = {}
        for k, p in enumerate(pieces):
            whole = self.ranks.get(p)
            if whole is not None:
                out[k] = whole.to_bytes(4, "little")
            elif len(p) > SIDE_BY_SIDE:
                out[k] = np.array(self.merge_one(p), "<u4").tobytes()
            elif p:
                by_size.setdefault(1 << (len(p) - 1).bit_length(), []).append(k)
            else:
                out[k] = b""
        for size, own in by_size.items():
            for at in range(0, len(own), 4096):
                some = own[at: at + 4096]
                for k, ids in zip(some, self.merge_side_by_side([pieces[k] for k in some], size)):
                    out[k] = ids.tobytes()
        return out


class PatternEncoder:
    """Ids of units: each match of the pattern is merged separately."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.bpe = SegmentTreeBpe(read_ranks(path))
        self.find = regex.compile(pattern).findall
        self.letters_match = self.find(" aÿ.") == [" aÿ", "."] and self.find("Àb,") == ["Àb", ","]
        self.pieces = UnitCache(lambda pieces, known: self.bpe(pieces))
        self.vocabulary = [self.bpe.token.get(i, b"") for i in range(max(self.bpe.token) + 1)]

    def cut(self, unit: bytes) -> list[bytes]:
        unit = unit.decode("utf-8", "replace")
        stem = stem_of(unit)                               # letters, then a stop or comma: two matches of the pattern
        if stem is not None and self.letters_match:
            return [p.encode() for p in (stem, unit[len(stem):]) if p]
        return [p.encode() for p in self.find(unit)]

    def __call__(self, units: list[bytes], known) -> list[bytes]:
        return self.pieces([self.cut(u) for u in units])   # all missing pieces side by side


def encoder(path: str, pattern: str) -> tuple[UnitCache, PatternEncoder]:
    def make():
        own = PatternEncoder(path, pattern)
        return UnitCache(own), own
    return worker_state(f"ranks {path}", make, "bpe")


def _coded(path: str, pattern: str):
    def run(batches):
        cache, own = encoder(path, pattern)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = as_bytes(part.column("text"))
                rows = [np.frombuffer(ids, "<i4") for ids in cache([space_units(t) for t in texts])]
                decoded = [b"".join(map(own.vocabulary.__getitem__, ids.tolist())) for ids in rows]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), lists_of(np.concatenate(rows), np.array([len(ids) for ids in rows])), pa.array(decoded, pa.binary()),
                ], ["doc_id", "ids", "decoded"])
    return run


def encode_decode(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, ids and decoded bytes of every row of ``docs(doc_id, text)``."""
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    return short_batches(docs).select("doc_id", "text").mapInArrow(_coded(path, pattern), "doc_id long, ids array<int>, decoded binary")


def digest(coded: DataFrame) -> DataFrame:
    """The contract's columns from ``encode_decode``."""
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
