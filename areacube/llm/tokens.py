"""Token ids of whole texts, through a bounded cache of their units.

The tokenizers of this library all split a text before they merge, and none
of their pieces runs from a non-space character into a following space.  So a
text's ids are the ids of its units one after the other, where a unit is a
stretch of text up to the next single space (byte-level vocabularies, which
keep white space) or a word (vocabularies that drop it).  Units repeat, so
their ids are kept per Python worker, in two generations of bounded size.
"""

from __future__ import annotations

import os
import re
from array import array
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import as_strings, worker_state

#: Units that one of the two cache generations holds.
CACHE_UNITS = 400_000
#: The same of words, whose workers hold a shard's index too.
CACHE_WORDS = 150_000

#: Before a single space, and on both sides of a single line end, between other characters.
CUT = re.compile(r"(?<=\S)(?=[ \n]\S)|(?<=\S\n)(?=\S)")
#: ASCII white space and separators, and the first bytes of all other white space.
ONE_SPACE = bytes(32 if chr(b).isspace() and b < 128 else b for b in range(256))
WIDE_SPACE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")

#: The UTF-8 bytes of a run of letters (of the first 256 characters) after at most one space.
RUN = r"\A ?(?:[A-Za-z]|\xc2[\xaa\xb5\xba]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+\z"
#: ASCII signs that are pieces of their own behind a letter; the start and end of a special token are none.
SIGNS = "!\"#$%&'()*+,-./:;=?@[\\]^_`{}~"


def _cut(text: bytes) -> bytes:
    """A text that holds no zero byte, with one at each place where it is cut into units."""
    if b"  " in text.translate(ONE_SPACE) or not text.isascii() and any(w in text for w in WIDE_SPACE):
        return CUT.sub("\0", text.decode("utf-8", "replace")).encode()
    return text.replace(b" ", b"\0 ").replace(b"\n", b"\0\n\0")


def space_units(text: bytes) -> list[bytes]:
    """Cuts a text before each single space, and around each single line end, that stands between other characters."""
    if b"\0" in text:
        return [u.encode() for u in CUT.split(text.decode("utf-8", "replace"))]
    return _cut(text).split(b"\0")


def word_units(text: bytes) -> list[bytes]:
    """The words of a text in lower case; as they are where special tokens may stand, which are told by case."""
    return (text if b"<|" in text else text.lower()).split()


def without_signs(units: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The units (large binary), where signs stand behind a run of letters as two values, and the first value of each (one number more)."""
    _, offsets, data = units.buffers()
    if not len(units) or data is None:
        return units, np.arange(len(units) + 1)
    at = np.frombuffer(offsets, np.int64)[units.offset: units.offset + len(units) + 1]
    stems = pc.ascii_rtrim(units.view(pa.large_string()), SIGNS).view(pa.large_binary())
    ends = at[:-1] + pc.binary_length(stems).to_numpy(zero_copy_only=False)
    two = pc.match_substring_regex(stems, RUN).to_numpy(zero_copy_only=False) & (ends < at[1:])
    first = np.arange(len(at))
    first[1:] += np.cumsum(two)
    cuts = np.empty(first[-1] + 1, np.int64)
    cuts[first] = at
    cuts[first[:-1][two] + 1] = ends[two]
    return pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), data]), first


def joined(values: pa.Array, first: np.ndarray) -> pa.Array:
    """Large binary values joined from each first one to the next."""
    _, offsets, data = values.buffers()
    if not len(values) or data is None:
        return pa.array([b""] * (len(first) - 1), pa.large_binary())
    at = np.frombuffer(offsets, np.int64)[values.offset + first]
    return pa.Array.from_buffers(pa.large_binary(), len(first) - 1, [None, pa.py_buffer(at), data])


class UnitCache:
    """unit -> ids as little-endian 32-bit bytes; ``make(units, known)`` finds missing ones."""

    def __init__(self, make, limit: int = CACHE_UNITS):
        self.make, self.limit = make, limit
        self.new: dict = {}
        self.old: dict = {}

    def get(self, unit):
        x = self.new.get(unit)
        return self.old.get(unit) if x is None else x

    def __call__(self, texts: list[list]) -> list[bytes]:
        """The ids of each text, given as its units."""
        ids = self.each(list(chain.from_iterable(texts)))
        out, at = [], 0
        for x in texts:
            out.append(b"".join(ids[at: at + len(x)]))
            at += len(x)
        return out

    def each(self, units: list) -> list[bytes]:
        """The ids of each unit."""
        ids = list(map(self.new.get, units))
        missing = [i for i, x in enumerate(ids) if x is None]
        if missing:
            found = self.added(list(dict.fromkeys(units[i] for i in missing)))
            for i in missing:
                ids[i] = found[units[i]]
        return ids

    def of_lists(self, texts: pa.Array, end: bytes = b"") -> list[bytes]:
        """The ids of each text and the end, given as an Arrow list of its units; each different unit is looked up once,
        the signs behind a run of letters as a unit of their own."""
        flat = texts.flatten().dictionary_encode()
        parts, first = without_signs(flat.dictionary)
        parts = parts.dictionary_encode()
        units = parts.dictionary.to_numpy(zero_copy_only=False).tolist()          # faster than to_pylist
        ids = pa.array(self.each(units), pa.large_binary()).take(parts.indices)
        ids = joined(ids, first).take(flat.indices)
        at = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(pc.list_value_length(texts).to_numpy(zero_copy_only=False), out=at[1:])
        _, offsets, data = ids.buffers()
        at = np.frombuffer(offsets, np.int64)[at + ids.offset].tolist()
        data = memoryview(data or b"")
        return [b"".join((data[a:b], end)) for a, b in zip(at[:-1], at[1:])]

    def added(self, units: list) -> dict:
        found = {u: x for u in units if (x := self.old.get(u)) is not None}
        units = [u for u in units if u not in found]
        for at in range(0, len(units), 20_000):
            some = units[at: at + 20_000]
            found.update(zip(some, self.make(some, self.get)))
        if len(self.new) + len(found) > self.limit and self.new:
            self.old, self.new = self.new, {}
        self.new.update(found)
        return found


def byte_letters() -> dict[int, str]:
    """The printable stand-ins of bytes in byte-level vocabularies: a byte's
    own Latin-1 character if that is visible, else the next free one from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


LETTERS = "( ?[A-Za-zªµºÀ-ÖØ-öø-ÿ]+)"
STEM = re.compile(LETTERS + "[.,]?")


def stem_of(text: str) -> str | None:
    """A unit that is one run of letters (of the first 256 characters) after at
    most one space, without the one stop or comma that may follow; else None."""
    m = STEM.fullmatch(text)
    return m and m[1]


class LibraryEncoder:
    """Ids of units by the tokenizers library, special tokens by their strings included.

    Runs of letters are one piece by the splitting rule, so they go to a
    tokenizer of the same model without its splitting steps, as the words of
    one text: one result for many.  Where a word's ids end is told by the
    bytes that its tokens hold.  Everything else takes the whole tokenizer.
    """

    def __init__(self, path: str, lower: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.pieces, self.lower = Tokenizer(self.whole.model), lower
        self.letters = byte_letters()
        vocab, suffix = self.whole.get_vocab(with_added_tokens=False), self.whole.model.end_of_word_suffix or ""
        self.any_byte = all(c + x in vocab for c in self.letters.values() for x in ("", suffix))    # else a byte may have no token
        self.sizes = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, k in vocab.items():
            self.sizes[k] = len(token.removesuffix(suffix))

    def of_runs(self, runs: list[bytes]) -> list[bytes]:
        seen = b"\n".join(runs)
        if self.lower:
            seen = seen.decode().lower().encode()
        words = seen.decode("latin-1").translate(self.letters).split(self.letters[10])
        ids = np.array(self.pieces.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)[0].ids, "<u4")
        ends = np.cumsum(list(map(len, words)))
        at = [0, *(np.searchsorted(np.cumsum(self.sizes[ids]), ends) * 4 + 4).tolist()]
        data = ids.tobytes()
        return [data[a:b] for a, b in zip(at[:-1], at[1:])]

    def __call__(self, units: list[bytes], known) -> list[bytes]:
        is_run = pc.match_substring_regex(pa.array(units, pa.large_binary()), RUN).to_pylist() if self.any_byte else [False] * len(units)
        runs, others = list(compress(units, is_run)), [u for u, x in zip(units, is_run) if not x]
        found = iter(self.of_runs(runs) if runs else ())
        texts = [u.decode("utf-8", "replace") for u in others]
        rest = (array("I", e.ids).tobytes() for e in self.whole.encode_batch_fast(texts, add_special_tokens=False))
        return [next(found if x else rest) for x in is_run]


def space_lists(texts: pa.Array) -> pa.Array:
    """The ``space_units`` of each of many texts, as Arrow lists."""
    texts = texts.cast(pa.large_binary())
    if pc.any(pc.match_substring(texts, "\0")).as_py():
        return pa.array([space_units(t) for t in texts.to_pylist()], pa.list_(pa.large_binary()))
    return pc.split_pattern(pa.array([_cut(t) for t in texts.to_pylist()], pa.large_binary()), "\0")


def word_lists(texts: pa.Array) -> pa.Array:
    """The ``word_units`` of each of many texts, as Arrow lists; an empty unit may come first or last."""
    texts = texts.cast(pa.large_string())
    lower = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
    return pc.ascii_split_whitespace(lower).cast(pa.list_(pa.large_binary()))


def spaced_ids(path: str, end: bytes = b""):
    """Column of texts -> their ids (bytes) and the end, for a byte-level vocabulary file of the tokenizers library."""
    cache = worker_state(f"spaced {path}", lambda: UnitCache(LibraryEncoder(path, lower=False)), "spaced")
    return lambda column: cache.of_lists(space_lists(as_strings(column)), end)


def word_ids(path: str, end: bytes = b""):
    """Column of texts -> their ids (bytes) and the end, for a lower-casing vocabulary file that drops white space."""
    cache = worker_state(f"words {path}", lambda: UnitCache(LibraryEncoder(path, lower=True), CACHE_WORDS), "words")
    return lambda column: cache.of_lists(word_lists(as_strings(column)), end)
