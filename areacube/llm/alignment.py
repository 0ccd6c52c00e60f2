"""Alignment of two tokenizers' tokens over the bytes of every text.

A is a byte-level vocabulary of the tokenizers library, applied to a space and
the text; B a sentencepiece model, which adds that space itself.  Both cut the
same bytes into tokens, so every token is an interval of byte offsets.

Interval coalescing: all A and B tokens are sorted by start (one lexsort), the
running maximum of their ends is taken, and a new group begins where a start
reaches the maximum of all ends before it; that is where A and B both end a
token.  Inside a group every A token is linked with every B token; the links
are expanded from the distinct ids of the group with their numbers.

Neither vocabulary has a piece that runs from another character into a
following space, over a line end, or from a letter into a sign behind it, so texts are cut there
(``space_lists``, ``without_signs``) and the different parts of a slice of texts
are coalesced side by side, thousands at once; each Python worker keeps the parts
it has met, a bounded number, as columns (``Records``), and texts gather theirs by number.
Runs of letters go to either tokenizer many at a time, with one result; the parts' ends are told by
the bytes of the tokens, and runs that these do not give back go once more one by one.
A text whose parts do not give back its bytes is
aligned once more as a whole, and has no tokens if that fails too.

Corpus counts: an id pair's count is the number of documents that hold it
linked, an aggregate with partial sums over each document's distinct pairs.  The most
frequent pairs (at most ``HOT_PAIRS`` rows, the bound of what is sent to every task) are looked
up in place, all others by a join on the pair, where none is hot.

Cases: null and empty texts, and texts whose A or B tokens do not join to a space and
the text (U+2581 inside, for one), have no tokens: zeros and no groups.  Strings of special
tokens inside texts are plain text.  Every row is a document, repeated rows and
rows with a null or repeated id too.  Long texts are cut into parts like others; a part without a
space may be as long as its text.  An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, as_bytes, lists_of, short_batches, slices, worker_state
from .tokens import RUN, SIGNS, byte_letters, space_lists, without_signs

#: Parts, and bytes of their records, that a worker keeps; beyond that those of the last slice of texts.
CACHE_PARTS = 400_000
CACHE_BYTES = 64 << 20
#: Parts that are aligned at a time.
MADE_AT_ONCE = 20_000
#: Bytes of text that one step handles, and rows of one batch of results.
TEXT_BYTES = 4 << 20
ROWS_OUT = 250
#: Pairs that are sent to every task, at most (17 bytes each).
HOT_PAIRS = 1 << 18
#: A pair of ids is one long: A's id above so many bits, B's below.
SHIFT = 20

ALIGNED = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
           "pairs array<long>, times array<long>")


def coalesced(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The group of every interval: sorted by start, a group breaks where a
    start reaches the running maximum of the ends before it."""
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order])
    new = np.ones(len(order), bool)
    new[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return group


def _numbered(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (group, id), in that order, and how often each occurs."""
    key, n = np.unique(group << SHIFT | ids, return_counts=True)
    return key >> SHIFT, key & ((1 << SHIFT) - 1), n


def linked(group_a: np.ndarray, a: np.ndarray, group_b: np.ndarray, b: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, pair of ids, number of token pairs): every A id of a group with every B id of it."""
    ga, a, na = _numbered(group_a, a)
    gb, b, nb = _numbered(group_b, b)
    have = np.bincount(gb, minlength=groups)
    first = np.cumsum(have) - have
    each = have[ga]
    of = np.repeat(np.arange(len(ga)), each)
    at = first[ga][of] + np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)
    return ga[of], a[of] << SHIFT | b[at], na[of] * nb[at]


def spans(first: np.ndarray, have: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... (``have[i]`` numbers) for every i, one after the other."""
    return np.arange(have.sum()) + np.repeat(first - (np.cumsum(have) - have), have)


class Records:
    """What many parts come to: numbers (n_a, n_b, n_groups, n_links), the text of the groups,
    rows (pair, times), ``have`` of them a part; not good where the tokens do not give back the part."""

    def __init__(self, numbers: np.ndarray, text: pa.Array, rows: np.ndarray, have: np.ndarray, good: np.ndarray):
        self.numbers, self.text, self.rows, self.have, self.good = numbers, text, rows, have, good
        self.first = np.cumsum(have) - have

    @classmethod
    def not_good(cls, n: int) -> Records:
        return cls(np.zeros((n, 4), np.int64), pa.array([""] * n, pa.large_string()), np.zeros((0, 2), np.int64), np.zeros(n, np.int64), np.zeros(n, bool))

    @classmethod
    def joined(cls, parts: list[Records]) -> Records:
        return cls(np.concatenate([x.numbers for x in parts]), pa.concat_arrays([x.text for x in parts]), *[np.concatenate([getattr(x, c) for x in parts]) for c in ("rows", "have", "good")])

    def take(self, at: np.ndarray) -> Records:
        return Records(self.numbers[at], self.text.take(pa.array(at)), self.rows[spans(self.first[at], self.have[at])], self.have[at], self.good[at])

    def __len__(self) -> int:
        return len(self.have)

    @property
    def nbytes(self) -> int:
        return self.numbers.nbytes + self.text.nbytes + self.rows.nbytes


class Aligner:
    """Parts -> their ``Records``."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a_pieces, self.letters = Tokenizer(self.a.model), byte_letters()
        byte_of = {c: bytes([b]) for b, c in self.letters.items()}
        words = sorted(self.a.get_vocab(with_added_tokens=False).items(), key=lambda x: x[1])
        self.a_bytes = [b""] * (max(i for _, i in words) + 1)
        for word, i in words:
            self.a_bytes[i] = b"".join(byte_of.get(c, c.encode()) for c in word)
        self.b = SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        own = [p for i, p in enumerate(pieces) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        self.cut = not any("\n" in p or "▁" in p.lstrip("▁") for p in own)
        self.cut_signs = self.cut and not any(re.search(f"[A-Za-zªµºÀ-ÖØ-öø-ÿ][{re.escape(SIGNS)}]", p) for p in own)
        self.line_end = len(self.b.encode("\n"))
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << SHIFT:
            raise ValueError("a vocabulary has more ids than a pair can hold")
        self.a_len, self.b_len = (np.array([len(x) for x in xs], np.int64) for xs in (self.a_bytes, self.b_bytes))
        ids = [str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.names = pa.array([mark + i for mark in ("", ";", "|", ",") for i in ids], pa.large_string())
        self.ids = len(ids)

    def parts(self, texts: pa.Array) -> pa.Array:
        """The parts of a space and each text (large binary), as Arrow lists; none of an empty text."""
        whole = pc.if_else(pc.equal(pc.binary_length(texts), 0), b"", pc.binary_join_element_wise(pa.scalar(b" ", pa.large_binary()), texts, pa.scalar(b"", pa.large_binary())))
        lists = space_lists(whole) if self.cut else lists_of(whole, np.ones(len(whole), np.int64))
        flat, have = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        some = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
        if not some.all():
            flat, have = flat.filter(pa.array(some)), np.bincount(np.repeat(np.arange(len(have)), have)[some], minlength=len(have))
        return lists_of(flat, have)

    def __call__(self, parts: list[bytes]) -> Records:
        return Records.joined([self.some(parts[at: at + MADE_AT_ONCE]) for at in range(0, len(parts), MADE_AT_ONCE)] or [Records.not_good(0)])

    def some(self, parts: list[bytes]) -> Records:
        if not self.cut:
            return self.one_by_one(parts)
        is_run = pc.match_substring_regex(pa.array(parts, pa.large_binary()), RUN).to_numpy(zero_copy_only=False)
        runs, others = (np.flatnonzero(x) for x in (is_run, ~is_run))
        own = [parts[i] for i in runs.tolist()]
        found = (self.of_runs(own) or self.one_by_one(own)) if own else Records.not_good(0)
        if not len(others):
            return found
        return Records.joined([found, self.one_by_one([parts[i] for i in others.tolist()])]).take(np.argsort(np.concatenate([runs, others])))

    def of_runs(self, runs: list[bytes]) -> Records | None:
        """Runs of letters, as the words of one text for either side; None if the tokens do not give them back."""
        words = b"\n".join(runs).decode("latin-1").translate(self.letters).split(self.letters[10])
        a = np.array(self.a_pieces.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)[0].ids, np.int64)
        between = [b"" if r[0] == 32 else b"\n" for r in runs]
        between[0] = b"\n"                                   # B's own space stands before it
        text = b"".join(chain.from_iterable(zip(between, runs)))
        b = np.array(self.b.encode(text.decode()), np.int64)
        size, gap = (np.array(list(map(len, x)), np.int64) for x in (runs, between))
        end_a, end_b = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) != b"".join(runs) or b"".join(map(self.b_bytes.__getitem__, b.tolist())) != b" " + text:
            return None
        ends = np.cumsum(size)
        upto_a = np.searchsorted(end_a, ends) + 1
        lasts = 1 + np.cumsum(size + gap)                     # of runs in B's bytes
        upto_b = np.searchsorted(end_b, lasts) + 1
        from_b = np.searchsorted(end_b, lasts - size) + 1
        if (end_a[upto_a - 1] != ends).any() or (end_b[upto_b - 1] != lasts).any() or (end_b[from_b - 1] != lasts - size).any():
            return None
        n_b = upto_b - from_b
        return self.aligned(a, np.diff(upto_a, prepend=0), b[spans(from_b, n_b)], n_b)

    def one_by_one(self, parts: list[bytes]) -> Records:
        texts = [p.decode("utf-8", "replace") for p in parts]
        a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        # B adds a space: a part gives its own for it, or stands behind a line end, whose tokens go again
        own = [t[0] == " " and t != " " for t in texts]
        b = self.b.encode([t[1:] if x else "\n" + t for x, t in zip(own, texts)], num_threads=1)
        b = [ids if x else ids[self.line_end:] for x, ids in zip(own, b)]
        good = np.arange(len(parts)) if self.all_given_back(parts, a, b) else np.array([i for i, p in enumerate(parts) if self.all_given_back([p], a[i: i + 1], b[i: i + 1])], np.int64)
        if not len(good):
            return Records.not_good(len(parts))
        a, b = ([x[i] for i in good.tolist()] for x in (a, b))
        n_a, n_b = (np.array(list(map(len, x)), np.int64) for x in (a, b))
        found = self.aligned(*chain.from_iterable((np.array(list(chain.from_iterable(x)), np.int64), n) for x, n in ((a, n_a), (b, n_b))))
        at = np.full(len(parts), len(good))
        at[good] = np.arange(len(good))
        return found if len(good) == len(parts) else Records.joined([found, Records.not_good(1)]).take(at)

    def all_given_back(self, parts: list[bytes], a: list[list[int]], b: list[list[int]]) -> bool:
        """Whether both sides' tokens join to every part."""
        want, size = b"".join(parts), np.array(list(map(len, parts)))
        for ids, table, length in ((a, self.a_bytes, self.a_len), (b, self.b_bytes, self.b_len)):
            flat = list(chain.from_iterable(ids))
            end = np.concatenate([[0], np.cumsum(length[flat])]) if flat else np.zeros(1, np.int64)
            if (np.diff(end[np.concatenate([[0], np.cumsum(list(map(len, ids)))])]) != size).any() or b"".join(map(table.__getitem__, flat)) != want:
                return False
        return True

    def aligned(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> Records:
        """Parts side by side on one axis of bytes, where the first ends the second begins; n_a, n_b: ids of each part."""
        end_a, end_b = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        group = coalesced(np.concatenate([end_a - self.a_len[a], end_b - self.b_len[b]]), np.concatenate([end_a, end_b]))
        group_a, group_b = group[: len(a)], group[len(a):]
        groups = int(group_a[-1]) + 1
        part_a = np.repeat(np.arange(len(n_a)), n_a)
        part_of = np.empty(groups, np.int64)
        part_of[group_a] = part_a
        of, pair, times = linked(group_a, a, group_b, b, groups)
        of = part_of[of]
        have = np.bincount(of, minlength=len(n_a))
        upto = np.concatenate([[0], np.cumsum(times)])[np.concatenate([[0], np.cumsum(have)])]
        numbers = np.stack([n_a, n_b, np.bincount(part_of, minlength=len(n_a)), np.diff(upto)], axis=1)
        return Records(numbers, self.written(np.concatenate([a, b]), group, len(a), part_of, n_a + n_b), np.stack([pair, times], axis=1), have, np.ones(len(n_a), bool))

    def written(self, ids: np.ndarray, group: np.ndarray, n_a: int, part_of: np.ndarray, have: np.ndarray) -> pa.Array:
        """``a1,a2|b1;a3|b2`` of every part: groups in order, in each A's ids and then B's."""
        order = np.argsort(group, kind="stable")                       # A's tokens lie before B's
        group, side, ids = group[order], order >= n_a, ids[order]
        mark = np.full(len(order), 3)
        mark[1:][side[1:] & ~side[:-1]] = 2
        mark[1:][group[1:] != group[:-1]] = 1
        part = part_of[group]
        mark[1:][part[1:] != part[:-1]] = 0
        mark[0] = 0
        return pc.binary_join(lists_of(self.names.take(pa.array(mark * self.ids + ids)), have), pa.scalar("", pa.large_string()))


class UnitCache:
    """Records of the parts that a worker has met, in columns of bounded size."""

    def __init__(self, make: Aligner, limit: int = CACHE_PARTS, most: int = CACHE_BYTES):
        self.make, self.limit, self.most = make, limit, most
        self.at: dict[bytes, int] = {}
        self.kept = Records.not_good(0)

    def __call__(self, parts: list[bytes]) -> tuple[Records, np.ndarray]:
        """Records, and the number among them of each of the different parts."""
        at = list(map(self.at.get, parts))
        missing = [i for i, x in enumerate(at) if x is None]
        if missing:
            new, numbers = [parts[i] for i in missing], range(len(self.kept), len(self.kept) + len(missing))
            self.kept = Records.joined([self.kept, self.make(new)])
            self.at.update(zip(new, numbers))
            for i, k in zip(missing, numbers):
                at[i] = k
        records, at = self.kept, np.array(at, np.int64)
        if len(records) > self.limit or records.nbytes > self.most:
            self.kept, self.at = records.take(at), dict(zip(parts, range(len(parts))))
        return records, at


def _parts(aligner: Aligner, cache: UnitCache, texts: pa.Array) -> tuple[Records, np.ndarray, np.ndarray]:
    """Records, and of all parts of the texts in order: the text and the number of the record; none for a text without tokens."""
    lists = aligner.parts(texts)
    have = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().dictionary_encode()
    units, first = without_signs(flat.dictionary) if aligner.cut_signs else (flat.dictionary, np.arange(len(flat.dictionary) + 1))
    units = units.dictionary_encode()
    records, at = cache(units.dictionary.to_numpy(zero_copy_only=False).tolist())
    unit = flat.indices.to_numpy(zero_copy_only=False)
    each = np.diff(first)[unit]
    text = np.repeat(np.repeat(np.arange(len(have)), have), each)
    at = at[units.indices.to_numpy(zero_copy_only=False)][spans(first[unit], each)]
    good = records.good[at]
    if not good.all():                                     # once more as a whole
        again = np.unique(text[~good])
        more = aligner.one_by_one([b" " + t for t in texts.take(pa.array(again)).to_pylist()])
        kept = ~np.isin(text, again)
        text, at = np.concatenate([text[kept], again[more.good]]), np.concatenate([at[kept], len(records) + np.flatnonzero(more.good)])
        order = np.argsort(text, kind="stable")
        records, text, at = Records.joined([records, more]), text[order], at[order]
    return records, text, at


def _of_texts(aligner: Aligner, cache: UnitCache, texts: list[bytes]) -> list[tuple[bytes, bytes, bytes, bytes]]:
    """Of each text: the four numbers, the text of its groups, its distinct pairs in order, and the times of each."""
    n = len(texts)
    records, text, at = _parts(aligner, cache, pa.array(texts, pa.large_binary()))
    parts = np.bincount(text, minlength=n)
    groups = pc.binary_join(lists_of(records.text.take(pa.array(at)), parts), pa.scalar(";", pa.large_string())).cast(pa.large_binary()).to_pylist()
    sums = np.zeros((len(at) + 1, 4), np.int64)
    np.cumsum(records.numbers[at], axis=0, out=sums[1:])
    numbers = np.diff(sums[np.concatenate([[0], np.cumsum(parts)])], axis=0)
    have = records.have[at]
    rows = records.rows[spans(records.first[at], have)]
    key = np.repeat(text, have) << 2 * SHIFT | rows[:, 0]
    order = np.argsort(key)
    key, times = key[order], rows[order, 1]
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    times = np.add.reduceat(times, new) if len(new) else times
    key = key[new]
    upto = (8 * np.concatenate([[0], np.cumsum(np.bincount(key >> 2 * SHIFT, minlength=n))])).tolist()
    pairs, times = (key & ((1 << 2 * SHIFT) - 1)).tobytes(), times.tobytes()
    return [(x.tobytes(), g, pairs[lo:hi], times[lo:hi]) for x, g, lo, hi in zip(numbers, groups, upto[:-1], upto[1:])]


def _align(a_path: str, b_path: str):
    def run(batches):
        aligner = worker_state(f"aligner {a_path} {b_path}", lambda: Aligner(a_path, b_path), "alignment")
        cache = worker_state(f"aligned {a_path} {b_path}", lambda: UnitCache(aligner), "alignment")
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                found = _of_texts(aligner, cache, as_bytes(part.column("text")))
                for lo in range(0, len(found), ROWS_OUT):
                    numbers, groups, pairs, times = zip(*found[lo: lo + ROWS_OUT])
                    numbers = np.frombuffer(b"".join(numbers), np.int64).reshape(-1, 4)
                    have = np.array([len(x) // 8 for x in pairs])
                    yield pa.RecordBatch.from_arrays([
                        *[part.column(c).slice(lo, ROWS_OUT) for c in ("row", "doc_id")], *[pa.array(numbers[:, k]) for k in range(4)],
                        pa.array(groups, pa.string()), *[lists_of(np.frombuffer(b"".join(x), np.int64), have) for x in (pairs, times)],
                    ], ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])
    return run


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: row (its number), doc_id, n_a, n_b,
    n_groups, n_links, groups (``a1,a2|b1;a3|b2``: ids in order), pairs (the distinct
    linked id pairs, ``a << 20 | b``) and times (token pairs of each)."""
    rows = short_batches(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return rows.mapInArrow(_align(a_path, b_path), ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n (documents that hold it linked), best (n is the highest of all pairs of its A id)."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    counts = counts.withColumn("a", F.shiftright("pair", SHIFT))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _most_frequent(counts: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """The most frequent pairs, sorted, at most ``limit``: (pair, n, best), and whether that is all of them."""
    step = F.floor(4 * F.log2("n"))
    total, least, every = 0, 4 * 64, True
    for r in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():       # at most 4 * 64 rows
        total += r["count"]
        if total > limit:
            every = False
            break
        least = r["step"]
    hot = counts.where(step >= least).toPandas().sort_values("pair")
    return hot["pair"].to_numpy(np.int64), hot["n"].to_numpy(np.int64), hot["best"].to_numpy(bool), every


def _scored(pair: np.ndarray, n: np.ndarray, best: np.ndarray):
    """n_best and count_sum over the pairs of the list; the other pairs go on."""
    def run(batches):
        for batch in batches:
            have = batch.column("pairs").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            own, times = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("pairs", "times"))
            row = np.repeat(np.arange(len(have)), have)
            at = np.minimum(np.searchsorted(pair, own), max(len(pair) - 1, 0))
            known = pair[at] == own if len(pair) else np.zeros(len(own), bool)
            sums = np.zeros((2, len(have)), np.int64)
            hit, weight = at[known], times[known]
            np.add.at(sums[0], row[known], weight * best[hit])
            np.add.at(sums[1], row[known], weight * n[hit])
            left = np.bincount(row[~known], minlength=len(have))
            carried = [c for c in batch.schema.names if c not in ("pairs", "times")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carried], pa.array(sums[0]), pa.array(sums[1]), lists_of(own[~known], left), lists_of(times[~known], left)],
                                             [*carried, "n_best", "count_sum", "pairs", "times"])
    return run


def link_scores(aligned: DataFrame, scratch: Scratch, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """``aligned`` (a written table) without its pairs, with n_best (links whose count is the highest of their A id) and count_sum (of the links' counts)."""
    counts = scratch.written(pair_counts(aligned), "counts")
    pair, n, best, every = _most_frequent(counts, hot_pairs)
    carried = [c for c in aligned.columns if c not in ("pairs", "times")]
    kind = ", ".join(f"{c} {aligned.schema[c].dataType.simpleString()}" for c in carried)
    scored = aligned.mapInArrow(_scored(pair, n, best), f"{kind}, n_best long, count_sum long, pairs array<long>, times array<long>")
    if every:
        return scored.drop("pairs", "times")
    scored = scratch.written(scored, "scored")
    rest = scored.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    more = rest.join(counts, "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
                                                        F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    out = scored.drop("pairs", "times").join(more, "row", "left")
    return out.withColumns({"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
                            "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))}).drop("more_best", "more_sum")


def alignment_digest(docs: DataFrame, a_path: str, b_path: str, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    scratch = Scratch(docs.sparkSession, "alignment")
    sha = F.when(F.col("n_a") == 0, F.lit("")).otherwise(F.sha2("groups", 256))
    aligned = scratch.written(align(docs, a_path, b_path).withColumn("groups_sha256", sha).drop("groups"), "aligned")
    return scratch.result(link_scores(aligned, scratch, hot_pairs).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))
