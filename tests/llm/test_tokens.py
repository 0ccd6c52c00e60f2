"""Token files and byte-level BPE against the libraries themselves."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from areacube.llm import bpe, token_files, tokens

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "  ", "\n", "a", " a", "a ", "  a  b ", "a\n b", "a \nb\t\tc", "x\0y z", "é  b", "it's we'll I'M 'tis", "...,, !!",
       "a" * 700, "ab" * 400 + " z", "　wide　 space", "日本語 テキスト 🙂🙂 é", "1234 5,678.90", "<|endoftext|> x<|endoftext|>", "Foo<|endoftext|> bar\n<|endoftext|>\nB <|startoftext|>X", "<|ENDOFTEXT|> A <|StartOfText|>",
       "tab\tand\x1cfs \x1c x", "​ zero ﻿", "ÀÉ. Öö, ß ÿ ǅ İ Σς", "word,word. Word.\nNext Line.", " " * 50 + "q", "Œuvre ŸÿÝ", "ª º x²"]


def sample():
    rng = random.Random(7)
    import pyarrow.parquet as pq
    texts = pq.read_table(f"{SF}/documents.parquet", columns=["text"])["text"].to_pylist()
    return ODD + rng.sample(texts, 60) + ["".join(rng.choice(["ab", " ", "\n", "é", "The", "'s", "9", ",", "  "]) for _ in range(40)) for _ in range(80)]


@pytest.mark.parametrize("limit", [3, 400_000])
def test_units_give_the_librarys_ids(limit):
    for name, cut, lower in (("byte_bpe_50k.json", tokens.space_units, False), ("word_bpe_49k.json", tokens.word_units, True)):
        tokenizer = Tokenizer.from_file(P.path(name))
        cache = tokens.UnitCache(tokens.LibraryEncoder(P.path(name), lower), limit)
        texts = sample()
        for text, ids in zip(texts, cache([cut(t.encode()) for t in texts[:20]]) + [cache([cut(t.encode())])[0] for t in texts[20:]]):
            assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, (name, text[:60])


def test_arrow_lists_hold_the_units():
    import pyarrow as pa
    texts = [t for t in sample() if "\0" not in t]
    for some in (texts, ODD, [], ["x\0y z", "", "a b"]):
        column = pa.array(some, pa.string())
        assert tokens.space_lists(column).to_pylist() == [tokens.space_units(t.encode()) for t in some]
        assert [[u for u in x if u] for x in tokens.word_lists(column).to_pylist()] == [tokens.word_units(t.encode()) for t in some]


def test_each_different_unit_is_looked_up_once():
    import pyarrow as pa
    asked = []

    class Cache(tokens.UnitCache):
        def each(self, units):
            asked.extend(units)
            return super().each(units)

    cache = Cache(lambda units, known: [u + b"..." for u in units])
    lists = pa.array([[b"a", b"b", b"a"], [], [b"b"] * 50, [b""]], pa.list_(pa.large_binary()))
    want = [b"a...b...a...", b"", b"b..." * 50, b"..."]
    assert cache.of_lists(lists, b"|") == [x + b"|" for x in want] and sorted(asked) == [b"", b"a", b"b"]
    assert cache.of_lists(lists.slice(2)) == want[2:] and cache.of_lists(lists.slice(0, 0)) == []


SIGNED = [b" word", b" word.", b" word,", b"word", b" word.,!!", b"word'", b"it's.", b"(word).", b"[PAD]", b"abc12.", b"...", b" .", b"",
          b"\xc3\xa9t\xc3\xa9?", b"\xc3\x97.", b"x\xff.", b"<|endoftext|>.", b"word<|endoftext|>", b"WORD.\n\n", b"\xc3\x89T\xc3\x89!", b"a\xc3."]


def test_a_word_is_looked_up_once_whatever_signs_follow():
    import pyarrow as pa
    asked = []

    class Cache(tokens.UnitCache):
        def each(self, units):
            asked.extend(units)
            return super().each(units)

    cache = Cache(lambda units, known: [b"[%s]" % u for u in units])
    lists = pa.array([SIGNED[:5], [], SIGNED[3:4] + SIGNED[13:14]], pa.list_(pa.large_binary()))
    assert cache.of_lists(lists, b"|") == [b"[ word][ word][.][ word][,][word][ word][.,!!]|", b"|", b"[word][\xc3\xa9t\xc3\xa9][?]|"]
    assert sorted(asked) == sorted([b" word", b"word", b".", b",", b".,!!", b"\xc3\xa9t\xc3\xa9", b"?"])
    parts, first = tokens.without_signs(pa.array([b"cut", *SIGNED], pa.large_binary()).slice(1))
    parts = parts.to_pylist()
    assert [b"".join(parts[a:b]) for a, b in zip(first[:-1], first[1:])] == SIGNED
    two = [u for u, n in zip(SIGNED, np.diff(first)) if n == 2]
    assert two == [b" word.", b" word,", b" word.,!!", b"word'", b"\xc3\xa9t\xc3\xa9?", b"\xc3\x89T\xc3\x89!"]


@pytest.mark.parametrize("name, lower", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_the_library_gives_many_words_in_one_result(name, lower):
    import pyarrow as pa
    tokenizer, encoder = Tokenizer.from_file(P.path(name)), tokens.LibraryEncoder(P.path(name), lower)
    asked = []

    class Pieces:
        def encode_batch_fast(self, texts, **kw):
            asked.append(len(texts))
            return own.encode_batch_fast(texts, **kw)

    own, encoder.pieces = encoder.pieces, Pieces()
    cache = tokens.UnitCache(encoder)
    units = SIGNED if not lower else [u.strip() for u in SIGNED]
    got = cache.of_lists(pa.array([[u] for u in units], pa.list_(pa.large_binary())))
    assert asked == [1]
    for u, ids in zip(units, got):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(u.decode("utf-8", "replace"), add_special_tokens=False).ids, u


def test_batches_are_gathered_up_to_their_bytes():
    import pyarrow as pa

    from areacube.llm.common import gathered
    batches = [pa.record_batch({"n": pa.array(range(k), pa.int64())}) for k in (2, 3, 0, 9, 1, 1, 4)]
    got = list(gathered(iter(batches), 48))
    assert [b.num_rows for b in got] == [5, 9, 6] and pa.Table.from_batches(got) == pa.Table.from_batches(batches).combine_chunks()
    assert list(gathered(iter(()), 48)) == []


def test_large_state_goes_when_another_operator_asks():
    import weakref

    from areacube.llm.common import worker_state
    small = worker_state("test small", dict)
    cache = weakref.ref(worker_state("test units", set, "one"))
    assert worker_state("test units", set, "one") is cache() and worker_state("test more", dict, "one") == {} and cache() is not None
    assert worker_state("test small", dict) is small and cache() is None
    cache = weakref.ref(worker_state("test units", set, "one"))
    worker_state("test units", set, "two")
    assert cache() is None


def test_workers_give_back_memory_when_packing_comes(monkeypatch):
    import sys

    from areacube.llm import common, words
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    words.prefix_hashes(np.ones(3, np.uint64), words.BYTE_BASE)
    kept = sys.modules["_areacube_llm_worker"].large
    assert list(kept) == ["word hashes"]
    path = P.path("word_bpe_49k.json")
    given.clear()
    tokens.word_ids(path)
    assert list(kept) == ["words"] and given == [1]                                # the tables of word hashes went
    assert kept["words"][f"words {path}"].limit == tokens.CACHE_WORDS < tokens.CACHE_UNITS
    kept.clear()
    tokens.word_ids(path)
    assert given == [1, 1]                                                          # also after an operator that kept nothing


def tiktoken_encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_segment_tree_forms_agree():
    ranks = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    own, enc = bpe.SegmentTreeBpe(ranks), tiktoken_encoding()
    rng = random.Random(2)
    pieces = [bytes(rng.choice(b"etaoin shr") for _ in range(rng.randint(1, 64))) for _ in range(400)] + [b"a" * 64, b"\xff\xfe\x00", b"ab" * 31]
    for piece, ids in zip(pieces, own(pieces)):
        got = np.frombuffer(ids, "<u4").tolist()
        if piece not in ranks:
            assert got == own.merge_one(piece) == enc._encode_single_piece(piece)
        assert b"".join(own.token[i] for i in got) == piece


def test_queries_match_the_libraries(spark):
    texts = sample() + [None]
    rows = [(i * 3 - 5, t, "x", None) for i, t in enumerate(texts)] + [(4, "tie b", "y", 1), (4, "tie a", "y", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, before int").repartition(3)
    enc = tiktoken_encoding()
    got = sorted(tuple(r) for r in bpe.digest(bpe.encode_decode(df)).collect())
    want = []
    for d, t, *_ in rows:
        ids = enc.encode_ordinary(t or "")
        want.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)

    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = sorted(tuple(r) for r in token_files.digest(token_files.written_and_read(df)).collect())
    want, start = [], 0
    for d, t, *_ in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == sorted(want)


def test_token_files_lookup_and_empty(spark, tmp_path):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    path = str(tmp_path / "t")
    token_files.write_tokens(df, path, P.path("byte_bpe_50k.json"))
    one = token_files.read_tokens(spark, path, F.col("doc_id") == 4321)
    assert [r.doc_id for r in one.collect()] == [4321]
    assert "EqualTo(doc_id,4321)" in one._jdf.queryExecution().toString()
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.digest(token_files.written_and_read(none)).collect() == []
    assert bpe.digest(bpe.encode_decode(none)).collect() == []
