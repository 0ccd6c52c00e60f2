"""Packing: an exact round trip of every token."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from areacube.llm import packing as K


def check(rows, pieces, window):
    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = defaultdict(list)
    for d, t in rows:
        want[d].append([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2])
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(want)
    for d, own in by_doc.items():
        if len(want[d]) == 1:
            ids, at = want[d][0], 0
            for p in sorted(own, key=lambda p: p.start):
                assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
                assert p.ids_crc32 == zlib.crc32(np.array(ids[at: at + p.length], "<u4").tobytes())
                at += p.length
            assert at == len(ids)
        else:
            assert sum(p.length for p in own) == sum(map(len, want[d]))
    padding = 0
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


def test_round_trip(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["alpha", "beta,", "Gamma.", "Él", "x9", "\n"]) for _ in range(rng.choice([0, 1, 5, 300, 900])))) for i in range(120)]
    rows += [(500, "one two " * 9000), (501, None), (502, ""), (503, "tie"), (503, "tie two")]
    df = spark.createDataFrame([(d, t, "s", 1) for d, t in rows], "doc_id long, text string, shard string, offset int")
    got = K.digest(K.pack(df)).collect()
    assert check(rows, got, 4096) == 0


def test_empty(spark):
    assert K.digest(K.pack(spark.createDataFrame([], "doc_id long, text string"))).collect() == []


def test_neighbours_are_lexical():
    docs = [np.array(x, np.uint32) for x in ([1, 2, 3, 9], [50, 51, 52, 9], [1, 2, 3, 4, 9], [50, 51, 60, 9])]
    index = K.Bm25(docs)
    assert index.neighbours(0, np.array([False, True, True, True]))[0] == 2
    assert index.neighbours(1, np.array([True, False, True, True]))[0] == 3
    assert index.neighbours(0, np.array([False, True, False, True])).tolist() in ([1, 3], [3, 1])
    order = [p[0] for p in K.fill(docs, 64)]
    assert order == [0, 0, 2, 1, 3] or order[:1] == [0] and order.index(2) < order.index(1)


def test_powers_of_two():
    assert K.powers(13) == [8, 4, 1] and K.powers(4096) == [4096]
