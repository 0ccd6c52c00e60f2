"""Token alignment against the libraries and a brute-force search of common ends."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from areacube.llm import alignment as L
from areacube.llm.tokens import byte_letters

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  ", "\n", "a", " a", "a ", "  a  b ", "a\n b", "a \nb\t\tc", "x\0y z", "é  b", "▁", "a ▁b", "it's we'll", "aaaa" * 300, "日本語 テキスト 🙂🙂 é",
       "<|endoftext|> x<s></s><unk> <0x41>", "word,word. Word.\nNext Line.\n", "\nx\n\ny\n", "tab\tand\x1cfs \x1c x\x85y", "　wide　 space", "a\r\nb\rc", "ﬁ ǅ İ", " " * 40 + "q",
       "🙂" * 50, "same text", "same text"]


def sample():
    import pyarrow.parquet as pq
    rng = random.Random(5)
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"])["text"].to_pylist()
    return ODD + rng.sample(texts, 40) + ["".join(rng.choice(["ab", " ", "\n", "é", "The", "'s", "9", ",", "  ", "🙂", "x"]) for _ in range(40)) for _ in range(80)]


def tokens_of(text, tok, sp, table):
    if not text:
        return [], [], [], []
    want = (" " + text).encode()
    a, b = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
    a_bytes = [table[i] for i in a]
    b_bytes = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
    return (a, b, a_bytes, b_bytes) if b"".join(a_bytes) == want == b"".join(b_bytes) else ([], [], [], [])


def brute(texts):
    tok, sp = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    letter = {c: b for b, c in byte_letters().items()}
    table = {i: bytes(letter[c] for c in w) for w, i in json.load(open(A))["model"]["vocab"].items() if all(c in letter for c in w)}
    found, held = [], Counter()
    for text in texts:
        a, b, ab, bb = tokens_of(text, tok, sp, table)
        ends = sorted(set(np.cumsum([len(x) for x in ab])) & set(np.cumsum([len(x) for x in bb])))
        groups = [([], []) for _ in ends]
        for side, ids, parts in ((0, a, ab), (1, b, bb)):
            at = 0
            for i, x in zip(ids, parts):
                at += len(x)
                groups[next(k for k, e in enumerate(ends) if e >= at)][side].append(i)
        links = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        held.update(links.keys())
        found.append((a, b, groups, links))
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for k, (a, b, groups, links) in enumerate(found):
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((k, len(a), len(b), len(groups), sum(links.values()), sum(n for p, n in links.items() if held[p] == top[p[0]]),
                    sum(n * held[p] for p, n in links.items()), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


@pytest.mark.parametrize("hot", [L.HOT_PAIRS, 40, 0])
def test_against_brute_force(spark, hot):
    texts = sample()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, row string, pairs int").repartition(3)
    got = sorted(tuple(r) for r in L.alignment_digest(df, A, B, hot).collect())
    for g, w in zip(got, brute(texts), strict=True):
        assert g == w, texts[g[0]]


def test_coalesced_breaks_where_both_end():
    rng = np.random.default_rng(0)
    for _ in range(50):
        cuts = [np.unique(rng.integers(1, 30, rng.integers(0, 12))) for _ in range(2)]
        start, end = [], []
        for c in cuts:
            edge = [0, *c.tolist(), 30]
            start += edge[:-1]
            end += edge[1:]
        common = sorted({0, 30, *(set(cuts[0].tolist()) & set(cuts[1].tolist()))})
        got = L.coalesced(np.array(start), np.array(end))
        assert got.tolist() == (np.searchsorted(common, start, side="right") - 1).tolist()


def test_small_cache_repeated_and_empty(spark):
    texts = [t for t in sample() if t][:60]
    aligner = L.Aligner(A, B)
    small, large = L.UnitCache(aligner, 3), L.UnitCache(aligner, 1000)
    coded = [t.encode() for t in texts]
    assert [L._of_texts(aligner, small, [t])[0] for t in coded] == L._of_texts(aligner, large, coded)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert L.alignment_digest(none, A, B).collect() == []
    twice = spark.createDataFrame([(None, "one two"), (3, "one two"), (3, "one two")], "doc_id long, text string")
    assert sorted(r.count_sum for r in L.alignment_digest(twice, A, B).collect()) == [6, 6, 6]


def test_words_are_aligned_once_whatever_signs_follow_and_many_at_a_time():
    aligner, made, single = L.Aligner(A, B), [], []
    one_by_one = aligner.one_by_one
    aligner.one_by_one = lambda parts: single.extend(parts) or one_by_one(parts)

    def make(parts, *_):
        made.extend(parts)
        return aligner(parts)
    cache = L.UnitCache(make)
    texts = [b"a word, a word. word! other", b"one word; x9", b"", b"word\nword"]
    got = L._of_texts(aligner, cache, texts)
    assert sorted(made) == sorted({b" a", b" word", b"word", b",", b".", b"!", b";", b" other", b" one", b" x9", b"\n"})
    assert sorted(single) == sorted({b",", b".", b"!", b";", b" x9", b"\n"})
    plain = L.Aligner(A, B)
    plain.of_runs, plain.cut_signs = lambda runs: None, False                     # each part by itself, words with their signs
    assert L._of_texts(plain, L.UnitCache(plain), texts) == got


def test_records_kept_are_bounded():
    aligner = L.Aligner(A, B)
    texts = [f"w{i} x{i}y z".encode() for i in range(300)]
    for cache in (L.UnitCache(aligner, 50), L.UnitCache(aligner, most=2000)):
        got = [x for i in range(0, 300, 5) for x in L._of_texts(aligner, cache, texts[i: i + 5])]
        assert len(cache.kept) == len(cache.at) <= 60
        assert got == L._of_texts(aligner, L.UnitCache(aligner), texts)
