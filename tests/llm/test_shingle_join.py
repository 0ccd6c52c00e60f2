"""Jaccard join against brute force."""

import random
import re
from pathlib import Path

import numpy as np

from areacube.llm import components as C
from areacube.llm import shingle_join as J
from areacube.llm.common import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3)))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def joined(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(tuple(r) for r in J.link_components(df, **kw).collect())


def varied(seed, base, n, top):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(rng.randint(0, top)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(999)}"
        out.append(" ".join(w))
    return out


def test_against_brute_force(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(n)) for n in (5, 9, 17, 40, 130, 300)]
    common = " ".join(f"c{i}" for i in range(60))
    texts = [t for i, b in enumerate(base) for t in varied(i, b, 25, 4)]
    texts += [f"{common} {' '.join(rng.choice('pqrstuvw') for _ in range(rng.randint(0, 20)))}" for _ in range(60)]
    texts += ["", None, " \n ", "one", "One", "one two", "one two three", "ONE TWO  three", "é É", "q " * 3000]
    rows = list(enumerate(texts)) + [(1000, texts[0]), (1000, texts[0]), (1001, texts[130])]
    want = brute(rows)
    assert joined(spark, rows) == want
    assert joined(spark, rows, hot_texts=10**6) == want


def test_later_rounds_lose_no_link(spark, monkeypatch):
    """Many texts of little more than one passage: groups that one leader does not settle."""
    monkeypatch.setattr(J, "LEADERS", 2)
    rng = random.Random(9)
    common = [f"c{i}" for i in range(30)]
    texts = [" ".join(common[: rng.randint(15, 30)] + [f"u{rng.randrange(10**6)}" for _ in range(rng.randint(0, 8))]) for _ in range(120)]
    rows = list(enumerate(texts))
    assert joined(spark, rows, hot_texts=3) == brute(rows)


def test_documents_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    assert sorted(tuple(r) for r in J.link_components(df).collect()) == brute(rows)


def test_empty_table(spark):
    assert joined(spark, []) == []


def test_extra_columns(spark):
    df = spark.createDataFrame([(2, "a b c d", "x", 1), (1, "A b c d", "y", 2), (None, None, None, None)],
                               "doc_id long, text string, node string, sig int")
    got = {r.doc_id: tuple(r) for r in J.link_components(df).collect()}
    assert got == {1: (1, 1, 1), 2: (2, 1, 1), None: (None, 0, None)}


def test_divide_skip_counts():
    rng = np.random.default_rng(0)
    for need in (1, 3, 8, 15):
        lists = [np.sort(rng.choice(50, rng.integers(0, 40), replace=False)) for _ in range(16)]
        count = np.bincount(np.concatenate(lists), minlength=50)
        assert J.divide_skip(lists, need) == {i: c for i, c in enumerate(count.tolist()) if c >= need and c}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(500, 560)] + [(7, 7)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r.node: r.root for r in C.components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}
