"""Text statistics against brute force, and learned rules."""

import random
import re
from collections import Counter

import numpy as np

from areacube.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    count = Counter(windows)
    cover = set()
    for i, x in enumerate(windows):
        if count[x] > 1:
            cover.update(range(i, i + 8))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(cover)


def test_statistics(spark):
    rng = random.Random(8)
    texts = ["", None, " ", "\n\n", "é", "a\n", "\na\na \na", "x y z\n" * 9, "1 2 3 4 5 6 7 8 9 " * 3, "<b> & #|%$*", "ü" * 30000]
    texts += ["".join(rng.choice(["a b c d e f g h", "\n", " q", "é#", "\t", "line\n", "日本"]) for _ in range(rng.randint(0, 30))) for _ in range(150)]
    rows = [(i, t, 7) for i, t in enumerate(texts)] + [(None, "a b", 1), (3, "again", 1), (3, "again", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    labels = spark.createDataFrame([(1, None, 0), (2, 1, 0), (99999, 0, 0)], "doc_id long, quality int, toxic int")
    got = sorted((tuple(r) for r in Q.judged(df, labels).drop("rule").collect()), key=str)
    want = []
    for d, t, _ in rows:
        n, *rest, r = brute(t)
        failed = n < 20 or 100 * r > 30 * n
        want.append((d, n, *rest, r, failed, not failed))
    assert got == sorted(want, key=str)


def test_learns_thresholds_and_stops_at_noise():
    rng = np.random.default_rng(0)
    x = {"a": rng.random(3000), "b": rng.random(3000), "c": rng.random(3000)}
    bad = (x["a"] > 0.9) | ((x["b"] < 0.2) & (x["c"] > 0.7))
    rules = Q.learn(x, bad)
    hit = np.any([Q._marked(r, x, 3000) for r in rules], axis=0)
    assert (hit & ~bad).sum() <= 0.02 * hit.sum() and (hit & bad).sum() >= 0.9 * bad.sum()
    assert Q.learn(x, rng.random(3000) < 0.1) == []
    assert Q.learn({k: v[:0] for k, v in x.items()}, bad[:0]) == []


def test_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    learn, test = labels[labels.doc_id % 2 == 0], labels[labels.doc_id % 2 == 1]
    out = Q.judged(docs, spark.createDataFrame(learn)).toPandas().merge(test, on="doc_id")
    good, bad = out[out.quality == 1], out[(out.quality == 0)]
    assert (good.kept | good.base_failed).mean() >= 0.97
    assert (~bad.kept).mean() >= 0.8


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert Q.judged(docs, labels).collect() == []
