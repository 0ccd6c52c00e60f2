"""Substring removal against brute force."""

import hashlib
import random
import re
from collections import Counter

from areacube.llm import substring_dedup as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width):
    count = Counter()
    words = [WORD.findall(t or "") for _, t in rows]
    for w in words:
        count.update(tuple(w[i:i + width]) for i in range(len(w) - width + 1))
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - width + 1):
            if count[tuple(w[i:i + width])] > 1:
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(spark, rows, width):
    df = spark.createDataFrame(rows, "doc_id long, text string, block string, hashes int, lang string") \
        if rows and len(rows[0]) == 5 else spark.createDataFrame(rows, "doc_id long, text string")
    out = S.digest(S.remove_repeats(df, width)).collect()
    return sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out], key=str)


def test_against_brute_force(spark):
    rng = random.Random(5)
    vocab = ["a", "B", "é", "d d", " x", "zz,"]
    shared = [" ".join(rng.choice(vocab) for _ in range(9)) for _ in range(3)]
    rows = [(i, "\n".join(rng.choice([" ".join(rng.choice(vocab) for _ in range(rng.randint(0, 12))), rng.choice(shared)])
                          + rng.choice(["", " ", "\t\x0b"]) for _ in range(rng.randint(0, 5)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "   "), (103, rows[5][1]), (103, rows[5][1]), (104, "q " * 5000), (105, "one")]
    assert rows_of(spark, rows, 5) == brute(rows, 5)
    assert rows_of(spark, rows, 35) == brute(rows, 35)


def test_extra_columns_and_empty(spark):
    rows = [(1, "a b c d e f", "x", 3, None), (2, "a b c d e z", "y", None, "en")]
    assert rows_of(spark, rows, 5) == brute([(r[0], r[1]) for r in rows], 5)
    assert rows_of(spark, [], 5) == []


def test_intervals_are_maximal_and_cleaned_keeps_lines(spark):
    rows = [(1, "k0 k1\na b c d e f g\nk2"), (2, "a b c d e f g"), (3, "u v w")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in S.remove_repeats(df, 5).collect()}
    assert [(x.start, x.end) for x in got[1].removed] == [(2, 9)]
    assert got[1].cleaned == "k0 k1\nk2"
    assert got[2].cleaned == "" and got[3].cleaned == "u v w"
