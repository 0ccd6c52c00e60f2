"""Hard-negative mining against brute force in whole numbers."""

import math
import random

import pytest
from pyspark.sql import functions as F

from areacube.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, score string"


def brute(rows, k=5, low=80, of=100):
    def whole(x):
        return max(-2**63, min(2**63 - 1, math.floor(256 * x)))
    good = {(i, lab, tuple(whole(x) for x in v)) for i, v, lab, *_ in rows
            if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}

    def score(a, b):
        return max(-2**63, min(2**63 - 1, sum(x * y for x, y in zip(a[2], b[2]))))
    out = []
    for a in (r for r in good if r[0] % 100 == 0):
        met = sorted(((-score(a, r), r[0], r) for r in good if r[0] != a[0] and len(r[2]) == len(a[2])), key=lambda x: x[:2])
        for s, i, _ in [m for m in met if m[2][1] == a[1]][:k]:
            fit = [m for m in met if m[2][1] != a[1] and low * -s <= of * -m[0] <= of * -s][:k]
            out += [(a[0], i, rank + 1, m[1], -s, -m[0]) for rank, m in enumerate(fit)]
    return sorted(out)


def mined(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in H.hard_negatives(df, F.col("vec_id") % 100 == 0, **kw).collect())


def made(seed, n, coarse):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        v = [rng.randint(-2, 3) / coarse if coarse else rng.gauss(0.4, 1) for _ in range(4)]
        rows.append((i * 10, v, 0 if rng.random() < 0.4 else rng.randint(1, 3), "x"))
    return rows


@pytest.mark.parametrize("seed,coarse", [(1, 4), (2, 0), (3, 1)])
def test_against_brute_force(spark, seed, coarse, monkeypatch):
    monkeypatch.setattr(H, "ROW_BYTES", 32 * 100)              # several blocks and tiles
    monkeypatch.setattr(H, "ANCHOR_BYTES", 32 * 15)
    rows = made(seed, 400, coarse)
    assert mined(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = made(4, 150, 2) + [
        (None, [1.0] * 4, 1, ""), (1, None, 1, ""), (2, [1.0] * 4, None, ""), (3, [1.0, None, 1.0, 1.0], 1, ""),
        (4, [1.0, math.nan, 1.0, 1.0], 1, ""), (5, [math.inf, 1.0, 1.0, 1.0], 1, ""), (6, [1.0], 1, ""), (7, [2.0], 2, ""), (9900, [], 1, ""), (9901, [], 1, ""),
        (9902, [], 2, ""), (8, [1e300, 1.0, -1e300, 3.0], 1, ""), (9, [1e7, 1e8, 1e6, 1e9], 2, ""), (11, [3.0e9, 1.0, 1.0, 1.0], 1, ""), (0, [0.0] * 4, 2, "")]
    rows += [rows[20]] * 3
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, []) == []


def test_few_rows_and_other_limits(spark):
    rows = [(0, [1.0], 1, ""), (1, [1.0], 1, ""), (2, [0.9], 2, ""), (3, [0.4], 2, ""), (4, [-1.0], 1, "")]
    assert mined(spark, rows) == brute(rows) == [(0, 1, 1, 2, 65536, 230 * 256)]
    assert mined(spark, rows, positives=1, negatives=1, low=0) == [(0, 1, 1, 2, 65536, 230 * 256)]


def test_exact_beyond_doubles():
    import numpy as np
    a, b = np.array([[2**40 + 1, 3], [1, 1]]), np.array([[2**20 + 1, 5], [2**62, 2**62], [-2**62, -2**62]])
    got = H.inner(a, b)
    want = [[max(-2**63, min(2**63 - 1, sum(int(x) * int(y) for x, y in zip(p, q)))) for q in b] for p in a]
    assert got.tolist() == want
