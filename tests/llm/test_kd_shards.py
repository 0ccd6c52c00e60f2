"""K-d tree sharding: laws of its result, and its cuts against exact weighted medians."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

from areacube.llm import kd_shards as K

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, node int, p0 string"


def made(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = "é" * rng.randint(0, 30) if i % 50 else None
        rows.append((i if i % 33 else None, text, rng.choice(["en", "en", "en", "de", None]), "hot" if i % 3 else f"s{rng.randint(0, 9)}",
                     None if i % 41 == 0 else len(text or ""), "clash", 7, "clash"))
    return rows


def sharded(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return [tuple(r) for r in K.digest(K.kd_shards(df, **kw)).collect()]


def laws(rows, got, shards):
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter(g[:3] for g in got) == want
    assert {g[3] for g in got} <= {"bytes"} and {g[6] for g in got} <= {None}
    slots = defaultdict(list)
    for g in got:
        slots[g[4]].append(g[5])
    assert set(slots) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return [sum(g[1] for g in got if g[4] == s) for s in range(shards)]


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_near_equal_bytes_and_gapless_slots(spark, shards, monkeypatch):
    monkeypatch.setattr(K, "BLOCK_ROWS", 40)
    monkeypatch.setattr(K, "BINS", 8)                                  # several looks at a node
    rows = made(3000)
    sizes = laws(rows, sharded(spark, rows, shards=shards), shards)
    heaviest = max(len((r[1] or "").encode()) + 1 for r in rows)
    assert max(sizes) - min(sizes) <= 5 * heaviest


def test_repeated_rows_are_cut_too(spark):
    rows = [(5, "same text", "en", "hot", 9, "", 0, "")] * 2000 + made(500)
    sizes = laws(rows, sharded(spark, rows, shards=8), 8)
    assert max(sizes) <= 1.06 * sum(sizes) / 8


def test_few_rows_other_columns_and_empty(spark):
    rows = made(5)
    laws(rows, sharded(spark, rows, shards=16), 16)
    assert sharded(spark, [], shards=16) == []
    bare = spark.createDataFrame([(i, "x" * 20) for i in range(640)], "doc_id long, text string")
    got = K.kd_shards(bare, target_bytes=840).collect()
    assert Counter(r.shard for r in got) == {s: 40 for s in range(16)}
    odd = spark.createDataFrame([(i, "x", float(v)) for i, v in enumerate(["nan", "inf", "-inf", 1e308, -1e308, 0.0])], "doc_id long, text string, w double")
    assert sorted(r.shard for r in K.kd_shards(odd, shards=6, dims=("w",)).collect()) == [0, 1, 2, 3, 4, 5]
    with pytest.raises(ValueError):
        K.kd_shards(bare)


def test_cuts_are_weighted_medians(spark):
    """One coordinate, no ties: a shard is a range of it, cut where half the weight lies."""
    rng = random.Random(3)
    values = rng.sample(range(1 << 20), 999)
    df = spark.createDataFrame([(v, "x" * rng.randint(0, 200), v) for v in values], "doc_id long, text string, w long")
    got = sorted((r.doc_id, r["size"], r.shard) for r in K.kd_shards(df, shards=2, dims=("w",)).collect())
    left = [g for g in got if g[2] == 0]
    assert got[: len(left)] == left
    total, half = sum(g[1] for g in got), sum(g[1] for g in left)
    best = min(abs(2 * sum(g[1] for g in got[:k]) - total) for k in range(len(got)))
    assert abs(2 * half - total) <= max(best, 2 * K.CLOSE * total)


def test_no_python_on_the_path(spark):
    df = spark.createDataFrame(made(50), SCHEMA)
    rows = K.points(df, K.DIMS)
    plan = K.numbered(rows.withColumn("shard", K.Tree([K.Node(1, 0)]).place([], 0)), 2)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
