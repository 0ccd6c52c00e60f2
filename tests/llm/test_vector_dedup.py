"""Near-duplicate vectors against brute force."""

import numpy as np

from areacube.llm import vector_dedup as V

KIND = "vec_id long, embedding array<float>, label int"


def brute(rows):
    good = {}
    for i, e, label in rows:
        if i is None or e is None or label is None or not len(e) or any(v is None or not np.isfinite(v) for v in e) or not any(e):
            continue
        x = np.asarray(e, np.float32).astype(np.float64)
        good[i] = (x / np.linalg.norm(x), label)
    links = {i: set() for i, *_ in rows}
    for i, (x, a) in good.items():
        for j, (y, b) in good.items():
            if i < j and a == b and len(x) == len(y) and x @ y >= 0.98:
                links[i].add(j)
                links[j].add(i)
    root = {}
    for i in sorted(links, key=lambda v: (v is None, v)):
        if i in root:
            continue
        todo = [i]
        while todo:
            j = todo.pop()
            if j not in root:
                root[j] = i
                todo += links[j]
    return sorted(((i, len(links[i]), root[i], None if i is None else root[i] == i) for i, *_ in rows), key=str)


def found(spark, rows, kind=KIND, **kw):
    df = spark.createDataFrame(rows, kind)
    return sorted((tuple(r) for r in V.near_duplicates(df, **kw).collect()), key=str)


def made(seed, n):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x = rng.standard_normal(16)
        rows.append((len(rows), x.astype(np.float32).tolist(), int(i % 3)))
        for _ in range(rng.integers(0, 4)):
            y = x + rng.standard_normal(16) * rng.choice([0, 0.05, 0.1, 0.2])
            rows.append((len(rows), y.astype(np.float32).tolist(), int(i % 3 if rng.random() < 0.8 else 1)))
    return rows


def test_against_brute_force_and_odd_rows(spark):
    rows = made(1, 150)
    copy = rows[10][1]
    n = len(rows)
    rows += [(n + i, copy, rows[10][2]) for i in range(40)]
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [], 1), (n + 2, [0.0] * 16, 1), (n + 3, [float("nan")] * 16, 1), (n + 4, [float("inf")] + [1.0] * 15, 1),
             (n + 5, [None] + [1.0] * 15, 1), (n + 6, copy, None), (n + 7, copy[:8], rows[10][2]), (None, copy, rows[10][2])]
    want = brute(rows)
    assert found(spark, rows) == want


def test_small_windows_find_components_and_no_false_link(spark):
    rows = made(2, 200)
    want = {r[0]: r for r in brute(rows)}
    got = found(spark, rows, window=8)
    assert all(r[1] <= want[r[0]][1] for r in got)
    assert sum(r[1] for r in got) >= 0.95 * sum(r[1] for r in want.values())


def test_empty_and_extra_columns(spark):
    assert found(spark, []) == []
    rows = [(1, [1.0, 2.0], "x", 1, 9), (2, [1.0, 2.0], "x", 2, 9), (3, [1.0, 2.0], "y", 3, 9)]
    assert found(spark, rows, "vec_id long, embedding array<double>, label string, rep int, pass int") == \
        [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def group_and_others(seed, n, others):
    """A group of near vectors, larger than the windows of all passes reach, among others; and the links of each."""
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.standard_normal(64) + 0.13 * rng.standard_normal((n, 64)), rng.standard_normal((others, 64))]).astype(np.float32)
    y = x.astype(np.float64)
    y /= np.sqrt((y * y).sum(1))[:, None]
    return [(i, v.tolist(), 1) for i, v in enumerate(x)], ((y @ y.T >= 0.98).sum(1) - 1).tolist()


def test_group_larger_than_the_windows_has_all_its_links(spark):
    rows, want = group_and_others(5, 3000, 500)
    assert min(want[:3000]) > 0
    got = found(spark, rows)
    assert sorted((i, n) for i, n, _, _ in got) == list(enumerate(want))
    assert {c for i, _, c, _ in got if i < 3000} == {0}


def test_windows_reach_over_many_short_ranges(spark, monkeypatch):
    """Ranges of a few rows (forced here; else the class count sets them): the windows give the same pairs as one range does."""
    rows = made(3, 120)
    monkeypatch.setattr(V, "linked_to", lambda classes, roots, scratch, kind, cosine: links(scratch))

    def links(scratch):
        return spark.createDataFrame([], "rep long, others long")

    def pairs(ranges):
        taken = []
        monkeypatch.setattr(V, "ranges_for", lambda rows, window, most: ranges)
        monkeypatch.setattr(V, "_forest", lambda a, b: (a, b))
        monkeypatch.setattr(V, "components", lambda df, scratch: taken.append({(min(r), max(r)) for r in df.collect()}) or real(df, scratch))
        found(spark, rows, window=40, passes=2)
        return taken[0]

    real = V.components
    one = pairs(1)
    assert one and pairs(90) == one


def test_range_count_follows_the_rows():
    assert V.ranges_for(24_000, 256, 4000) == 11 and V.ranges_for(10**9, 256, 4000) == 4000 and V.ranges_for(0, 256, 8) == 1


def test_edges_reach_as_far_as_the_window():
    assert V._reached({0: 3, 2: 1, 3: 2, 7: 3}, 3) == [(2, 0, 0), (3, 0, 1), (3, 2, 0), (7, 2, 2), (7, 3, 0)]
    assert V._reached({5: 2}, 3) == []
