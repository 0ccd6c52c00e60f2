"""Language identification: held-out accuracy and odd rows."""

import zlib

from areacube.llm import language_id as L

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = L.identify(docs).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    assert len(out) == docs.count()
    assert (out.held_out == out.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 5 == 0)).all()
    test = out[out.held_out]
    assert (test.lang_pred == test.lang).mean() >= 0.98
    assert out.score.between(0, 1).all() and out.rejected.mean() < 0.005


def test_odd_rows(spark):
    words = {"aa": "the of and to in", "bb": "der die und das ist"}
    rows = [(i, " ".join(words[k].split()[(i + j) % 5] for j in range(12)), k, 1) for i in range(60) for k in words]
    odd = [(1000, None, "aa", 1), (1001, "", None, 1), (1002, "12 34 !", "bb", 1), (1003, "これは日本語で書かれた文です。" * 4, None, 1), (1004, "the " * 40000, None, 1),
           (1005, "a", None, 1), (None, "das ist die", None, 1), (7, "THE OF AND", "aa", 1), (7, "THE OF AND", "aa", 1)]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score int")
    got = {r.doc_id: r for r in L.identify(df).collect()}
    assert L.identify(df).count() == len(rows + odd)
    for d in (1000, 1001, 1002):
        assert (got[d].lang_pred, got[d].score, got[d].rejected) == ("und", 0.0, True)
    assert got[1003].lang_pred in words and got[1003].rejected
    assert got[1004].lang_pred == "aa" and not got[1004].rejected
    assert got[1005].lang_pred in words and got[None].lang_pred == "bb" and got[None].held_out is False
    kept = L.accepted(df)
    assert kept.columns == df.columns
    assert {1000, 1001, 1002, 1003}.isdisjoint(r.doc_id for r in kept.collect())


def test_nothing_to_learn_from(spark):
    kind = "doc_id long, text string, lang string"
    assert L.identify(spark.createDataFrame([], kind)).collect() == []
    got = L.identify(spark.createDataFrame([(1, "abc def", None)], kind)).collect()
    assert [(r.lang_pred, r.score, r.rejected) for r in got] == [("und", 0.0, True)]


def test_every_label_is_learned(spark):
    """More labels than any fixed number of them; the last ones are the rarest."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda k, j: letters[k % 26] + letters[k // 26] + letters[(7 * k + j) % 26] + letters[(3 * j + k) % 26]
    rows = [(1000 * k + i, " ".join(word(k, (i + j) % 9) for j in range(30)), f"l{k:02d}") for k in range(90) for i in range(6 if k >= 60 else 12)]
    out = L.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).toPandas()
    label = {d: lang for d, _, lang in rows}
    seen = out[~out.held_out]
    assert set(seen.lang_pred) == set(label.values())
    assert (seen.lang_pred == seen.doc_id.map(label)).mean() > 0.99
