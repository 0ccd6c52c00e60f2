"""Quality rules: a learned decision list over text statistics.

Statistics of whole texts are computed in one pass.  Sequential covering then
learns an ordered list of threshold conjunctions that mark bad texts, from a
bounded sample of labelled rows: a rule is grown by FOIL gain on two thirds
of the rows left, pruned from its end on the other third, and accepted if it
is right for at least ``PRECISION`` of those it marks there; the rows it marks
are removed and the next rule is grown.  The list is emitted as one
Spark ``when`` chain, so it can be read, logged and edited.

Cases.  Null or empty text: no words, fails the base rule.  No labelled
rows, or no acceptable rule: every text that passes the base rule is kept.
Labels of unknown ids and null labels are ignored; an id with several labels
counts with each.  Repeated ids and extra columns: one row each, others are ignored.
"""

from __future__ import annotations

import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, short_batches, slices, worker_state
from .words import BYTE_BASE, Words, covered, mixed, prefix_hashes, _tables, U

WINDOW = 8
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
#: Labelled rows learned from.
SAMPLE = 20_000
PRECISION = 0.98
MIN_COVER = 5
MAX_CONDITIONS = 4
THRESHOLDS = 48
SEED = 5

STATS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_capitals long"


def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[at])


def _runs(text: np.ndarray, value: np.ndarray) -> np.ndarray:
    """For each (text, value): how often it occurs."""
    order = np.argsort(value ^ mixed(text.astype(U)), kind="stable")
    key = value[order] ^ mixed(text[order].astype(U))
    new = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
    count = np.diff(np.concatenate((np.flatnonzero(new), [len(key)])))
    out = np.empty(len(key), np.int64)
    out[order] = np.repeat(count, count)
    return out


def statistics(w: Words) -> list[np.ndarray]:
    """Per text: words, code points in words, symbols, repeated lines, words in repeated windows, lines with words, capitals."""
    tables = worker_state("word-tables", _tables, "word hashes")
    mark = worker_state("symbol-table", lambda: np.isin(np.arange(256), list(SYMBOLS.encode())), "word hashes")
    n_words = w.counts()
    word_chars = _per_text(~tables["space"][w.buf] & (w.buf & 0xC0 != 0x80), w.at)
    symbols = _per_text(mark[w.buf], w.at)
    capitals = _per_text((w.buf >= 65) & (w.buf <= 90), w.at)

    breaks = np.flatnonzero(w.buf == 10)
    starts = np.unique(np.concatenate((w.at[:-1], breaks + 1)))
    starts = starts[starts < len(w.buf)]
    ends = np.minimum(np.concatenate((starts[1:], [len(w.buf)])), len(w.buf)) if len(starts) else starts
    ends = ends - ((ends > starts) & (w.buf[np.maximum(ends - 1, 0)] == 10)) if len(starts) else ends
    text = np.searchsorted(w.at, starts, "right") - 1
    worded = np.searchsorted(w.start, ends) > np.searchsorted(w.start, starts)
    starts, ends, text = starts[worded], ends[worded], text[worded]
    sums, down = prefix_hashes(tables["values"][w.buf], BYTE_BASE)
    line = mixed(((sums[ends] - sums[starts]) * down[starts]) ^ (ends - starts).astype(U))
    n_lines = np.bincount(text, minlength=len(n_words))
    pairs = np.unique(np.stack([text.astype(U), line]), axis=1) if len(text) else np.zeros((2, 0), U)
    dup_lines = n_lines - np.bincount(pairs[0].astype(np.int64), minlength=len(n_words))

    at, of, h = w.windows(WINDOW, w.hashes())
    repeat = _per_text(covered(at[_runs(of, h) > 1], WINDOW, len(w.start)), w.first)
    return [n_words, word_chars, symbols, dup_lines, repeat, n_lines, capitals]


def _stats(batches):
    names = [c.split()[0] for c in STATS.split(", ")]
    for batch in batches:
        for part in slices(batch, "text"):
            found = statistics(Words(part.column("text")))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(x.astype(np.int64)) for x in found)], names)


def text_statistics(docs: DataFrame) -> DataFrame:
    return short_batches(docs).select("doc_id", "text").mapInArrow(_stats, STATS)


def features() -> dict[str, Column]:
    """What rules may test: shares, so that they mean the same for short and long texts."""
    words = F.greatest("n_words", F.lit(1))
    return {
        "mean_word": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "dup_line_share": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / words,
        "capitals_per_char": F.col("n_capitals") / F.greatest("word_chars", F.lit(1)),
        "n_words": F.col("n_words").cast("double"),
    }


# ---- learning ------------------------------------------------------------

OPS = {">=": operator.ge, "<=": operator.le}
Condition = tuple[str, str, float]


def _marked(rule: list[Condition], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    hit = np.ones(n, bool)
    for name, op, limit in rule:
        hit &= OPS[op](x[name], limit)
    return hit


def _grown(x: dict[str, np.ndarray], bad: np.ndarray, not_first: set[tuple[str, str]]) -> list[Condition]:
    """Conditions added one by one by FOIL gain until only bad rows are marked."""
    rule: list[Condition] = []
    hit = np.ones(len(bad), bool)
    while len(rule) < MAX_CONDITIONS and hit.any() and not bad[hit].all():
        p, n = bad[hit].sum(), (~bad[hit]).sum()
        best, step = 0.0, None
        for name, v in x.items():
            for limit in np.unique(np.quantile(v[hit], np.linspace(0, 1, THRESHOLDS), method="inverted_cdf")):
                for op, test in OPS.items():
                    if not rule and (name, op) in not_first:
                        continue
                    now = hit & test(v, limit)
                    p1, n1 = bad[now].sum(), (~bad[now]).sum()
                    if p1 and p1 + n1 < p + n:
                        gain = p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p / (p + n)))
                        if gain > best:
                            best, step = gain, (name, op, float(limit))
        if step is None:
            break
        rule.append(step)
        hit &= OPS[step[1]](x[step[0]], step[2])
    return rule


def _pruned(rule: list[Condition], x: dict[str, np.ndarray], bad: np.ndarray) -> tuple[list[Condition], int, int]:
    """The start of the rule with the best (p - n) / (p + n) on other rows (the longer one on a tie), and its p and n."""
    best, found = -2.0, (rule, 0, 0)
    for k in range(len(rule), 0, -1):
        hit = _marked(rule[:k], x, len(bad))
        p, n = int(bad[hit].sum()), int((~bad[hit]).sum())
        value = (p - n) / (p + n) if p + n else -1.0
        if value > best:
            best, found = value, (rule[:k], p, n)
    return found


def learn(x: dict[str, np.ndarray], bad: np.ndarray, seed: int = SEED) -> list[list[Condition]]:
    """Ordered rules that mark bad rows.

    After a rule that is not accepted, the next one starts with another test;
    the list ends when every start has been refused.
    """
    rules: list[list[Condition]] = []
    rng = np.random.default_rng(seed)
    left = np.ones(len(bad), bool)
    refused: set[tuple[str, str]] = set()
    while bad[left].sum() >= MIN_COVER:
        own = np.flatnonzero(left)
        grow = np.zeros(len(bad), bool)
        grow[rng.permutation(own)[: 2 * len(own) // 3]] = True
        prune = left & ~grow
        rule = _grown({k: v[grow] for k, v in x.items()}, bad[grow], refused)
        if not rule:
            break
        start = rule[0][:2]
        rule, p, n = _pruned(rule, {k: v[prune] for k, v in x.items()}, bad[prune])
        hit = left & _marked(rule, x, len(bad))
        if p < MIN_COVER or p < PRECISION * (p + n) or bad[hit].sum() < PRECISION * hit.sum():
            refused.add(start)
            continue
        refused.clear()
        rules.append(rule)
        left &= ~hit
    return rules


def learned_rules(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[list[Condition]]:
    """Rules from at most ``sample`` labelled rows, chosen by a hash of the id."""
    known = labels.where(F.col("quality").isNotNull()).select(F.col("doc_id").alias("id_"), "quality")
    rows = (stats.join(known, F.col("doc_id") == F.col("id_")).select("doc_id", "quality", *[c.alias(f"x_{k}") for k, c in features().items()])
            .orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "x_n_words", "x_mean_word").limit(sample).toPandas())
    return learn({k: rows[f"x_{k}"].to_numpy(float) for k in features()}, rows["quality"].to_numpy(int) == 0)


def readable(rule: list[Condition]) -> str:
    return " and ".join(f"{name} {op} {limit:.6g}" for name, op, limit in rule)


def verdict(rules: list[list[Condition]]) -> Column:
    """The first rule that marks a text, as text; null if none does."""
    known, chain = features(), F.when(F.lit(False), F.lit(""))
    for rule in rules:
        hit = F.lit(True)
        for name, op, limit in rule:
            hit = hit & OPS[op](known[name], F.lit(limit))
        chain = chain.when(hit, F.lit(readable(rule)))
    return chain


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the statistics, base_failed, kept and the rule that decided, for every row of ``docs(doc_id, text)``."""
    stats = Scratch(docs.sparkSession, "quality").written(text_statistics(docs), "statistics")
    rule = verdict(learned_rules(stats, labels))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        failed.alias("base_failed"), (~failed & rule.isNull()).alias("kept"), F.when(~failed, rule).alias("rule"))
