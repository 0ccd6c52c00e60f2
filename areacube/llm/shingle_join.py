"""N-gram Jaccard join: documents whose sets of 4-word shingles overlap.

Two documents link when 100 * |A and B| >= 85 * |A or B|.  The result has
each document's component under these links.

Candidates (exact).  If J(A, B) >= 0.85 then A and B differ in at most
D = floor(3 n / 17) shingles, n = |A| or |B|.  Shingles are dealt into K
parts by hash, the same K for all sizes of a band (a set close below a band
edge is dealt in both).  Each differing shingle spoils one part, so among the
first D + 1 non-empty parts of either set one is identical: a set sends one
signature for each of those parts, and linked sets share one.  K is little
above D + 1, so a signature stands for some five shingles at once and
documents that merely share a passage seldom meet.  The most frequent
shingles (a list of bounded size) are left out of the parts; the other ones
are called cold.  The argument holds while D + 1 parts remain.  A set with
fewer sends its first D + 1 single cold shingles.  If it has at most D of
them, it can link with such a set without a common cold one; then all
cold shingles of both (c and d) differ, c + d <= D, and at most D - c of the
frequent ones do: it also sends the first D - c + 1 parts of its frequent
shingles, or, where these are too few, those among the first
floor(3 n / 20) + 1 shingles of a fixed order, the plain prefix filter.
In a group of frequent shingles, pairs whose cold shingles are
too many to link are not compared.

Search.  Sets that share a signature are compared with the leader (fewest cold
shingles) of that signature's group, so a group of thousands of copies costs one pair per
copy.  For each leader, T-occurrence search over its partners' inverted
lists: the short lists are merged by a heap, the long ones probed by binary
search (DivideSkip), and partners that reach the required overlap are kept.
First each set meets its lightest leader only; pairs that are of one component
by then need no search, and pairs that set sizes or coarse histograms rule out
do not get one either.  Signature groups that are not one component by then
are compared again, a bounded number of leaders a round, until no pair of
different components is left uncompared.  Nothing is capped.

Equal sets share one node from the start.  Cases: null text or text without
words: set size 0, linked with nothing, own component.  Repeated ids: rows of
one id give one row each.  A null id: links through the other rows of its set
only, and keeps a null component if it is alone.  Extra columns are ignored.  Empty table: empty.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, lists_of, short_batches, slices
from .components import components, stars
from .words import U, Words, mixed

WIDTH = 4
#: Similarity as a fraction: intersection / union >= 85 / 100.
NEED, OF = 85, 100
#: A shingle in about so many texts is left out of the parts, and so many shingles at most.
HOT_TEXTS, HOT_LIST = 48, 1 << 20
#: Leaders that the first later round compares with the rest of a signature group, and their growth from round to round.
LEADERS, LEADERS_GROW = 64, 4
#: Texts without a candidate are left out of the second reading by a table of
#: so many hash values of ids (its bound); those that slip through go at the join.
SLOTS = 1 << 20
#: Hash ranges of the histograms that rule out pairs before their sets are sent.
BINS = 512
#: Shingles counted together before the frequent ones are sent.
COUNT_SLICE = 1 << 18


def shingle_sets(w: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts' shingle sets one after the other, each sorted, and their sizes."""
    h = w.hashes(lower=True)
    _, text, found = w.windows(width, h)
    have = w.counts()
    short = np.flatnonzero((have > 0) & (have < width))
    if len(short):                     # the whole sequence is the one shingle
        whole = np.array([_sequence(h[w.first[i]: w.first[i + 1]]) for i in short], U)
        text = np.concatenate([text, short])
        found = np.concatenate([found, whole])
        order = np.argsort(text, kind="stable")
        text, found = text[order], found[order]
    end = np.cumsum(np.bincount(text, minlength=len(have)))
    lo = 0
    for hi in end.tolist():                # many short sorts are faster than one by two keys
        found[lo:hi].sort()
        lo = hi
    if len(found):
        new = np.concatenate(([True], (text[1:] != text[:-1]) | (found[1:] != found[:-1])))
        text, found = text[new], found[new]
    return found, np.bincount(text, minlength=len(have))


def _sequence(hashes: np.ndarray) -> np.uint64:
    x = np.array([len(hashes)], U)
    for h in hashes:
        x = mixed(x * U(0x2545F4914F6CDD1D) + h)
    return x[0]


def _nodes(found: np.ndarray, n: np.ndarray) -> np.ndarray:
    """One hash per whole set."""
    total = np.concatenate((np.zeros(1, U), np.cumsum(mixed(found + U(0x632BE59BD9B4E019)))))
    end = np.cumsum(n)
    return mixed((total[end] - total[end - n]) ^ n.astype(U)).view(np.int64)


# ---- the most frequent shingles -----------------------------------------

def _frequent(width: int):
    """Shingles met at least twice among some thousand texts, with their number."""
    def send(parts: list):
        value, count = np.unique(np.concatenate(parts), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(value[count > 1].view(np.int64)), pa.array(count[count > 1])], ["shingle", "n"])

    def run(batches):
        parts, size = [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                found, _ = shingle_sets(Words(part.column("text")), width)
                parts.append(found)
                size += len(found)
                if size >= COUNT_SLICE:
                    yield send(parts)
                    parts, size = [], 0
        if parts:
            yield send(parts)
    return run


def frequent_shingles(docs: DataFrame, width: int, least: int, scratch: Scratch) -> np.ndarray:
    """The most frequent shingles, sorted: those in about ``least`` texts or
    more, and at most ``HOT_LIST`` of them (the bound of what is sent to every
    task; beyond it the least number rises).

    Only the speed depends on this list, no result does.
    """
    counted = scratch.written(docs.select("text").mapInArrow(_frequent(width), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
                              .where(F.col("n") >= least), "frequent")
    step = F.floor(4 * F.log2("n"))
    total, limit = 0, 4 * 64
    for r in counted.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():     # at most 4 * 64 rows
        total += r["count"]
        if total > HOT_LIST:
            break
        limit = r["step"]
    found = counted.where(step >= limit).select("shingle").toPandas()["shingle"]
    return np.sort(found.to_numpy(dtype=np.int64).view(U))


# ---- signatures ----------------------------------------------------------

def allowed(n):
    """The most shingles in which a linked set may differ from one of n shingles."""
    return n * (OF - NEED) // NEED


#: Sizes at which the bands of set sizes begin, two an octave, and the parts
#: of each band: a tenth more than the largest set of the band needs.
BANDS = np.unique(np.ceil(2.0 ** (np.arange(80) / 2)).astype(np.int64))
PARTS = np.maximum(1, (allowed(BANDS[1:] - 1) + 1) * 11 // 10)


def _part_signatures(value, text, n, most, band, salt) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts dealt at ``band`` (None: each shingle is a part): (text, signature) of the first ``most`` + 1 non-empty parts, and the number of parts per text."""
    if not len(text):
        return text, value, np.zeros(len(n), np.int64)
    part = value if band is None else (value >> U(32)) * PARTS[band].astype(U)[text] >> U(32)         # in order, as each set is sorted
    new = np.concatenate(([True], (text[1:] != text[:-1]) | (part[1:] != part[:-1])))
    at = np.flatnonzero(new)
    content = np.add.reduceat(mixed(value ^ U(0x14057B7EF767814F)), at)
    size = np.diff(np.concatenate((at, [len(text)]))).astype(U)
    text, part = text[at], part[at]
    dealt = U(0) if band is None else band[text].astype(U)
    sig = mixed(content ^ mixed(part * U(0x9E3779B97F4A7C15) + size * U(131) + dealt + U(salt << 60)))
    have = np.bincount(text, minlength=len(n))
    rank = np.arange(len(text)) - np.repeat(np.cumsum(have) - have, have)
    first = rank <= most[text]
    return text[first], sig[first], have


def signatures(found: np.ndarray, n: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, signature) rows of texts with set sizes ``n``, and how many of
    each text's shingles are not frequent.  The last bit of a signature tells
    whether it is one of frequent shingles."""
    text = np.repeat(np.arange(len(n)), n)
    cold = hot[np.minimum(np.searchsorted(hot, found), len(hot) - 1)] != found if len(hot) else np.ones(len(found), bool)
    n_cold = np.bincount(text[cold], minlength=len(n))
    band = np.maximum(np.searchsorted(BANDS, n, side="right") - 1, 0)
    edge = (n > 0) & (n * OF >= NEED * BANDS[band + 1])            # a partner may be in the next band
    rows: list = []

    def send(texts, sigs, frequent):
        rows.append((texts, sigs & ~U(1) | U(frequent)))

    def dealt(use, most, salt, frequent):
        """Sends the parts of the shingles in use; which texts have too few."""
        own = _part_signatures(found[use], text[use], n, most, band, salt)
        up = use & edge[text]
        more = _part_signatures(found[up], text[up], n, most, band + 1, salt)
        send(*own[:2], frequent)
        send(*more[:2], frequent)
        return (n > 0) & ((own[2] <= most) | (edge & (more[2] <= most)))

    most = allowed(n)
    weak = dealt(cold, most, 0, False)
    if weak.any():
        use = weak[text] & cold
        send(*_part_signatures(found[use], text[use], n, most, None, 1)[:2], False)
        weak &= n_cold <= most
    if weak.any():                                                 # may link without a common cold shingle
        weak &= dealt(weak[text] & ~cold, most - n_cold, 2, True)
    if weak.any():                                                 # too few parts: single shingles
        of = np.flatnonzero(weak[text])
        order = of[np.lexsort((mixed(found[of]), ~cold[of], text[of]))]
        number = n[weak]
        rank = np.arange(len(order)) - np.repeat(np.cumsum(number) - number, number)
        order = order[rank <= (n * (OF - NEED) // OF)[text[order]]]
        order = order[~cold[order]]
        send(text[order], mixed(found[order] ^ U(0xA3EC647659359ACD)), True)
    texts = np.concatenate([r[0] for r in rows])
    order = np.argsort(texts, kind="stable")
    return texts[order], np.concatenate([r[1] for r in rows])[order], n_cold


def _described(width: int, hot: np.ndarray):
    """The columns but the text, set size, node (hash of the whole set), weight
    (2^32 x cold shingles + set size), signatures (of the first text of a set that a task meets)."""
    def run(batches):
        met: set[int] = set()
        for batch in batches:
            for part in slices(batch, "text"):
                found, n = shingle_sets(Words(part.column("text")), width)
                node = _nodes(found, n)
                carried = [c for c in part.schema.names if c != "text"]
                first = np.zeros(len(n), bool)
                for i, x in enumerate(node.tolist()):
                    if x not in met:
                        met.add(x)
                        first[i] = True
                texts, sigs, n_cold = signatures(found, n, hot)
                texts, sigs = texts[first[texts]], sigs[first[texts]]
                yield pa.RecordBatch.from_arrays([
                    *[part.column(c) for c in carried], pa.array(n.astype(np.int64)),
                    pa.array(node, mask=n == 0), pa.array(n_cold.astype(np.int64) << 32 | n),
                    lists_of(sigs.view(np.int64), np.bincount(texts, minlength=len(n))),
                ], [*carried, "n", "node", "weight", "sigs"])
    return run


def histogram(shingles: np.ndarray) -> bytes:
    """How many shingles fall in each of ``BINS`` hash ranges (255: or more).
    Two sets differ in at least as many shingles as their histograms do."""
    return np.minimum(np.bincount((shingles >> U(64 - BINS.bit_length() + 1)).astype(np.int64), minlength=BINS), 255).astype(np.uint8).tobytes()


def _plausible(batches):
    """The pairs that neither their sizes nor their histograms rule out."""
    for batch in batches:
        n, m = batch.column("n").to_numpy(), batch.column("lead_n").to_numpy()
        a, b = (np.frombuffer(b"".join(x.as_buffer() for x in batch.column(c)), np.uint8).reshape(-1, BINS).astype(np.int16) for c in ("counts", "lead_counts"))
        keep = (np.abs(a - b).sum(1) <= allowed(np.minimum(n, m))) & (NEED * n <= OF * m) & (NEED * m <= OF * n)
        yield pa.RecordBatch.from_arrays([batch.column("lead").filter(pa.array(keep)), batch.column("node").filter(pa.array(keep))], ["lead", "node"])


def _sets(width: int):
    """node, set size, histogram and set as bytes, of the texts of nodes that have a candidate (another row of the same id is left out)."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                found, n = shingle_sets(Words(part.column("text")), width)
                end = np.cumsum(n)
                own = np.flatnonzero(part.column("node").to_numpy() == _nodes(found, n))
                sets = [found[end[i] - n[i]: end[i]] for i in own]
                yield pa.RecordBatch.from_arrays([
                    part.column("node").take(pa.array(own)), pa.array(n[own].astype(np.int64)), pa.array([histogram(x) for x in sets], pa.binary()),
                    pa.array([x.tobytes() for x in sets], pa.binary()),
                ], ["node", "n", "counts", "shingles"])
    return run


# ---- T-occurrence search -------------------------------------------------

def divide_skip(lists: list[np.ndarray], need: int, mu: float = 0.01) -> dict[int, int]:
    """Members that lie in at least ``need`` of the sorted inverted lists,
    with their number of lists.

    The longest lists (need / (mu * log2 longest + 1) of them, below ``need``)
    are set aside; the others are merged by a heap; members met at least
    need - aside times there are looked up in the long lists by binary search.
    """
    lists = sorted((x for x in lists if len(x)), key=len)
    if len(lists) < need:
        return {}
    longest = max(2, len(lists[-1]))
    aside = min(need - 1, int(need / (mu * np.log2(longest) + 1)))
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside:]
    found, last, run = {}, None, 0

    def settle(member, met):
        left = len(long)
        for x in long:
            if met + left < need:
                return
            left -= 1
            i = int(x.searchsorted(member))
            met += i < len(x) and x[i] == member
        if met >= need:
            found[member] = met

    for member in heapq.merge(*(x.tolist() for x in short)):
        if member != last:
            if last is not None and run >= need - aside:
                settle(last, run)
            last, run = member, 0
        run += 1
    if last is not None and run >= need - aside:
        settle(last, run)
    return found


def required(a: int, b: int) -> int:
    """The least intersection of linked sets of these sizes: 100 i >= 85 (a + b - i)."""
    return -(-NEED * (a + b) // (NEED + OF))


def linked_members(query: np.ndarray, members: list[np.ndarray]) -> list[int]:
    """Which member sets link with the query set: T-occurrence search over the members' inverted lists."""
    q = len(query)
    fit = [i for i, m in enumerate(members) if len(m) and NEED * len(m) <= OF * q and NEED * q <= OF * len(m)]
    if not fit:
        return []
    of = np.repeat(fit, [len(members[i]) for i in fit])
    value = np.concatenate([members[i] for i in fit])
    order = np.lexsort((of, value))
    value, of = value[order], of[order]
    lo, hi = np.searchsorted(value, query, "left"), np.searchsorted(value, query, "right")
    met = divide_skip([of[a:b] for a, b in zip(lo, hi)], min(required(q, len(members[i])) for i in fit))
    return [i for i, k in met.items() if k >= required(q, len(members[i]))]


def _verified(batches):
    """Rows sorted by leader -> the spanning stars of the links (leader, member) found; a run of rows of one leader is searched at once."""
    for batch in batches:
        lead, member = batch.column("lead").to_numpy(), batch.column("node").to_numpy()
        shingles, query = batch.column("shingles"), batch.column("query")
        cut = np.flatnonzero(np.concatenate(([True], lead[1:] != lead[:-1], [True]))) if len(lead) else [0]
        a, b = [], []
        for lo, hi in zip(cut[:-1], cut[1:]):
            for at in range(lo, hi, 256):
                own = range(at, min(hi, at + 256))
                q = np.frombuffer(query[at].as_buffer(), U)
                for i in linked_members(q, [np.frombuffer(shingles[k].as_buffer(), U) for k in own]):
                    a.append(lead[at])
                    b.append(member[at + i])
        if a:
            yield stars(np.array(a, np.int64), np.array(b, np.int64))


def _links(pairs: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """Links (node, low) with the components of the pairs (lead, node) that link."""
    counts = sets.select("node", "n", "counts")
    of_lead = counts.select(F.col("node").alias("lead"), F.col("n").alias("lead_n"), F.col("counts").alias("lead_counts"))
    pairs = scratch.written(pairs.join(counts, "node").join(of_lead, "lead").mapInArrow(_plausible, "lead long, node long"), "pairs")
    leaders = (sets.join(pairs.select(F.col("lead").alias("node")).distinct(), "node", "left_semi")
               .select(F.col("node").alias("lead"), F.col("shingles").alias("query")))
    return (pairs.join(sets.select("node", "shingles"), "node").join(leaders, "lead").select("lead", "node", "shingles", "query")
            .sortWithinPartitions("lead").mapInArrow(_verified, "node long, low long"))


def _joined(roots: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """The components with more links."""
    links = scratch.written(links, "links")
    return roots if links.isEmpty() else components(links.unionByName(roots.select("node", F.col("root").alias("low"))), scratch)


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (lead, node) whose ends are in different components so far."""
    of_lead = roots.select(F.col("node").alias("lead"), F.col("root").alias("lead_root"))
    return (pairs.join(roots, "node", "left").join(of_lead, "lead", "left")
            .where(F.coalesce("root", "node") != F.coalesce("lead_root", "lead")).select("lead", "node"))


def _cold(weight):
    return F.shiftright(weight, 32)


def _size(weight):
    return F.col(weight).bitwiseAND(F.lit(0xFFFFFFFF))


def _frequent_sig():
    return F.col("sig").bitwiseAND(F.lit(1)) == 1


def _may_link():
    """Whether a set and a leader of its group may link, by their sizes; in a
    group of frequent shingles their cold shingles all differ (pairs with a
    common one meet in another group)."""
    a, b = _size("weight"), _size("lead_weight")
    cold_a, cold_b = _cold("weight"), _cold("lead_weight")
    differ = F.when(_frequent_sig(), cold_a + cold_b + F.abs(a - cold_a - b + cold_b)).otherwise(F.abs(a - b))
    return differ * (NEED + OF) <= (a + b) * (OF - NEED)


def _open(rest: DataFrame) -> DataFrame:
    """The rows (sig, node, weight, root) of groups of more than one component;
    in groups of frequent shingles only those sets that may link with the one
    of fewest cold shingles of another component."""
    light = rest.groupBy("sig", "root").agg(F.min(_cold("weight")).alias("light"))
    best = light.groupBy("sig").agg(F.min(F.struct("light", "root")).alias("best")).select("sig", F.col("best.light").alias("lightest"), F.col("best.root").alias("its_root"))
    other = light.join(best, "sig").where("root != its_root").groupBy("sig", "lightest", "its_root").agg(F.min("light").alias("other"))
    partner = F.when(F.col("root") == F.col("its_root"), F.col("other")).otherwise(F.col("lightest"))
    fits = (_cold("weight") + partner) * NEED <= _size("weight") * (OF - NEED)
    return rest.join(other, "sig").where(~_frequent_sig() | fits).select("sig", "node", "weight", "root")


def text_hash():
    return F.xxhash64("text").alias("text_hash")


def link_components(docs: DataFrame, width: int = WIDTH, hot_texts: int = HOT_TEXTS, by_text: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs(doc_id, text)``.

    With ``by_text`` also text_hash and node (the set; null if it is empty), which tell rows of one id apart."""
    docs = short_batches(docs).select("doc_id", "text", *([text_hash()] if by_text else []))
    scratch = Scratch(docs.sparkSession, "shingle-join")
    hot = frequent_shingles(docs, width, hot_texts, scratch)
    kind = f"doc_id long, {'text_hash long, ' if by_text else ''}n long, node long, weight long, sigs array<long>"
    described = scratch.written(docs.mapInArrow(_described(width, hot), kind), "described")

    rows = described.where("node is not null").select("node", "weight", F.explode("sigs").alias("sig"))
    several = rows.groupBy("sig").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.min("weight").alias("least")).where("lo < hi").select("sig", "least")
    groups = scratch.written(rows.join(several, "sig").distinct(), "groups")
    lead = (groups.where("weight = least").groupBy("sig", F.col("weight").alias("lead_weight")).agg(F.min("node").alias("lead")))
    rest = groups.select("sig", "node", "weight")
    pairs = rest.join(lead, "sig").where("node != lead").where(_may_link()).select("lead", "lead_weight", "node").distinct()

    who = described.join(groups.select("node").distinct(), "node").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS))
    slots = who.select(slot.alias("slot")).distinct()                    # at most SLOTS rows
    few = docs.join(F.broadcast(slots), slot == F.col("slot"), "left_semi")
    sets = scratch.written(few.join(who, "doc_id").select("node", "text").mapInArrow(_sets(width), "node long, n long, counts binary, shingles binary"), "sets")
    # every set with its lightest leader first: most other pairs are of one component then
    first = pairs.groupBy("node").agg(F.min(F.struct("lead_weight", "lead")).alias("first")).select("node", "first.lead")
    roots = components(_links(first.select("lead", "node"), sets, scratch), scratch)
    others = pairs.select("lead", "node").join(first, ["node", "lead"], "left_anti")
    roots = _joined(roots, _links(_apart(others, roots), sets, scratch), scratch)
    rest = rest.join(lead, "sig").where("node != lead").select("sig", "node", "weight")          # compared with their leader
    leading = LEADERS
    while True:
        rest = rest.join(roots, "node", "left").select("sig", "node", "weight", F.coalesce("root", "node").alias("root"))
        rest = scratch.written(_open(rest), "apart")
        if rest.isEmpty():
            break
        # sets of the group's small components lead: the largest one needs none once they are through
        order = F.struct("many", "weight", "node")
        ranked = rest.join(rest.groupBy("sig", "root").agg(F.count("*").alias("many")), ["sig", "root"])
        rank = F.row_number().over(Window.partitionBy("sig").orderBy("many", "weight", "node"))
        lead = scratch.written(ranked.withColumn("rank", rank).where(F.col("rank") <= leading)
                               .select("sig", F.col("node").alias("lead"), F.col("weight").alias("lead_weight"), F.col("root").alias("lead_root"), order.alias("lead_order")), "leaders")
        pairs = ranked.join(lead, "sig").where(order > F.col("lead_order")).where("root != lead_root").where(_may_link()).select("lead", "node").distinct()
        roots = _joined(roots, _links(pairs, sets, scratch), scratch)
        last = lead.groupBy("sig").agg(F.max("lead_order").alias("last"))
        rest = ranked.join(last, "sig").where(order > F.col("last")).select("sig", "node", "weight")
        leading *= LEADERS_GROW                   # rounds follow the logarithm of a group's size
    return scratch.result(_named(described, roots))


def _named(described: DataFrame, roots: DataFrame) -> DataFrame:
    """Each row's component: the least id of all rows of its component's nodes."""
    least = described.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    least = least.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "least")
    named = least.groupBy("root").agg(F.min("least").alias("component_id"))
    of_node = least.join(named, "root").select("node", "component_id")
    return (described.join(of_node, "node", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
                    *[c for c in ("text_hash", "node") if "text_hash" in described.columns]))
