"""Near-duplicate vectors by sorted projection passes.

Each pass draws random hyperplanes and orders the vectors of a label
lexicographically by their concatenated sign bits; near vectors agree in many
leading bits and so stand close together.  Every vector is compared with its
``window`` followers by cosine in double precision.  The verified pairs of all
passes give the components; then all vectors of one component are compared
with each other, so a group larger than the windows has all its links counted.

Recall.  The links within a component are exact.  Approximate is which groups
become one component: two of them stay apart if no pair between them stands in
a window.  A pair at cosine 0.98 agrees in one bit with probability 0.94; to
stand in one window of 256 among n random vectors of a label it must agree in
about log2(n / 256) leading bits.  With 12 passes the chance to miss it is
below 1e-5 at 17,000 vectors a label and 2 % at 10**8; it is higher where many
vectors that do not link crowd around the pair.  Measured figures: README.

Plan.  Equal vectors of a label are one class before the passes, so copies
cost nothing.  All passes are sorted by one range exchange on (pass, label,
bits); a hot label is spread over as many ranges as its rows need, and a range
holds several windows unless the sampled bounds are uneven.  Windows that reach
over a range's end are compared in a second, small step: the last rows of a
range meet the rows that follow it, from as many ranges as a window needs.  A task sends spanning stars of its pairs, not the pairs.
Large components are dealt into salted blocks, and every two blocks of one meet
in a task of their own, which sends a sum per vector.  The comparisons of one
component grow with the square of its size; nothing is left out.

Cases.  Null label, null or empty vector, zero vector, null or non-finite
components: the vector links with nothing (n_links 0, own component).
Vectors of different lengths link with nothing.  Repeated ids: rows of one id count
as one vector when it comes to the component, each row is returned.  Extra columns are
ignored.  Empty table: empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, partitions
from .components import _forest, components

COSINE = 0.98
PASSES = 12
WINDOW = 256
BITS = 62
SEED = 20240501
#: Rows compared with their followers in one matrix product.
STEP = 256
#: Windows that a range of sorted rows holds at least, by the count of rows.
WINDOWS = 8
#: Rows and bytes (in double precision) of a block of a large component, and blocks it has before they grow.
BLOCK, BLOCK_BYTES, BLOCKS = 256, 8 << 20, 32
#: Rows of small components that meet in one task call.
TOGETHER = 2048


def _planes(passes: int, dims: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dims]).standard_normal((dims, passes * BITS))


def _keyed(passes: int, seed: int, kind: str):
    """One row per pass: its sign bits as one integer."""
    weights = (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))

    def run(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                vectors = part.column("embedding")
                sizes = vectors.value_lengths().to_numpy()
                for dims in np.unique(sizes).tolist():
                    own = part.filter(pa.array(sizes == dims))
                    x = own.column("embedding").flatten().to_numpy().reshape(-1, dims)
                    if dims not in planes:
                        planes[dims] = _planes(passes, dims, seed)
                    bits = (x.astype(np.float64) @ planes[dims] > 0).reshape(len(x), passes, BITS)
                    key = (bits * weights).sum(2)
                    raw = [v.tobytes() for v in x.astype(kind)]
                    for k in range(passes):
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(len(x), k, np.int32)), own.column("label"), pa.array(np.full(len(x), dims, np.int32)),
                            pa.array(key[:, k]), own.column("rep"), pa.array(raw, pa.binary()),
                        ], ["pass", "label", "dims", "key", "rep", "vector"])
    return run


def _unit(vectors: list, dims: int) -> np.ndarray:
    """Vectors (bytes of 4- or 8-byte floats) at length 1, in double precision."""
    x = np.frombuffer(b"".join(vectors), f"<f{len(vectors[0]) // dims}").reshape(-1, dims).astype(np.float64)
    x = x / np.abs(x).max(1)[:, None]
    return x / np.sqrt((x * x).sum(1))[:, None]


def near(x: np.ndarray, rep: np.ndarray, window: int, cosine: float, first_side: int | None = None):
    """Pairs (a, b) of rows at most ``window`` apart with at least this cosine.

    With ``first_side``: only pairs with one row before that position and one from it on."""
    a, b = [], []
    for lo in range(0, len(x) if first_side is None else first_side, STEP):
        hi = min(lo + STEP, len(x))
        stop = min(hi + window, len(x))
        like = x[lo:hi] @ x[lo:stop].T
        i, j = np.nonzero(like >= cosine - 1e-9)
        keep = (j > i) & (j - i <= window)
        if first_side is not None:
            keep &= (i + lo < first_side) & (j + lo >= first_side)
        i, j = i[keep] + lo, j[keep] + lo
        exact = np.einsum("ij,ij->i", x[i], x[j]) >= cosine
        a.append(rep[i[exact]])
        b.append(rep[j[exact]])
    return (np.concatenate(a), np.concatenate(b)) if a else (rep[:0], rep[:0])


OUT = "a long, b long, edge long, side int, place int, pass int, label string, dims int, vector binary"


def _pairs_batch(a, b):
    n = len(a)
    none = pa.nulls
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), none(n, pa.int64()), none(n, pa.int32()),
                                       none(n, pa.int32()), none(n, pa.int32()), none(n, pa.string()), none(n, pa.int32()), none(n, pa.binary())],
                                      ["a", "b", "edge", "side", "place", "pass", "label", "dims", "vector"])


def _compared(window: int, cosine: float):
    """Sorted rows of one range -> pairs within it, and its first and last rows for the step over the ends."""
    def run(batches):
        me = TaskContext.get().partitionId()
        carried: list[dict] = []
        first: list[dict] = []

        def edge_rows(rows, edge, side):
            n = len(rows)
            column = lambda k, t: pa.array([r[k] for r in rows], t)
            return pa.RecordBatch.from_arrays([
                column("rep", pa.int64()), pa.nulls(n, pa.int64()), pa.array([edge] * n, pa.int64()), pa.array([side] * n, pa.int32()),
                pa.array(range(n), pa.int32()), column("pass", pa.int32()), column("label", pa.string()), column("dims", pa.int32()),
                column("vector", pa.binary())], ["a", "b", "edge", "side", "place", "pass", "label", "dims", "vector"])

        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                rows = carried + batch.slice(at, 4096).to_pylist()
                old = len(carried)
                if len(first) < window:
                    first += rows[old:][: window - len(first)]
                cut = [i for i in range(len(rows)) if i == 0 or any(rows[i][k] != rows[i - 1][k] for k in ("pass", "label", "dims"))] + [len(rows)]
                for lo, hi in zip(cut[:-1], cut[1:]):
                    x = _unit([r["vector"] for r in rows[lo:hi]], rows[lo]["dims"])
                    rep = np.array([r["rep"] for r in rows[lo:hi]], np.int64)
                    if lo < old:         # pairs among the carried rows are known
                        yield _pairs_batch(*_forest(*near(x, rep, window, cosine, old - lo)))
                        x, rep = x[old - lo:], rep[old - lo:]
                    yield _pairs_batch(*_forest(*near(x, rep, window, cosine)))
                carried = rows[-window:]
        if first:
            yield edge_rows(first, me, 1)
            yield edge_rows(carried, me, 0)
    return run


def ranges_for(rows: int, window: int, most: int) -> int:
    """So many ranges that each holds several windows."""
    return max(min(most, rows // (WINDOWS * window)), 1)


def _reached(sizes: dict[int, int], window: int) -> list[tuple[int, int, int]]:
    """(range, edge, rows between) of the edges whose window reaches a later range; an edge is named by the range before it.

    ``sizes``: rows of each range that has some, up to ``window``."""
    ranges = sorted(sizes)
    out = []
    for k, edge in enumerate(ranges):
        between = 0
        for later in ranges[k + 1:]:
            if between >= window:
                break
            out.append((later, edge, between))
            between += sizes[later]
    return out


def _over_ends(window: int, cosine: float):
    """The last rows of a range against those that follow it."""
    def run(key, table):
        rows = sorted(table.to_pylist(), key=lambda r: (r["side"], r["place"]))
        side = [r["side"] for r in rows].index(1) if rows and rows[-1]["side"] == 1 else len(rows)
        a, b = [], []
        if 0 < side < len(rows):
            same = [r for r in rows if all(r[k] == rows[side - 1][k] for k in ("pass", "label", "dims"))]
            last = [r for r in same if r["side"] == 0]
            x = _unit([r["vector"] for r in same], same[0]["dims"])
            a, b = near(x, np.array([r["a"] for r in same], np.int64), window, cosine, len(last))
            a, b = _forest(a, b)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def linked_sizes(x: np.ndarray, size: np.ndarray, y: np.ndarray, y_size: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """For each row of x the sizes of the rows of y at this cosine, summed, and the other way round."""
    of_x, of_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
    for lo in range(0, len(x), STEP):
        for at in range(0, len(y), 4096):
            part = y[at:at + 4096]
            like = x[lo:lo + STEP] @ part.T
            linked = like >= cosine + 1e-9
            i, j = np.nonzero((like >= cosine - 1e-9) & ~linked)         # as near as rounding: summed as in ``near``
            linked[i, j] = np.einsum("ij,ij->i", x[lo + i], part[j]) >= cosine
            of_x[lo:lo + STEP] += linked @ y_size[at:at + 4096]
            of_y[at:at + 4096] += size[lo:lo + STEP] @ linked
    return of_x, of_y


def _met(kind: str, cosine: float):
    """Two blocks of one component (or one block, or several small components) -> sums of linked sizes per vector."""
    def run(key, table):
        table = table.sort_by([("root", "ascending"), ("block", "ascending"), ("rep", "ascending")])
        root, block, rep, size = (table.column(c).to_numpy() for c in ("root", "block", "rep", "size"))
        raw = table.column("vector").to_pylist()
        cut = np.flatnonzero(np.concatenate(([True], root[1:] != root[:-1], [True])))
        others = np.zeros(len(rep), np.int64)
        for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
            x = _unit(raw[lo:hi], len(raw[lo]) // np.dtype(kind).itemsize)
            mid = lo + int(np.searchsorted(block[lo:hi], block[lo], side="right"))
            if mid == hi and key[2].as_py() == key[3].as_py():
                others[lo:hi] = linked_sizes(x, size[lo:hi], x, size[lo:hi], cosine)[0] - size[lo:hi]
            elif mid < hi:
                others[lo:mid], others[mid:hi] = linked_sizes(x[:mid - lo], size[lo:mid], x[mid - lo:], size[mid:hi], cosine)
        return pa.table({"rep": pa.array(rep, pa.int64()), "others": pa.array(others, pa.int64())})
    return run


def _raw(kind: str):
    def run(batches):
        for batch in batches:
            raw = [np.asarray(v, kind).tobytes() for v in batch.column("embedding").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("size"), pa.array(raw, pa.binary())], ["rep", "size", "vector"])
    return run


def linked_to(classes: DataFrame, roots: DataFrame, scratch: Scratch, kind: str, cosine: float) -> DataFrame:
    """rep, others: how many vectors of other classes each class of a component links with, by comparing all of them."""
    inside = roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct().withColumnRenamed("node", "rep")
    members = inside.groupBy("root").agg(F.count("*").alias("n"))
    vectors = classes.select("rep", "size", "embedding").join(inside.select("rep"), "rep", "left_semi").mapInArrow(_raw(kind), "rep long, size long, vector binary")
    fit = F.greatest(F.lit(1), F.floor(F.lit(BLOCK_BYTES // 8) / F.greatest(F.octet_length("vector") / np.dtype(kind).itemsize, F.lit(1))))
    rows = F.least(fit, F.greatest(F.lit(BLOCK), F.ceil(F.col("n") / BLOCKS)))
    known = scratch.written(vectors.join(inside, "rep").join(members, "root").select(
        "root", "rep", "size", "vector", F.ceil(F.col("n") / rows).cast("int").alias("blocks")), "members")
    known = known.withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    together = max(-(-known.where("blocks = 1").count() // TOGETHER), 1)
    cell = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("root"), F.lit(together))).otherwise(F.col("root"))
    met = (known.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select("root", "block", "rep", "size", "vector", "blocks", cell.alias("cell"), F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"))
           .groupBy("blocks", "cell", "i", "j").applyInArrow(_met(kind, cosine), "rep long, others long"))
    return met.groupBy("rep").agg(F.sum("others").alias("others"))


def usable(column: str = "embedding"):
    """A vector that can be compared: no null or non-finite component, not zero, not empty."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col("label").isNotNull() & (F.size(column) > 0) & ~bad & F.exists(column, lambda x: x != 0)


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, passes: int = PASSES, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors(vec_id, embedding, label)``."""
    vectors = vectors.select("vec_id", "embedding", "label")
    scratch = Scratch(vectors.sparkSession, "vector-dedup")
    good = vectors.where(usable()).where("vec_id is not null").select("vec_id", "embedding", F.col("label").cast("string").alias("label"))
    classes = scratch.written(good.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.countDistinct("vec_id").alias("size")), "classes")
    kind = "<f4" if dict(vectors.dtypes)["embedding"] == "array<float>" else "<f8"
    ranges = ranges_for(classes.count() * passes, window, partitions(vectors.sparkSession))
    ordered = (classes.select("rep", "label", "embedding").mapInArrow(_keyed(passes, seed, kind), "pass int, label string, dims int, key long, rep long, vector binary")
               .repartitionByRange(ranges, "pass", "label", "dims", "key", "rep").sortWithinPartitions("pass", "label", "dims", "key", "rep"))
    compared = scratch.written(ordered.mapInArrow(_compared(window, cosine), OUT), "compared")
    edge = compared.where("edge is not null")
    sizes = {r["edge"]: r["count"] for r in edge.where("side = 1").groupBy("edge").count().collect()}         # one row per range
    reached = vectors.sparkSession.createDataFrame(_reached(sizes, window), "edge long, to long, between int")
    after = edge.where("side = 1").join(reached, "edge").withColumns({"edge": F.col("to"), "place": F.col("place") + F.col("between")})
    ends = edge.where("side = 0").unionByName(after.where(F.col("place") < window).select(edge.columns)).groupBy("edge").applyInArrow(_over_ends(window, cosine), "a long, b long")
    links = compared.where("edge is null").select("a", "b").unionByName(ends)
    roots = components(links, scratch)
    degree = linked_to(classes, roots, scratch, kind, cosine)
    known = (classes.join(degree, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
             .select("label", "embedding", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("root")))
    per_row = good.join(known, ["label", "embedding"]).select("vec_id", "n_links", "root")
    per_id = per_row.groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("root").alias("root"))
    component = F.coalesce("root", "vec_id")
    return scratch.result(vectors.select("vec_id").join(per_id, "vec_id", "left")
                          .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept")))
