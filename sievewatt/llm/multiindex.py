"""Approximate nearest neighbours by inner product: an inverted multi-index over two halves of each vector.

Each half of the vectors has its own centroids, and a cell is a pair of them. So that the nearest centroids are
those of the largest products, every vector gets one more component, ``sqrt(longest**2 - |x|**2)``, and a query a
zero there: the squared distance of the two is then ``|q|**2 + longest**2 - 2 * product``. A query takes the cells
in order of summed distance (its first half to the one centroid, its second half to the other), with a heap over
the two sorted lists of centroids, until they hold a given share of all different vectors. It ends with the summed
distance of the last pair. All vectors in cells up to that distance are then ranked by their exact products.

Cells are packed into blocks of bounded size (a large cell is cut by a hash), queries into blocks as well, and the
blocks meet by an equi join on their numbers: no task holds all of either side, and the driver only sees the
centroids and the counts of cells, whose number does not depend on the rows. Centroids are fitted on a bounded
sample (:data:`SAMPLE` different rows by a hash of the vector); every row is indexed.

Copies count once in the share, so that a frequent vector does not use it up.

Defined results: vectors that are null, zero or hold a null, NaN or infinite component take no part, nor do null
ids; vectors are compared only with vectors of as many components; a query never meets rows of its own id; ties go
to the smaller id; a query row that repeats exactly counts once; a query without candidates gives no row; no rows
give no rows. A table of no more than :data:`LEAST` different vectors is searched whole.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewatt.llm.common import durable

K = 20
CENTROIDS = 128
# Share of the different vectors that a query's cells hold, and their least number.
SHARE = 0.4
LEAST = 5000
SAMPLE = 16_384
STEPS = 8
# Candidates and queries in one block; queries whose products are made at a time.
BLOCK = 8192
QUERY_BLOCK = 4096
AT_ONCE = 128
# Queries whose cells one task finds.
ROUTED = 256

HITS = "query_id long, vec_id long, score double"
Centres = dict[int, tuple[float, np.ndarray, np.ndarray]]


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v, dim, length) of the vectors that take part."""
    x = F.col(vec_col)
    kind = vectors.schema[vec_col].dataType.simpleString()
    kept = x if kind in ("array<float>", "array<double>") else x.cast("array<double>")
    fine = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (
        vectors.filter(F.col(id_col).isNotNull() & fine & F.exists(x, lambda c: c != 0))
        .select(F.col(id_col).cast("long").alias("vec_id"), kept.alias("v"))
        .withColumn("dim", F.size("v"))
        .withColumn("length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))))
    )


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(flat):
        return np.zeros((0, 0))
    return flat.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(flat), -1)


def halves(x: np.ndarray, longest: float, query: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Both halves, the second one with the component that evens out the lengths."""
    h = x.shape[1] // 2
    rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, longest**2 - (x**2).sum(1)))
    return x[:, :h], np.column_stack([x[:, h:], rest])


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, (x**2).sum(1)[:, None] - 2 * (x @ c.T) + (c**2).sum(1))


def fit(x: np.ndarray, k: int, steps: int = STEPS) -> np.ndarray:
    """At most ``k`` centroids; the first ones are evenly spaced rows."""
    x = np.unique(x, axis=0)
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(steps):
        own = distances(x, centres).argmin(1)
        count = np.bincount(own, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    return centres


def train(vectors: DataFrame, centroids: int = CENTROIDS, sample: int = SAMPLE) -> Centres:
    """Per number of components: the greatest length and the centroids of both halves. ``vectors`` is read three times."""
    longest = {r["dim"]: r["longest"] for r in vectors.groupBy("dim").agg(F.max("length").alias("longest")).collect()}
    # equal vectors share a hash; where there are very many rows, only a range of hashes is looked at
    share = min(1.0, 16 * sample / max(1, vectors.count()))
    order = Window.partitionBy("dim").orderBy("h")
    rows = (
        vectors.select("dim", "v", F.xxhash64("v").alias("h"))
        .filter(F.pmod("h", F.lit(1 << 20)) < F.lit(int(np.ceil(share * (1 << 20)))))
        .dropDuplicates(["dim", "h"])
        .withColumn("r", F.row_number().over(order))
        .filter(F.col("r") <= sample)
        .select("dim", "v")
        .toPandas()
    )
    centres = {}
    for dim, of in rows.groupby("dim"):
        one, two = halves(np.stack(of["v"].to_numpy()).astype(float), longest[dim])
        centres[int(dim)] = longest[dim], fit(one, centroids), fit(two, centroids)
    return centres


def _cells(centres: Centres):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch["dim"].to_numpy()
            cell = np.zeros(len(dims), np.int32)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                longest, c1, c2 = centres[int(dim)]
                one, two = halves(_matrix(batch["v"].take(pa.array(rows))), longest)
                cell[rows] = distances(one, c1).argmin(1) * len(c2) + distances(two, c2).argmin(1)
            yield batch.append_column("cell", pa.array(cell, pa.int32()))

    return run


def traverse(near: np.ndarray, far: np.ndarray, counts: np.ndarray, wanted: int) -> tuple[float, list[int]]:
    """(summed distance of the last pair, cells with vectors) in order of summed distance until they hold ``wanted``.

    ``near`` and ``far`` are one query's distances to the centroids of the first and of the second half. The heap
    holds at most one open pair per centroid of the first half.
    """
    a, b = np.argsort(near, kind="stable"), np.argsort(far, kind="stable")
    da, db = near[a].tolist(), far[b].tolist()
    heap, held, last, taken = [(da[0] + db[0], 0, 0)], 0, 0.0, []
    while heap and held < wanted:
        last, i, j = heapq.heappop(heap)
        cell = int(a[i]) * len(b) + int(b[j])
        if counts[cell]:
            held += int(counts[cell])
            taken.append(cell)
        if j + 1 < len(b):
            heapq.heappush(heap, (da[i] + db[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (da[i + 1] + db[0], i + 1, 0))
    return last, taken


def _routes(
    centres: Centres,
    counts: dict[int, np.ndarray],
    first: dict[int, np.ndarray],
    parts: dict[int, np.ndarray],
    share: float,
    least: int,
):
    """Every query with the distance it ends at, once per block that has a cell of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, blocks, limits = [], [], []
            dims = batch["dim"].to_numpy()
            for dim in np.unique(dims):
                longest, c1, c2 = centres[int(dim)]
                rows, n = np.flatnonzero(dims == dim), counts[int(dim)]
                one, two = halves(_matrix(batch["v"].take(pa.array(rows))), longest, query=True)
                near, far = distances(one, c1), distances(two, c2)
                wanted = max(least, int(np.ceil(share * n.sum())))
                for k, row in enumerate(rows):
                    limit, taken = traverse(near[k], far[k], n, wanted)
                    start, cut = first[int(dim)][taken], parts[int(dim)][taken]
                    inner = np.arange(cut.sum()) - np.repeat(np.cumsum(cut) - cut, cut)
                    met = np.unique(np.repeat(start, cut) + inner)
                    at.append(np.full(len(met), row))
                    blocks.append(met)
                    limits.append(np.full(len(met), limit))
            if at:
                rows = pa.array(np.concatenate(at))
                out = batch.select(["vec_id", "v", "dim"]).take(rows)
                out = out.append_column("block", pa.array(np.concatenate(blocks), pa.int32()))
                yield out.append_column("limit", pa.array(np.concatenate(limits), pa.float64()))

    return run


def pack(counts: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(first block, number of blocks) of every cell, and the number of all blocks: cells in order, together up to
    ``block`` rows; a larger cell has blocks of its own."""
    first, parts = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
    at = held = 0
    for cell, n in enumerate(counts.tolist()):
        if held and held + n > block:
            at, held = at + 1, 0
        first[cell] = at
        if n > block:
            parts[cell] = -(-n // block)
            at, held = at + int(parts[cell]), 0
        else:
            held += n
    return first, parts, at + 1


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Products summed from the first component to the last, so that they do not depend on the rows beside them."""
    total = np.zeros(len(c))
    for k in range(len(q)):
        total += q[k] * c[:, k]
    return total


def block_hits(
    qid: np.ndarray, q: np.ndarray, limit: np.ndarray, ids: np.ndarray, c: np.ndarray, cell: np.ndarray,
    centres: tuple[float, np.ndarray, np.ndarray], k: int,
) -> Iterator[tuple[int, int, float]]:
    """(query, candidate, product) of every query's ``k`` best among those candidates that lie in its cells."""
    longest, c1, c2 = centres
    one, two = halves(q, longest, query=True)
    present, where = np.unique(cell, return_inverse=True)
    i, j = present // len(c2), present % len(c2)
    for lo in range(0, len(qid), AT_ONCE):
        part = slice(lo, lo + AT_ONCE)
        # the distances are made anew here; the margin keeps every cell that was taken
        reached = distances(one[part], c1[i]) + distances(two[part], c2[j]) <= limit[part, None] * (1 + 1e-9) + 1e-12
        rough = q[part] @ c.T
        rough[~reached[:, where] | (ids[None, :] == qid[part, None])] = -np.inf
        for r in range(len(rough)):
            s = rough[r]
            n = int(np.isfinite(s).sum())
            if not n:
                continue
            at = np.partition(s, len(s) - k)[len(s) - k] if n > k else -np.inf
            margin = 1e-9 * (1.0 + abs(at)) if np.isfinite(at) else 0.0
            kept = np.flatnonzero((s >= at - margin) & np.isfinite(s))
            exact = _products(q[lo + r], c[kept])
            for x in np.lexsort((ids[kept], -exact))[:k]:
                yield int(qid[lo + r]), int(ids[kept[x]]), float(exact[x])


def _blocks(centres: Centres, k: int):
    names = ("query_id", "vec_id", "score")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        hits: list[tuple[int, int, float]] = []
        if left.num_rows and right.num_rows:
            dim = int(left["dim"][0].as_py())
            hits = list(
                block_hits(
                    right["vec_id"].to_numpy(), _matrix(right["v"]), right["limit"].to_numpy(),
                    left["vec_id"].to_numpy(), _matrix(left["v"]), left["cell"].to_numpy(), centres[dim], k,
                )
            )
        cols = list(zip(*hits, strict=True)) or [(), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table({n: pa.array(x, t) for n, x, t in zip(names, cols, kinds, strict=True)})

    return run


def search(
    vectors: DataFrame,
    queries: Column,
    k: int = K,
    centroids: int = CENTROIDS,
    share: float = SHARE,
    least: int = LEAST,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found among ``vectors`` (as :func:`usable` gives them) for
    every vector that ``queries`` selects."""
    spark = vectors.sparkSession
    vectors, kind = durable(vectors), vectors.schema["v"].dataType.simpleString()
    centres = train(vectors, centroids)
    indexed = durable(
        vectors.select("vec_id", "v", "dim").mapInArrow(_cells(centres), f"vec_id long, v {kind}, dim int, cell int")
    )
    # at most centroids ** 2 rows for each number of components
    tally = (
        indexed.groupBy("dim", "cell", F.xxhash64("v").alias("h")).agg(F.count(F.lit(1)).alias("rows"))
        .groupBy("dim", "cell").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("n"))
        .toPandas()
    )
    counts, first, parts, places = {}, {}, {}, []
    start = 0
    for dim, (_, c1, c2) in centres.items():
        of = tally[tally["dim"] == dim]
        counts[dim], rows = np.zeros(len(c1) * len(c2), np.int64), np.zeros(len(c1) * len(c2), np.int64)
        counts[dim][of["cell"]], rows[of["cell"]] = of["n"], of["rows"]
        first[dim], parts[dim], used = pack(rows, block)
        first[dim] += start
        start += used
        places += [(dim, int(c), int(first[dim][c]), int(parts[dim][c])) for c in of["cell"]]
    where = spark.createDataFrame(places, "dim int, cell int, first int, parts int")
    n_queries = vectors.filter(queries).count()
    qblock = F.pmod(F.xxhash64("vec_id"), F.lit(n_queries // query_block + 1)).cast("int").alias("qblock")
    spread = vectors.filter(queries).select("vec_id", "v", "dim").repartition(n_queries // ROUTED + 1, "vec_id")
    chosen = spread.dropDuplicates(["vec_id", "v"])
    routed = durable(
        chosen.mapInArrow(
            _routes(centres, counts, first, parts, share, least),
            f"vec_id long, v {kind}, dim int, block int, limit double",
        ).select("*", qblock)
    )
    # candidates go only to the blocks of queries that want them
    wanted = routed.select(F.col("block").alias("of"), F.col("qblock").alias("by")).distinct()
    cut = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("parts"))
    placed = indexed.join(F.broadcast(where), ["dim", "cell"]).select(
        "vec_id", "v", "dim", "cell", (F.col("first") + cut).cast("int").alias("block")
    )
    sent = placed.join(wanted, F.col("block") == F.col("of"))
    hits = sent.groupBy("of", "by").cogroup(routed.groupBy("block", "qblock")).applyInArrow(_blocks(centres, k), HITS)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
