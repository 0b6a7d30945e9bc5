"""Exact top-k inner products over vectors grouped by length.

Candidates are sorted into buckets of similar length (norm) and cut into blocks of bounded size. Every query
starts with a threshold: its k-th best product among a bounded number of the longest vectors, which is a lower
bound of its k-th best overall. A block can then be left out for a query whose threshold exceeds
``|q| * longest length in the block``. For the others the block derives the local cosine threshold
``threshold / (|q| * longest)`` and prunes in one of two ways: by length (only candidates with
``|q| * |p| >= threshold``) where it is low, or by coordinates where it is high: with cosine ``t``, a unit
vector ``p`` must have, at every coordinate where the unit query has value ``q``,
``q*t - sqrt((1-t*t)*(1-q*q)) <= p <= q*t + sqrt((1-t*t)*(1-q*q))``, where the upper bound is 1 if ``q > t``
and the lower bound is -1 if ``q < -t`` (the axis itself is then near enough); the query's largest coordinates
are tested. The products of what remains are then computed exactly, in integers.

Queries meet candidates in blocks of both, so no task holds all of either.

Defined results: vectors that are null or hold a null, NaN or infinite component take no part; vectors are
compared only with vectors of as many components; an all-zero vector has product 0 with everything; a query
never meets rows of its own id; ties go to the smaller id, then to the repeated row; a query row that repeats
exactly counts once; a query without candidates gives no row; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewatt.llm.common import durable

K = 5
# Candidates and queries in one block; the longest vectors that set first thresholds.
BLOCK = 8192
QUERY_BLOCK = 1024
SEEDS = 1000
# Lengths within a bucket differ by less than this share.
BAND = 0.02
# Local cosine from which coordinates prune better than lengths, and the number of coordinates tested.
COORDINATE_FROM = 0.45
FOCUS = 3
EXACT = float(1 << 53)

HITS = "query_id long, vec_id long, score long"


def scaled(vectors: DataFrame, factor: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v, dim, length) with every component x as floor(factor * x); unusable vectors are dropped."""
    x = F.col(vec_col)
    fine = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    v = F.transform(x, lambda c: F.floor(c.cast("double") * factor).cast("long"))
    return (
        vectors.filter(F.col(id_col).isNotNull() & fine)
        .select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
        .withColumn("dim", F.size("v"))
        .withColumn("length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))))
    )


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(flat):
        return np.zeros((0, 0), np.int64)
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(flat), -1)


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products; through doubles where these hold every partial sum."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    if bound < EXACT:
        return np.rint(q.astype(float) @ c.astype(float).T).astype(np.int64)
    return q @ c.T


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= cut)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))][:k]


def block_hits(
    qid: np.ndarray, q: np.ndarray, qlen: np.ndarray, least: np.ndarray, ids: np.ndarray, c: np.ndarray, clen: np.ndarray, k: int
) -> Iterator[tuple[int, int, int]]:
    """(query, candidate, score) of every query's k best in one block, if they reach its threshold ``least``."""
    order = np.argsort(-clen, kind="stable")
    ids, c, clen = ids[order], c[order], clen[order]
    longest = clen[0] if len(clen) else 0.0
    unit = c / np.where(clen > 0, clen, 1.0)[:, None]
    for i in range(len(qid)):
        reach = qlen[i] * longest
        # a little below, so that rounding never prunes a tie
        low = least[i] - 1e-6 * max(1.0, abs(least[i]))
        if low > reach:
            continue
        kept = np.arange(len(ids))
        if low > 0 and reach > 0:
            kept = kept[: np.searchsorted(-qlen[i] * clen, -low, side="right")]
            local = low / reach
            if local >= COORDINATE_FROM:
                uq = q[i] / qlen[i]
                for f in np.argsort(-np.abs(uq), kind="stable")[:FOCUS]:
                    cosine = np.minimum(1.0, low / (qlen[i] * clen[kept]))
                    slack = np.sqrt((1 - cosine**2) * max(0.0, 1 - uq[f] ** 2)) + 1e-9
                    lower = np.where(uq[f] < -cosine, -np.inf, uq[f] * cosine - slack)
                    upper = np.where(uq[f] > cosine, np.inf, uq[f] * cosine + slack)
                    kept = kept[(lower <= unit[kept, f]) & (unit[kept, f] <= upper)]
        kept = kept[ids[kept] != qid[i]]
        if not len(kept):
            continue
        scores = _products(q[i : i + 1], c[kept])[0]
        for j in best(scores, ids[kept], k):
            if scores[j] >= low:
                yield int(qid[i]), int(ids[kept[j]]), int(scores[j])


def _blocks(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        hits: list[tuple[int, int, int]] = []
        if left.num_rows and right.num_rows:
            hits = list(
                block_hits(
                    right["vec_id"].to_numpy(), _matrix(right["v"]), right["length"].to_numpy(), right["least"].to_numpy(),
                    left["vec_id"].to_numpy(), _matrix(left["v"]), left["length"].to_numpy(), k,
                )
            )
        cols = list(zip(*hits, strict=True)) or [(), (), ()]
        return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(("query_id", "vec_id", "score"), cols, strict=True)})

    return run


def _threshold(k: int):
    """Per query, the k-th best product with the seeds it meets; all rows of a group have one dimension."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        q, c, own = _matrix(left["v"]), _matrix(right["v"]), right["vec_id"].to_numpy()
        qid, least = left["vec_id"].to_numpy(), []
        if len(q) and len(c):
            for i, s in enumerate(_products(q, c).astype(float)):
                s = s[own != qid[i]]
                least.append(float(np.partition(s, len(s) - k)[len(s) - k]) if len(s) >= k else -np.inf)
        else:
            least = [-np.inf] * len(q)
        return left.append_column("least", pa.array(least, pa.float64()))

    return run


def search(vectors: DataFrame, queries: Column, k: int = K, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of all ``vectors`` (as :func:`scaled` gives them) for
    every vector that ``queries`` selects. ``vectors`` is read several times."""
    by_band = F.floor(F.log(F.greatest(F.col("length"), F.lit(0.5))) / F.log(F.lit(1 + BAND)))
    banded = vectors.withColumn("band", by_band.cast("int"))
    sizes = banded.groupBy("dim", "band").agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("longest"))
    sizes = durable(sizes.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")))
    # bands are few: their number grows with the logarithm of the range of lengths
    candidates = banded.join(F.broadcast(sizes.select("dim", "band", "blocks")), ["dim", "band"]).withColumn(
        "block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
    )
    chosen = vectors.filter(queries).dropDuplicates(["vec_id", "v"])
    n_queries = chosen.count()
    chosen = chosen.withColumn("qblock", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(n_queries // query_block + 1)).cast("int"))

    # the longest vectors of each dimension, a bounded number, go to every block of queries
    seeds = durable(
        vectors.withColumn("r", F.row_number().over(Window.partitionBy("dim").orderBy(F.desc("length"), "vec_id")))
        .filter(F.col("r") <= SEEDS)
        .drop("r")
    )
    spread = F.explode(F.sequence(F.lit(0), F.lit(n_queries // query_block))).alias("qblock")
    started = durable(
        chosen.groupBy("dim", "qblock")
        .cogroup(seeds.select("*", spread).groupBy("dim", "qblock"))
        .applyInArrow(_threshold(k), "vec_id long, v array<bigint>, dim int, length double, qblock int, least double")
    )
    # a query goes only to the blocks it can have a hit in; a block only to the blocks of queries that want it
    reached = started.join(F.broadcast(sizes), "dim").filter(
        F.col("least") <= F.col("length") * F.col("longest") * (1 + 1e-9) + 1e-6
    )
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    met = reached.select("dim", "band", every, "qblock", "vec_id", "v", "length", "least")
    wanted = reached.groupBy("dim", "band").agg(F.collect_set("qblock").alias("qblocks"))
    sent = candidates.join(F.broadcast(wanted), ["dim", "band"]).select(
        "dim", "band", "block", F.explode("qblocks").alias("qblock"), "vec_id", "v", "length"
    )
    keys = ["dim", "band", "block", "qblock"]
    hits = sent.groupBy(*keys).cogroup(met.groupBy(*keys)).applyInArrow(_blocks(k), HITS)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
