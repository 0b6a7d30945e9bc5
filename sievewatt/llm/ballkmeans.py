"""Compress vectors to a few bytes: codebooks per part of the vector, found by Ball k-means in whole numbers.

Every vector is cut into consecutive parts, and each part position has a codebook of a few entries. A round
gives each part to its nearest entry and moves the entries to the floored mean of their parts. All parts of one
entry form a ball around it. What is known of the balls spares most comparisons, and never changes a result:

- *Neighbours.* An entry further from another than twice the radius of its ball cannot take any of its parts.
- *Stable core.* A part nearer to its entry than half the way to the nearest neighbour stays without a comparison.
- *Annular rings.* Any other part is compared with those neighbours only that are at most twice its own distance
  away; parts whose lists are about as long form a ring and are compared together.

All of it is decided on whole numbers (four times the squared distance of a part against the squared distance of
two entries), so ties are exact. Radii are carried over a round by the triangle inequality: the old radius plus the
way that the entry moved.

Each round is one pass without a shuffle: it writes the vectors with their new entries, and per task one sum row
for each entry, which is all that is aggregated and all that the driver sees (entries x components, whatever the
number of vectors). A round reads what the one before it wrote to the shared folder, which is then removed.

Defined results: vectors that are null or hold a null, NaN or infinite component are dropped; components beyond
:data:`LIMIT` after scaling count as the limit; vectors of each number of components have codebooks of their own;
a number of components that the parts do not divide is cut as evenly as it can be, an empty vector has empty parts
and entry 0; fewer vectors than entries make smaller codebooks; equal first entries are all kept, and the lower
index wins ties; a null id comes after all others; repeated rows count each; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievewatt.llm.common import durable, small_side
from sievewatt.runtime import scratch_path

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
LIMIT = 1 << 24
EXACT = float(1 << 53)

Books = dict[int, list[np.ndarray]]
ROUND = (
    "vec_id long, label {label}, v array<int>, codes array<int>, "
    "dim int, part int, entry int, n long, reach long, sums array<bigint>"
)


def scaled(
    vectors: DataFrame, scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """(vec_id, label, v) with every component x as floor(scale * x); unusable vectors are dropped."""
    x = F.col(vec_col)
    fine = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    held = F.transform(
        x, lambda c: F.floor(F.least(F.greatest(c.cast("double") * scale, F.lit(-float(LIMIT))), F.lit(float(LIMIT)))).cast("int")
    )
    return vectors.filter(fine).select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), held.alias("v"))


def cuts(dim: int, parts: int) -> list[tuple[int, int]]:
    return [(p * dim // parts, (p + 1) * dim // parts) for p in range(parts)]


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of ``x`` and of ``c``; through doubles where these hold every partial sum."""
    size = max(np.abs(x).max(initial=0), np.abs(c).max(initial=0))
    if 4.0 * float(size) ** 2 * max(1, x.shape[1]) < EXACT:
        xf, cf = x.astype(float), c.astype(float)
        return np.rint((xf**2).sum(1)[:, None] - 2 * (xf @ cf.T) + (cf**2).sum(1)).astype(np.int64)
    return (x**2).sum(1)[:, None] - 2 * (x @ c.T) + (c**2).sum(1)


class Balls:
    """The entries of one codebook, and of each the others sorted by squared distance, as far as its ball reaches."""

    def __init__(self, book: np.ndarray, reach: np.ndarray | None):
        self.book = book
        self.apart = squares(book, book)
        self.reach = reach
        self._near: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def near(self, entry: int) -> tuple[np.ndarray, np.ndarray]:
        if entry not in self._near:
            others = np.argsort(self.apart[entry], kind="stable")
            others = others[others != entry]
            apart = self.apart[entry][others]
            within = int(np.searchsorted(apart, 4 * self.reach[entry], side="right"))
            self._near[entry] = others[:within], apart[:within]
        return self._near[entry]

    def first(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(entry, squared distance, comparisons) of every part, before there are any balls."""
        d = squares(x, self.book)
        entry = d.argmin(1)
        return entry, d[np.arange(len(x)), entry], d.size

    def assign(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The same from the entries of the round before."""
        entry, dist = own.copy(), ((x - self.book[own]) ** 2).sum(1)
        compared = 0
        by_own = np.argsort(own, kind="stable")
        starts = np.searchsorted(own[by_own], np.arange(len(self.book) + 1))
        for i in np.unique(own):
            rows = by_own[starts[i] : starts[i + 1]]
            others, apart = self.near(int(i))
            # how many neighbours are at most twice as far as the part; none: the stable core
            reached = np.searchsorted(apart, 4 * dist[rows], side="right")
            low, high = 0, 1
            while low < len(others):
                ring = rows[(reached > low) & (reached <= high)]
                if len(ring):
                    some = np.sort(np.append(others[:high], i))
                    d = squares(x[ring], self.book[some])
                    best = d.argmin(1)
                    entry[ring], dist[ring] = some[best], d[np.arange(len(ring)), best]
                    compared += d.size
                low, high = high, 2 * high
        return entry, dist, compared


def _matrix(column: pa.Array, rows: np.ndarray, width: int) -> np.ndarray:
    flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(len(rows), width)


def _sizes(column: pa.Array) -> np.ndarray:
    return np.diff(column.offsets.to_numpy()).astype(np.int64)


def _assigned(
    batch: pa.RecordBatch, balls: dict[int, list[Balls]], parts: int, known: bool
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per number of components: (dim, rows, vectors, entries, squared distances)."""
    sizes = _sizes(batch["v"])
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        x = _matrix(batch["v"], rows, int(dim))
        own = _matrix(batch["codes"], rows, parts) if known else None
        found = [
            b.assign(x[:, lo:hi], own[:, p])[:2] if known else b.first(x[:, lo:hi])[:2]
            for p, (b, (lo, hi)) in enumerate(zip(balls[int(dim)], cuts(int(dim), parts), strict=True))
        ]
        yield int(dim), rows, x, np.stack([e for e, _ in found], 1), np.stack([d for _, d in found], 1)


def _balls(books: Books, reach: Books | None) -> dict[int, list[Balls]]:
    return {dim: [Balls(b, reach[dim][p] if reach else None) for p, b in enumerate(of)] for dim, of in books.items()}


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.reshape(-1), kind))


def _round(books: Books, reach: Books | None, parts: int, label: pa.DataType):
    schema = pa.schema(
        [("vec_id", pa.int64()), ("label", label), ("v", pa.list_(pa.int32())), ("codes", pa.list_(pa.int32()))]
        + [(n, pa.int32()) for n in ("dim", "part", "entry")]
        + [("n", pa.int64()), ("reach", pa.int64()), ("sums", pa.list_(pa.int64()))]
    )

    def filled(size: int, **columns) -> pa.RecordBatch:
        held = [columns[f.name] if f.name in columns else pa.nulls(size, f.type) for f in schema]
        return pa.RecordBatch.from_arrays(held, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = _balls(books, reach)
        counts = {d: [np.zeros(len(b), np.int64) for b in of] for d, of in books.items()}
        radii = {d: [np.full(len(b), -1, np.int64) for b in of] for d, of in books.items()}
        sums = {d: [np.zeros_like(b) for b in of] for d, of in books.items()}
        for batch in batches:
            for dim, rows, x, codes, dist in _assigned(batch, balls, parts, reach is not None):
                for p, (lo, hi) in enumerate(cuts(dim, parts)):
                    np.add.at(sums[dim][p], codes[:, p], x[:, lo:hi])
                    np.maximum.at(radii[dim][p], codes[:, p], dist[:, p])
                    counts[dim][p] += np.bincount(codes[:, p], minlength=len(books[dim][p]))
                at = pa.array(rows)
                yield filled(
                    len(rows), vec_id=batch["vec_id"].take(at), label=batch["label"].take(at),
                    v=_lists(x, pa.int32()), codes=_lists(codes, pa.int32()),
                )
        for dim, of in counts.items():
            for p, count in enumerate(of):
                used = np.flatnonzero(count)
                if len(used):
                    yield filled(
                        len(used),
                        dim=pa.array(np.full(len(used), dim), pa.int32()),
                        part=pa.array(np.full(len(used), p), pa.int32()),
                        entry=pa.array(used, pa.int32()),
                        n=pa.array(count[used]),
                        reach=pa.array(radii[dim][p][used]),
                        sums=_lists(sums[dim][p][used], pa.int64()),
                    )

    return run


def _moved(stored: DataFrame, books: Books) -> tuple[Books, Books]:
    """Codebooks after a round, and the squared radius that no ball exceeds."""
    per_task = stored.filter(F.col("part").isNotNull())
    keys = ["dim", "part", "entry"]
    tallies = per_task.groupBy(*keys).agg(F.sum("n").alias("n"), F.max("reach").alias("reach"))
    summed = (
        per_task.select(*keys, F.posexplode("sums").alias("at", "x")).groupBy(*keys, "at").agg(F.sum("x").alias("x"))
    )
    new = {d: [b.copy() for b in of] for d, of in books.items()}
    reach = {d: [np.full(len(b), -1, np.int64) for b in of] for d, of in books.items()}
    number = {}
    for dim, part, entry, n, r in tallies.toPandas().itertuples(index=False):
        number[dim, part, entry] = n
        reach[dim][part][entry] = r
    for dim, part, entry, at, x in summed.toPandas().itertuples(index=False):
        new[dim][part][entry, at] = x // number[dim, part, entry]
    for dim, of in books.items():
        for p, book in enumerate(of):
            way = np.sqrt(((new[dim][p] - book) ** 2).sum(1).astype(float))
            bound = np.ceil((np.sqrt(np.maximum(reach[dim][p], 0)) + way) ** 2 * (1 + 1e-9)).astype(np.int64) + 1
            reach[dim][p] = np.where(reach[dim][p] < 0, -1, bound)
    return new, reach


def first_books(vectors: DataFrame, entries: int = ENTRIES, parts: int = PARTS) -> Books:
    """The parts of the vectors with the smallest ids, for every number of components."""
    sized = vectors.select(F.size("v").alias("dim"), "vec_id", "v")
    order = Window.partitionBy("dim").orderBy(F.col("vec_id").asc_nulls_last(), "v")
    chosen = sized.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= entries)
    by_dim: dict[int, list[tuple[int, list[int]]]] = {}
    for row in chosen.collect():
        by_dim.setdefault(row["dim"], []).append((row["r"], row["v"]))
    books = {}
    for dim, of in by_dim.items():
        every = np.array([v for _, v in sorted(of)], np.int64).reshape(len(of), dim)
        books[dim] = [every[:, lo:hi].copy() for lo, hi in cuts(dim, parts)]
    return books


def digest(book: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position."""
    return hashlib.sha256(",".join(str(int(x)) for part in book for x in part.reshape(-1)).encode()).hexdigest()


def _forget(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _label_type(vectors: DataFrame) -> tuple[str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    kind = vectors.schema["label"].dataType
    return kind.simpleString(), to_arrow_type(kind)


def train(
    vectors: DataFrame, entries: int = ENTRIES, parts: int = PARTS, rounds: int = ROUNDS
) -> tuple[DataFrame, Books, Books | None]:
    """(vectors with their last entries, codebooks, reach of the balls) of ``vectors`` as :func:`scaled` gives them."""
    spark = vectors.sparkSession
    text, arrow = _label_type(vectors)
    books, reach, source, old = first_books(vectors, entries, parts), None, vectors, None
    for k in range(rounds):
        path = scratch_path(spark, f"ball-round{k}")
        source.mapInArrow(_round(books, reach, parts, arrow), ROUND.format(label=text)).write.parquet(path)
        stored = spark.read.schema(ROUND.format(label=text)).parquet(path)
        books, reach = _moved(stored, books)
        source = stored.filter(F.col("part").isNull()).select("vec_id", "label", "v", "codes")
        if old:
            _forget(spark, old)
        old = path
    return source, books, reach


def encode(source: DataFrame, books: Books, reach: Books | None, parts: int = PARTS) -> DataFrame:
    """(vec_id, label, code, error, codebooks_sha256) of what :func:`train` returned."""
    text, arrow = _label_type(source)
    digests = {dim: digest(of) for dim, of in books.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = _balls(books, reach)
        for batch in batches:
            for dim, rows, _, codes, dist in _assigned(batch, balls, parts, reach is not None):
                at = pa.array(rows)
                columns = {
                    "vec_id": batch["vec_id"].take(at),
                    "label": batch["label"].take(at).cast(arrow),
                    "code": pa.array(["".join(f"{c:02x}" for c in row) for row in codes.tolist()], pa.string()),
                    "error": pa.array(dist.sum(1), pa.int64()),
                    "codebooks_sha256": pa.array([digests[dim]] * len(rows), pa.string()),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return source.mapInArrow(run, f"vec_id long, label {text}, code string, error long, codebooks_sha256 string")


def compress(vectors: DataFrame, entries: int = ENTRIES, parts: int = PARTS, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) for every row of ``vectors``."""
    coded = durable(encode(*train(vectors, entries, parts, rounds), parts))
    per_label = durable(coded.groupBy("label").agg(F.sum("error").alias("label_error")))
    return (
        coded.alias("c")
        .join(small_side(per_label).alias("l"), F.expr("c.label <=> l.label"))
        .select("c.*", "l.label_error")
    )
