"""Similarity join on sets by PartEnum signatures, and the classes of linked documents.

Two sets r, s with Jaccard similarity of at least ``percent`` differ in at most
``(|r| + |s|) * (100 - percent) / (100 + percent)`` elements. Sets are put into bands of similar size, so that
linked sets are in the same or in adjacent bands, and each set takes part in its own band and the next. The
64-bit domain of shingles is cut into ``n`` equal parts, more than a band's sets may differ in; a set's
*token* for a part is the part's number and all the set's elements in it. Sets that differ in ``h`` elements
agree on ``n - h`` tokens or more, so of any common order of all tokens it is enough to enumerate a set's first
``h + 1``: linked sets share one of these signatures. The order puts tokens first that hold many elements which
are not frequent in the corpus, so that common passages seldom make a signature; it changes only what is
compared, never the result.

Signatures meet by hash. The members of a signature form a group around their smallest key (the leader);
the groups of one leader are united. First a sketch of each member is brought to the group, the counts of its
elements in bins: the difference of two sketches is a lower bound of the sets' difference, so members that are
too far from all others leave. Then the sets of those that stay are brought, and all their pairs are checked,
again by the bound and then exactly. A group gives links that span its classes, not all pairs. A group too large
for one task is taken apart by the same signatures with another cut of the domain. One that no cut makes small
enough is dealt into blocks of bounded size: first each block is checked in itself, with some members that go to
all blocks; then all that is not in the group's largest class so far is checked block by block against everything
else. Copies (equal sets) are one set from the start, and each task names a set once.

Linked pairs connect to classes by label propagation with pointer jumping over checkpointed tables.

Defined results: a null, empty or blank text has an empty set and is linked with nothing, not even with other
empty ones; equal sets are linked; repeated rows are copies; a null id never becomes a class id unless the
whole class has none; no rows give no rows. Sets are told apart by 64 bits of a hash of all elements.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewatt.llm.common import bounded_batches, durable, lean, small_side
from sievewatt.llm.shingles import WIDTH, mix, sets_of

PERCENT = 75
# Parts of the domain per element that sets of a band may differ in.
FINENESS = 2.5
# An element is called frequent from this many documents of one task on; a hint for the order of tokens.
FREQUENT = 8
# So many frequent elements are shipped at most (8 MB), those of the most documents first.
MOST_FREQUENT = 1_000_000
TOKENS_PER_GROUP = 500_000
LEAST_GROUPS = 64
FLUSH = 1 << 20
# A group of more members, or more elements in all, is split by another cut of the domain.
GROUP_MEMBERS = 4096
GROUP_ELEMENTS = 6_000_000
LEVELS = 3
# Of a group in blocks, one block's members over this number go to every block.
EVERYWHERE = 16
BINS_PER_ELEMENT = 1.0

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Bands:
    """Size bands and the number of parts in each, for one similarity."""

    percent: int
    starts: tuple[int, ...]

    @staticmethod
    def of(percent: int) -> Bands:
        starts = [1]
        while starts[-1] < 1 << 40:
            starts.append(starts[-1] * 100 // percent + 1)
        return Bands(percent, tuple(starts))

    def differ(self, sizes: int) -> int:
        """Most elements in which two linked sets of together ``sizes`` elements differ."""
        return sizes * (100 - self.percent) // (100 + self.percent)

    def uses(self, size: int) -> Iterator[tuple[int, int, int]]:
        """(band, parts, signatures) for a set of this size."""
        own = int(np.searchsorted(self.starts, size, side="right")) - 1
        largest = size * 100 // self.percent
        for band in (own, own + 1):
            top = self.starts[band + 1] - 1
            if largest < self.starts[band]:
                continue
            k = self.differ(2 * top)
            parts = max(math.ceil(FINENESS * k), k + 1) + 4 * (k <= 8)
            yield band, parts, self.differ(size + min(top, largest)) + 1


def signatures(s: np.ndarray, frequent: np.ndarray, bands: Bands, seed: int = 0) -> np.ndarray:
    """The hashes of a set's signatures; ``s`` is sorted and holds no element twice."""
    if seed:
        s = np.sort(mix(s + _A * np.uint64(seed)))
    rare = np.ones(len(s), np.int64)
    if len(frequent) and not seed:
        at = np.searchsorted(frequent, s)
        at[at == len(frequent)] = 0
        rare = (frequent[at] != s).astype(np.int64)
    hashed = mix(s)
    out = []
    for band, parts, wanted in bands.uses(len(s)):
        part = ((s >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        cut = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        place = part[cut] * _A + np.uint64(band) * _B + np.uint64(seed)
        token = mix(np.add.reduceat(hashed, cut) + place)
        if len(token) > wanted:
            size = np.diff(np.append(cut, len(s)))
            strength = np.minimum(np.add.reduceat(rare, cut), 255) * 256 + np.minimum(size, 255)
            order = (np.uint64(0xFFFF) - strength.astype(np.uint64) << np.uint64(48)) | (token >> np.uint64(16))
            token = token[np.argpartition(order, wanted - 1)[:wanted]]
        elif len(token) < wanted:
            # only very small sets: parts without an element are tokens too, and come last
            bare = np.setdiff1d(np.arange(parts, dtype=np.uint64), part)
            bare = np.sort(mix(bare * _A + np.uint64(band) * _B + np.uint64(seed + 77)))
            token = np.concatenate((token, bare[: wanted - len(token)]))
        out.append(token)
    return np.concatenate(out)


def sketch(s: np.ndarray) -> bytes:
    """Counts (15 at most) of a set's elements in bins, a power of two of them, two counts to a byte."""
    bins = 1 << max(4, int(len(s) // 2).bit_length())
    counts = np.minimum(np.bincount((s % np.uint64(bins)).astype(np.int64), minlength=bins), 15).astype(np.uint8)
    return (counts[: bins // 2] | counts[bins // 2 :] << 4).tobytes()


def _counts(raw: bytes, bins: int) -> np.ndarray:
    """The counts in a sketch, in the first ``bins`` bins, a smaller power of two: bins that fall together add up."""
    packed = np.frombuffer(raw, np.uint8)
    full = np.concatenate((packed & 15, packed >> 4)).astype(np.int16)
    return full.reshape(-1, bins).sum(0, dtype=np.int16)


def _staying(percent: int):
    """Of each group, the members whose sketch is near enough to another's; to one of another ``label`` where there
    are labels."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("n")
        sizes, raw = table["n"].to_numpy(), table["sketch"].to_pylist()
        bins = 2 * min(map(len, raw))
        counts = np.stack([_counts(r, bins) for r in raw])
        label = table["label"].to_numpy() if "label" in table.column_names else np.arange(len(sizes))
        stays = np.zeros(len(sizes), bool)
        for i in range(len(sizes) - 1):
            end = int(np.searchsorted(sizes, sizes[i] * 100 // percent, side="right"))
            others = np.arange(i + 1, end)
            others = others[label[others] != label[i]]
            if stays[i]:
                others = others[~stays[others]]
            for at in range(0, len(others), 1024):
                j = others[at : at + 1024]
                apart = np.abs(counts[j] - counts[i]).sum(1, dtype=np.int64)
                near = j[apart * (100 + percent) <= (sizes[j] + sizes[i]) * (100 - percent)]
                stays[near] = True
                stays[i] |= len(near) > 0
        return table.filter(pa.array(stays)).select(["lead", "key", "row"])

    return run


class Seen:
    """Which keys a task has met lately: of a bounded number, so that a copy may be taken for new, which only costs."""

    def __init__(self, most: int = 1 << 17):
        self.most, self.keys = most, set()

    def first(self, key: int) -> bool:
        if key in self.keys:
            return False
        if len(self.keys) >= self.most:
            self.keys.clear()
        self.keys.add(key)
        return True


def set_key(s: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(mix(np.array([np.add.reduce(mix(s ^ _B)) + np.uint64(len(s))], np.uint64)).view(np.int64)[0])


def _measured(width: int):
    """(id, row, n, key) per document, and at the end of a task its frequent elements with id null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Seen()
        held, size = [], 0
        often_h, often_n = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def close() -> None:
            nonlocal held, size, often_h, often_n
            h, n = np.unique(np.concatenate(held), return_counts=True)
            often_h, at = np.unique(np.concatenate((often_h, h[n > 1])), return_inverse=True)
            often_n = np.bincount(at, np.concatenate((often_n, n[n > 1])), len(often_h)).astype(np.int64)
            if len(often_h) > MOST_FREQUENT:
                kept = np.sort(np.argsort(-often_n, kind="stable")[: MOST_FREQUENT // 2])
                often_h, often_n = often_h[kept], often_n[kept]
            held, size = [], 0

        for batch in batches:
            n, key, drawn = [], [], []
            for s in sets_of(batch.column("text").to_pylist(), width):
                n.append(len(s))
                key.append(set_key(s) if len(s) else None)
                drawn.append(sketch(s) if len(s) else None)
                if len(s) and seen.first(key[-1]):
                    held.append(s)
                    size += len(s)
                    if size > FLUSH:
                        close()
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("id"),
                    "row": batch.column("row").cast(pa.string()),
                    "n": pa.array(n, pa.int64()),
                    "key": pa.array(key, pa.int64()),
                    "sketch": pa.array(drawn, pa.binary()),
                    "frequent": pa.nulls(len(n), pa.int64()),
                }
            )
        if held:
            close()
        if len(often_h):
            h, n = often_h[often_n >= FREQUENT], often_n[often_n >= FREQUENT]
            yield pa.RecordBatch.from_pydict(
                {
                    "id": pa.nulls(len(h), pa.int64()),
                    "row": pa.nulls(len(h), pa.string()),
                    "n": pa.array(n),
                    "key": pa.nulls(len(h), pa.int64()),
                    "sketch": pa.nulls(len(h), pa.binary()),
                    "frequent": pa.array(h.view(np.int64)),
                }
            )

    return run


def _dealt(groups: int, token: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
    """One row per group: six bytes of each token, and the keys with the number of tokens of each."""
    group = (token % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    group, token, key = group[order], token[order], key[order]
    short = (token // np.uint64(groups)).view(np.uint8).reshape(-1, 8)[:, :6]
    cut = np.flatnonzero(np.diff(group, prepend=-1))
    rows: dict[str, list] = {"g": [], "tokens": [], "keys": [], "counts": []}
    for a, b in zip(cut, np.append(cut[1:], len(group)), strict=True):
        own = key[a:b]
        at = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        rows["g"].append(int(group[a]))
        rows["tokens"].append(short[a:b].tobytes())
        rows["keys"].append(own[at].tobytes())
        rows["counts"].append(np.diff(np.append(at, b - a)).astype(np.uint32).tobytes())
    types = {"g": pa.int32(), "tokens": pa.binary(), "keys": pa.binary(), "counts": pa.binary()}
    return pa.RecordBatch.from_pydict({c: pa.array(v, types[c]) for c, v in rows.items()})


DEALT = "g int, tokens binary, keys binary, counts binary"


def _emitted(groups: int, frequent, width: int, percent: int):
    bands = Bands.of(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, seen = frequent.value, Seen()
        tokens, keys, size = [], [], 0
        for batch in batches:
            for s in sets_of(batch.column("text").to_pylist(), width):
                if not len(s) or not seen.first(key := set_key(s)):
                    continue
                with np.errstate(over="ignore"):
                    tokens.append(signatures(s, often, bands))
                keys.append(np.full(len(tokens[-1]), key))
                size += len(tokens[-1])
                if size > FLUSH:
                    yield _dealt(groups, np.concatenate(tokens), np.concatenate(keys))
                    tokens, keys, size = [], [], 0
        if tokens:
            yield _dealt(groups, np.concatenate(tokens), np.concatenate(keys))

    return run


def _split(groups: int, percent: int, seed: int):
    """Signatures of members of a group too large, by another cut, apart from all other groups."""
    bands = Bands.of(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, keys = [], []
            for lead, key, raw in zip(*(batch.column(c).to_pylist() for c in ("lead", "key", "elements")), strict=True):
                with np.errstate(over="ignore"):
                    own = signatures(np.frombuffer(raw, np.uint64), np.zeros(0, np.uint64), bands, seed)
                    tokens.append(mix(own + np.array([lead]).view(np.uint64) * _B))
                keys.append(np.full(len(own), key))
            if tokens:
                yield _dealt(groups, np.concatenate(tokens), np.concatenate(keys))

    return run


def _met(table: pa.Table) -> pa.Table:
    """Distinct (lead, key) of the signatures that two or more sets of the group have in common."""
    blank = np.zeros((0, 6), np.uint8)
    raw = [np.frombuffer(t, np.uint8).reshape(-1, 6) for t in table["tokens"].to_pylist()]
    token = np.zeros((sum(map(len, raw)), 8), np.uint8)
    token[:, :6] = np.concatenate(raw or [blank])
    token = token.view(np.uint64).ravel()
    key = np.concatenate(
        [
            np.repeat(np.frombuffer(k, np.int64), np.frombuffer(c, np.uint32))
            for k, c in zip(table["keys"].to_pylist(), table["counts"].to_pylist(), strict=True)
        ]
        or [np.zeros(0, np.int64)]
    )
    order = np.argsort(token, kind="stable")
    token, key = token[order], key[order]
    same = np.concatenate((token[1:] == token[:-1], [False]))
    kept = same | np.concatenate(([False], same[:-1]))  # signatures seen more than once
    token, key = token[kept], key[kept]
    order = np.lexsort((key, token))
    token, key = token[order], key[order]
    first = np.concatenate(([True], token[1:] != token[:-1])) if len(token) else np.zeros(0, bool)
    at = np.flatnonzero(first)
    lead = np.repeat(key[at], np.diff(np.append(at, len(token))))
    pairs = np.unique(np.stack((lead, key), 1)[lead != key], axis=0).reshape(-1, 2)
    return pa.table({"lead": pa.array(pairs[:, 0]), "key": pa.array(pairs[:, 1])})


def linked(r: np.ndarray, s: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(r, s, assume_unique=True))
    return 100 * both >= percent * (len(r) + len(s) - both)


def spanning_links(keys: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect all linked sets of one group; every pair is checked or already connected."""
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    sets, sizes, keys = [sets[i] for i in order], sizes[order], keys[order]
    bins = int(min(2048, max(64, BINS_PER_ELEMENT * np.median(sizes))))
    counts = np.zeros((len(sets), bins), np.int16)
    for i, s in enumerate(sets):
        counts[i] = np.minimum(np.bincount((s % np.uint64(bins)).astype(np.int64), minlength=bins), 32767)
    out = []
    for i in range(len(sets) - 1):
        end = int(np.searchsorted(sizes, sizes[i] * 100 // percent, side="right"))
        for a in range(i + 1, end, 1024):
            b = min(end, a + 1024)
            apart = np.abs(counts[a:b] - counts[i]).sum(1, dtype=np.int64)
            close = apart * (100 + percent) <= (sizes[a:b] + sizes[i]) * (100 - percent)
            for j in np.flatnonzero(close) + a:
                x, y = find(i), find(int(j))
                if x != y and linked(sets[i], sets[j], percent):
                    root[max(x, y)] = min(x, y)
                    out.append((int(keys[i]), int(keys[j])))
    return out


def _checked(percent: int):
    def run(table: pa.Table) -> pa.Table:
        sets = [np.frombuffer(b, np.uint64) for b in table["elements"].to_pylist()]
        links = spanning_links(table["key"].to_numpy(), sets, percent)
        return pa.table({c: pa.array([x[i] for x in links], pa.int64()) for i, c in enumerate(("a", "b"))})

    return run


def _carried(width: int):
    """A row for each group that a needed document is in, with its elements."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leads = batch.column("leads").to_pylist()
            keys = batch.column("key").to_pylist()
            rows: dict[str, list] = {"lead": [], "key": [], "elements": []}
            for i, s in enumerate(sets_of(batch.column("text").to_pylist(), width)):
                if not len(s) or set_key(s) != keys[i]:  # a repeated id may come with another text
                    continue
                raw = s.tobytes()
                for lead in leads[i]:
                    rows["lead"].append(lead)
                    rows["key"].append(keys[i])
                    rows["elements"].append(raw)
                if len(rows["lead"]) >= 256:
                    yield _rows(rows)
                    rows = {c: [] for c in rows}
            yield _rows(rows)

    return run


def _rows(rows: dict[str, list]) -> pa.RecordBatch:
    types = {"lead": pa.int64(), "key": pa.int64(), "elements": pa.binary()}
    return pa.RecordBatch.from_pydict({c: pa.array(v, types[c]) for c, v in rows.items()})


CARRIED = "lead long, key long, elements binary"


def measured(docs: DataFrame, text_col: str, id_col: str, width: int) -> DataFrame:
    """(id, row, n, key, sketch, frequent): the set size, key and sketch of every document, and frequent elements."""
    bounded_batches(docs.sparkSession)
    wanted = _named(docs, text_col, id_col)
    return durable(wanted.mapInArrow(lean(_measured(width)), "id long, row string, n long, key long, sketch binary, frequent long"))


def _named(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """(id, row, text): ``row`` finds a document again, also one without an id or with another's id."""
    id_, text = F.col(id_col).cast("long"), F.col(text_col)
    return docs.select(id_.alias("id"), _row(id_, text).alias("row"), text.alias("text"))


def _row(id_: Column, text: Column) -> Column:
    return F.concat_ws(" ", F.coalesce(id_.cast("string"), F.lit("null")), F.xxhash64(text).cast("string"))


def links(docs: DataFrame, found: DataFrame, text_col: str, id_col: str, width: int, percent: int) -> DataFrame:
    """(a, b): links between set keys that span every class. ``found`` is what :func:`measured` gives."""
    spark = docs.sparkSession
    often = (
        found.filter("frequent IS NOT NULL").groupBy("frequent").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "frequent").limit(MOST_FREQUENT).select("frequent")
    )
    frequent = np.array([r[0] for r in often.collect()], np.int64).view(np.uint64)
    elements = found.filter("key IS NOT NULL").agg(F.sum("n")).first()[0] or 0
    groups = max(LEAST_GROUPS, int(elements * 0.65) // TOKENS_PER_GROUP)
    shipped = spark.sparkContext.broadcast(np.sort(frequent))
    wanted = _named(docs, text_col, id_col).select("row", "text")
    dealt = wanted.select("text").mapInArrow(lean(_emitted(groups, shipped, width, percent)), DEALT)
    stars = durable(dealt.groupBy("g").applyInArrow(_met, "lead long, key long").distinct())
    # one document stands for each set
    named = found.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("row").alias("row"), F.max("n").alias("n"), F.max("sketch").alias("sketch")
    )
    again = durable(found.filter("key IS NOT NULL").groupBy("row").count().filter("count > 1").select("row"))
    return _verified(_once(wanted, again), named, stars, width, percent)


def _once(wanted: DataFrame, again: DataFrame) -> DataFrame:
    """``wanted`` with one text for each ``row``; ``again`` has those that repeat."""
    if again.isEmpty():
        return wanted
    side = small_side(again)
    return wanted.join(side, "row", "left_anti").unionByName(wanted.join(side, "row", "left_semi").dropDuplicates(["row"]))


def _verified(wanted: DataFrame, named: DataFrame, stars: DataFrame, width: int, percent: int) -> DataFrame:
    out = None
    for level in range(LEVELS):
        members = stars.unionByName(stars.select("lead", F.col("lead").alias("key")).distinct())
        sized = durable(members.join(named, "key").select("lead", "key", "row", "n", "sketch"))
        blocks = _blocks(F.count("*"), F.sum("n"))
        large = sized.groupBy("lead").agg(F.count("*").alias("m"), F.sum("n").alias("e"), blocks.alias("blocks"))
        large = durable(large.filter((F.col("m") > GROUP_MEMBERS) | (F.col("e") > GROUP_ELEMENTS)).select("lead", "blocks"))
        none = large.isEmpty()
        small = sized if none else sized.join(small_side(large), "lead", "left_anti")
        checked = _compared(wanted, small, width, percent)
        out = checked if out is None else out.unionByName(checked)
        if none:
            break
        if level == LEVELS - 1:
            out = out.unionByName(_in_blocks(wanted, sized.join(small_side(large), "lead"), width, percent))
            break
        rest = _carry(wanted, sized.join(small_side(large), "lead", "left_semi"), width)
        n = sized.join(small_side(large), "lead", "left_semi").agg(F.sum("n")).first()[0] or 0
        groups = max(LEAST_GROUPS, int(n * 0.65) // TOKENS_PER_GROUP)
        dealt = rest.mapInArrow(lean(_split(groups, percent, level + 1)), DEALT)
        stars = durable(dealt.groupBy("g").applyInArrow(_met, "lead long, key long").distinct())
    return out


def _compared(wanted: DataFrame, members: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b): links between the members of each ``lead``, which go to one task."""
    staying = durable(members.groupBy("lead").applyInArrow(_staying(percent), "lead long, key long, row string"))
    checked = _carry(wanted, staying, width).groupBy("lead").applyInArrow(_checked(percent), "a long, b long")
    return durable(checked.distinct())


def _blocks(members: Column, elements: Column) -> Column:
    """So many blocks that two of them are about as large as a group may be."""
    return F.greatest(F.ceil(2 * members / GROUP_MEMBERS), F.ceil(2 * F.coalesce(elements, F.lit(0)) / GROUP_ELEMENTS)).cast("long")


def _in_blocks(wanted: DataFrame, members: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b): links in groups too large for one task, with the number of ``blocks`` of each; no pair is left out
    unless both are connected already."""
    slim = ["key", "row", "n", "sketch"]
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    block = lambda n: F.pmod(F.xxhash64("key"), F.col(n))
    shared = (F.col("key") == F.col("lead")) | (F.pmod(F.xxhash64("key", F.lit(1)), F.col("blocks") * EVERYWHERE) == 0)
    placed = members.withColumn("b", F.explode(F.when(shared, upto("blocks")).otherwise(F.array(block("blocks")))))
    first = _compared(wanted, placed.select(F.xxhash64("lead", "b").alias("lead"), *slim), width, percent)

    labels = components(first).withColumnRenamed("node", "key")
    told = durable(members.join(labels, "key", "left").select("lead", *slim, F.coalesce("label", "key").alias("label")))
    main = told.groupBy("lead", "label").count().groupBy("lead").agg(F.max(F.struct("count", "label"))["label"].alias("main"))
    told = durable(told.join(small_side(durable(main)), "lead").withColumn("apart", F.col("label") != F.col("main")))
    sizes = [_blocks(F.count_if(c), F.sum(F.when(c, F.col("n")))).alias(n) for n, c in (("rest", F.col("apart")), ("most", ~F.col("apart")))]
    told = told.join(small_side(durable(told.groupBy("lead").agg(*sizes).filter("rest > 0"))), "lead")

    def pairs(rows: DataFrame, other: str, kind: int, i: Column, j: Column, label: Column) -> DataFrame:
        each = rows.withColumn("o", F.explode(upto(other)))
        return each.select(F.xxhash64("lead", F.lit(kind), i, j).alias("lead"), *slim, label.cast("long").alias("label"))

    rest, most, o = told.filter("apart"), told.filter(~F.col("apart")), F.col("o")
    met = (
        pairs(rest, "rest", 0, F.least(block("rest"), o), F.greatest(block("rest"), o), F.col("label"))
        .unionByName(pairs(rest, "most", 1, block("rest"), o, F.lit(0)))
        .unionByName(pairs(most, "rest", 1, o, block("most"), F.lit(1)))
    )
    return first.unionByName(_compared(wanted, met, width, percent))


def _carry(wanted: DataFrame, members: DataFrame, width: int, most: int = 500_000) -> DataFrame:
    """Members with their elements, made again from the texts of the documents that stand for them."""
    needed = members.groupBy("row", "key").agg(F.collect_list("lead").alias("leads"))
    few = members.limit(most + 1).count() <= most
    texts = wanted.join(F.broadcast(needed) if few else needed, "row")
    return texts.select("text", "key", "leads").mapInArrow(lean(_carried(width)), CARRIED)


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of ``edges`` (a, b) is connected to."""
    both = durable(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = durable(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")))
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("m"))
        )
        step = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("label").alias("was"), F.least("label", "m").alias("label")
        )
        ahead = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        moved = durable(step.join(ahead, "label").select("node", F.least("label", "next").alias("label"), "was"))
        if moved.filter("label <> was").isEmpty():
            return moved.select("node", "label")
        labels = moved.select("node", "label")


def join(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(id, row, n, key, class_id, class_row) for every row of ``docs``: set size, set key, and the smallest id of its
    class with the ``row`` of the document that has it."""
    found = measured(docs, text_col, id_col, width)
    rows = found.filter("frequent IS NULL").select("id", "row", "n", "key")
    pairs = links(docs, found, text_col, id_col, width, percent)
    named = rows.filter("key IS NOT NULL").groupBy("key").agg(
        F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "row")).alias("first"), F.count("*").alias("copies")
    )
    labels = durable(components(pairs).join(named, F.col("node") == F.col("key")).select("key", "label", "first"))
    smallest = labels.groupBy("label").agg(F.min("first").alias("class"))
    classes = labels.join(smallest, "label").select("key", "class")
    known = durable(
        named.filter("copies > 1").select("key", "first").join(classes, "key", "full")
        .select("key", F.coalesce("class", "first").alias("class"))
    )
    return rows.join(known, "key", "left").select(
        "id", "row", "n", "key", F.coalesce("class.id", "id").alias("class_id"), F.coalesce("class.row", "row").alias("class_row")
    )


def one_of_each(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each class, that of the smallest id, once; all columns stay. Documents with an
    empty set are linked with nothing and stay."""
    classes = durable(join(docs, text_col, id_col, width, percent).filter("key IS NOT NULL"))
    chosen = F.col("row") == F.col("class_row")
    gone = durable(classes.filter(~chosen).select("row").distinct())
    again = durable(classes.filter(chosen).groupBy("row").count().filter("count > 1").select("row"))
    by_row = _row(F.col(f"d.{id_col}"), F.col(f"d.{text_col}"))
    kept = docs.alias("d").join(small_side(gone).alias("g"), by_row == F.col("g.row"), "left_anti")
    if again.isEmpty():
        return kept
    # rows that repeat a chosen one: one of them stays
    side = small_side(again).alias("a")
    single = kept.alias("d").join(side, by_row == F.col("a.row"), "left_anti")
    return single.unionByName(kept.alias("d").join(side, by_row == F.col("a.row"), "left_semi").dropDuplicates([id_col, text_col]))
