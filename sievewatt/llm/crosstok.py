"""Align the tokens of two tokenizers on the bytes of one text.

Both tokenizers cut the same bytes, so each token is a byte range. Per batch the ranges of all documents go into
two pandas frames, and ``merge_asof``, keyed by document, finds for each token's start the other side's token that
covers it; two ranges overlap exactly if one of them starts inside the other, so both directions together are all
overlaps. Where tokens of both sides end at the same byte, the text falls into groups that can be swapped for each
other.

How many documents hold a pair of ids is counted over the whole corpus. Every document carries its different pairs
with their numbers; these are matched with the counts by a broadcast of the pair table while that is small
(:data:`MOST_PAIRS`, counted first), and beyond that in slabs of first ids, each slab small enough to be broadcast.
No pair, however frequent, is a shuffle key of the documents.

Long texts are tokenized in pieces, cut before a single space between two other characters. Neither tokenizer makes a
token across such a place (the second one's vocabulary is checked for it, else texts stay whole), so the tokens
are those of the whole text. The byte-level vocabulary is read by two libraries: the faster one gets the texts
whose characters all have long been in Unicode, where both cut words alike, the other one the rest.

Defined results: a null or empty text, and one whose tokens do not give back its bytes on either side (special
white space marks, for instance), has no tokens, zeros and empty groups; repeated rows count as documents each, null
ids included; no rows give no rows. Special tokens' strings are ordinary text.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewatt.llm.common import bounded_batches, lean, slices_of
from sievewatt.runtime import scratch_path

FOLDER = "/opt/tokenizers"
BYTE_FILE = "byte_bpe_50k.json"
PIECE_FILE = "piece_bpe_32k.model"
# Characters after which a long text is cut, and those whose tokens are in memory at a time.
PIECE_CHARS = 1 << 16
SLICE_CHARS = 1 << 19
# Rows of pairs in one broadcast.
MOST_PAIRS = 2_000_000

SPACE_MARK = "▁"
CUT = re.compile(r"(?<=\S) (?=\S)")
# How a byte-level vocabulary's words are cut (fixed value), and characters whose classes have not changed in decades.
WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
OLD_CHARACTERS = re.compile("[\x00-\u021f\u0391-\u03a1\u03a3-\u03ce\u0410-\u044f\u2010-\u2029\u20ac\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5]*")
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
ALIGNED = (
    "doc_id {id}, n_a long, n_b long, n_groups long, n_links long, groups string, groups_sha256 string, "
    "pairs array<bigint>, times array<int>"
)


@dataclass
class Side:
    """One tokenizer: ids of texts, and the bytes of each id."""

    encode: object
    pieces: list[bytes]
    cuttable: bool

    def __post_init__(self):
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        self.inside = np.array([f"{i}," for i in range(len(self.pieces))], object)
        self._closing: dict[str, np.ndarray] = {}

    def closing(self, mark: str) -> np.ndarray:
        if mark not in self._closing:
            self._closing[mark] = np.array([f"{i}{mark}" for i in range(len(self.pieces))], object)
        return self._closing[mark]


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones themselves, others from 256."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(others)}


def byte_side(path: str) -> Side:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    letters = byte_letters()
    pieces, ranks = [], {}
    for i in range(tokenizer.get_vocab_size()):
        token = tokenizer.id_to_token(i) or ""
        plain = all(c in letters for c in token) and i not in tokenizer.get_added_tokens_decoder()
        pieces.append(bytes(letters[c] for c in token) if plain else token.encode())
        if plain:
            ranks[pieces[-1]] = i
    with open(path, encoding="utf-8") as file:
        merges = json.load(file)["model"]["merges"]
    # ids in order of merges are what the faster library takes for granted
    made = ["".join(m if isinstance(m, list) else m.split(" ")) for m in merges]
    ordered = [tokenizer.token_to_id(m) for m in made]
    fast = tiktoken.Encoding("byte-level", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
    usable = ordered == sorted(ordered)

    def encode(texts: list[str]) -> list[list[int]]:
        known = [usable and bool(OLD_CHARACTERS.fullmatch(t)) for t in texts]
        rest = [" " + t for t, k in zip(texts, known, strict=True) if not k]
        others = iter(tokenizer.encode_batch(rest, add_special_tokens=False) if rest else [])
        return [fast.encode_ordinary(" " + t) if k else next(others).ids for t, k in zip(texts, known, strict=True)]

    return Side(encode, pieces, True)


def piece_side(path: str) -> Side:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.vocab_size())]

    def held(i: int, name: str) -> bytes:
        byte = BYTE_PIECE.fullmatch(name) if model.is_byte(i) else None
        return bytes([int(byte[1], 16)]) if byte else name.replace(SPACE_MARK, " ").encode()

    # no piece may hold a space mark after another character
    cuttable = not any(SPACE_MARK in name.lstrip(SPACE_MARK) for name in names)
    return Side(lambda texts: model.encode(texts, num_threads=1), [held(i, n) for i, n in enumerate(names)], cuttable)


@lru_cache(maxsize=1)
def sides(folder: str, byte_file: str, piece_file: str) -> tuple[Side, Side]:
    return byte_side(os.path.join(folder, byte_file)), piece_side(os.path.join(folder, piece_file))


def cut(text: str, most: int = PIECE_CHARS) -> list[str]:
    """The text in pieces of about ``most`` characters; the space that each but the first starts with is left out."""
    out, begin = [], 0
    while len(text) - begin > most:
        place = CUT.search(text, begin + most)
        if not place:
            break
        out.append(text[begin : place.start()])
        begin = place.start() + 1
    return [*out, text[begin:]]


def tokens(side: Side, texts: list[str], most: int = PIECE_CHARS) -> tuple[list[np.ndarray], list[bool]]:
    """Ids of every text with a space before it, and whether they give back its bytes."""
    cuts = [cut(t, most) if side.cuttable else [t] for t in texts]
    encoded = iter(side.encode([piece for of in cuts for piece in of]))
    ids, sound = [], []
    for text, of in zip(texts, cuts, strict=True):
        held = next(encoded) if len(of) == 1 else list(chain.from_iterable(next(encoded) for _ in of))
        ids.append(np.array(held, np.int64))
        sound.append(b"".join(map(side.pieces.__getitem__, held)) == b" " + text.encode())
    return ids, sound


def spans(side: Side, ids: list[np.ndarray], bases: np.ndarray) -> pd.DataFrame:
    """(doc, start, end, id, at) of all tokens; ``bases`` keep the documents of a batch apart on one line of bytes."""
    counts = [len(x) for x in ids]
    flat = np.concatenate([*ids, np.zeros(0, np.int64)])
    doc = np.repeat(np.arange(len(ids)), counts)
    ends = np.cumsum(side.lengths[flat])
    begins = ends - side.lengths[flat]
    firsts = np.concatenate([[0], np.cumsum(counts)])[:-1]
    shift = np.zeros(len(ids), np.int64)
    full = np.flatnonzero(np.array(counts) > 0)
    shift[full] = bases[full] - begins[firsts[full]]
    return pd.DataFrame(
        {"doc": doc, "start": begins + shift[doc], "end": ends + shift[doc], "id": flat, "at": np.arange(len(flat))}
    )


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``a`` and in ``b`` of every pair of tokens that share a byte, in order of documents."""
    keyed_a, keyed_b = a[["start", "doc", "at"]], b[["start", "doc", "at"]]
    covering_b = pd.merge_asof(keyed_a, keyed_b, on="start", by="doc", suffixes=("_a", "_b"))
    # tokens that start together are found by the first direction already
    covering_a = pd.merge_asof(keyed_b, keyed_a, on="start", by="doc", suffixes=("_b", "_a"), allow_exact_matches=False)
    left = np.concatenate([covering_b["at_a"].to_numpy(np.int64), covering_a["at_a"].fillna(-1).to_numpy(np.int64)])
    right = np.concatenate([covering_b["at_b"].to_numpy(np.int64), covering_a["at_b"].to_numpy(np.int64)])
    begins = b["start"].to_numpy()[right]
    real = (left >= 0) & (a["end"].to_numpy()[left] > begins) if len(a) else np.zeros(0, bool)
    left, right = left[real], right[real]
    order = np.argsort(left, kind="stable")
    return left[order], right[order]


def groups(a: pd.DataFrame, b: pd.DataFrame, n: int, named: list[np.ndarray]) -> tuple[np.ndarray, list[str]]:
    """Number of groups of each of ``n`` documents, and their text ``a1,a2|b1;a3|b2,b3``.

    ``named`` are the words for each id of ``a`` inside and at the end of a group, then those of ``b``."""
    shared = np.intersect1d(a["end"].to_numpy(), b["end"].to_numpy(), assume_unique=True)
    parts, orders, docs = [], [], []
    for side, of in enumerate((a, b)):
        end, ids = of["end"].to_numpy(), of["id"].to_numpy()
        group = np.searchsorted(shared, end)
        closing = shared[group] == end
        parts.append(np.where(closing, named[2 * side + 1][ids], named[2 * side][ids]))
        orders.append(2 * group + side)
        docs.append(of["doc"].to_numpy())
    order = np.argsort(np.concatenate(orders), kind="stable")
    words, doc = np.concatenate(parts)[order], np.concatenate(docs)[order]
    bounds = np.searchsorted(doc, np.arange(n + 1))
    texts = ["".join(words[lo:hi].tolist())[:-1] for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)]
    last = np.searchsorted(b["end"].to_numpy(), shared)
    return np.bincount(b["doc"].to_numpy()[last], minlength=n), texts


def align(texts: list[str | None], a_side: Side, b_side: Side, most: int = PIECE_CHARS) -> list[dict]:
    """One dictionary for every text with the columns of :data:`ALIGNED` but the id."""
    a_ids, a_sound = tokens(a_side, [t or "" for t in texts], most)
    b_ids, b_sound = tokens(b_side, [t or "" for t in texts], most)
    nothing = np.zeros(0, np.int64)
    for i, t in enumerate(texts):
        if not (t and a_sound[i] and b_sound[i]):
            a_ids[i] = b_ids[i] = nothing
    sizes = [int(a_side.lengths[x].sum()) for x in a_ids]
    # a byte between documents, so that no end of one is the start of the next
    bases = np.concatenate([[0], np.cumsum(np.array(sizes) + 1)])[:-1]
    a, b = spans(a_side, a_ids, bases), spans(b_side, b_ids, bases)
    left, right = overlaps(a, b)
    doc = a["doc"].to_numpy()[left]
    # one sort for all documents: document, first id, second id in one number
    n_b = len(b_side.pieces)
    every = len(a_side.pieces) * n_b
    key = np.sort(doc * every + a["id"].to_numpy()[left] * n_b + b["id"].to_numpy()[right])
    firsts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else nothing
    times = np.diff(np.concatenate([firsts, [len(key)]])).astype(np.int32)
    pair = key[firsts] % every
    pair = (pair // n_b << 32) | pair % n_b
    bounds = np.searchsorted(key[firsts], np.arange(len(texts) + 1) * every)
    n_links = np.bincount(doc, minlength=len(texts))
    n_groups, listed = groups(a, b, len(texts), [a_side.inside, a_side.closing("|"), b_side.inside, b_side.closing(";")])
    return [
        {
            "n_a": len(a_ids[i]),
            "n_b": len(b_ids[i]),
            "n_groups": int(n_groups[i]),
            "n_links": int(n_links[i]),
            "groups": listed[i],
            "groups_sha256": hashlib.sha256(listed[i].encode()).hexdigest() if listed[i] else "",
            "pairs": pair[bounds[i] : bounds[i + 1]],
            "times": times[bounds[i] : bounds[i + 1]],
        }
        for i in range(len(texts))
    ]


def aligned(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    folder: str = FOLDER,
    byte_file: str = BYTE_FILE,
    piece_file: str = PIECE_FILE,
    keep_groups: bool = True,
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, groups_sha256, pairs, times) for every row of ``docs``.

    ``pairs`` holds a document's different id pairs (first id times 2**32 plus second id), ``times`` how often each
    is linked. Without ``keep_groups`` the column ``groups`` is null.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    kinds = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups": pa.string()}
    kinds |= {"groups_sha256": pa.string(), "pairs": pa.list_(pa.int64()), "times": pa.list_(pa.int32())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_side, b_side = sides(folder, byte_file, piece_file)
        for batch in batches:
            texts = batch["text"].to_pylist()
            for lo, hi in slices_of(texts, SLICE_CHARS):
                rows = align(texts[lo:hi], a_side, b_side)
                columns = {"doc_id": batch["doc_id"].slice(lo, hi - lo)}
                for name, kind in kinds.items():
                    held = [r[name] for r in rows] if keep_groups or name != "groups" else [None] * len(rows)
                    columns[name] = pa.array(held, kind)
                yield pa.RecordBatch.from_pydict(columns)

    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(lean(run), ALIGNED.format(id=id_type))


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, docs, best): in how many documents a pair is linked, and whether no other pair of its first id is in more."""
    counts = found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs"))
    counts = counts.withColumn("a", F.shiftright("pair", 32))
    highest = counts.groupBy("a").agg(F.max("docs").alias("highest"))
    return counts.join(highest, "a").select("pair", "a", "docs", (F.col("docs") == F.col("highest")).alias("best"))


def link_counts(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", most_pairs: int = MOST_PAIRS, **files
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row of ``docs``.

    Texts are tokenized once; what later passes need is written to the shared folder.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    path, pairs_path = scratch_path(spark, "crosstok-docs"), scratch_path(spark, "crosstok-pairs")
    found = aligned(docs, text_col, id_col, keep_groups=False, **files).drop("groups")
    found.withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    found = spark.read.parquet(path)
    pair_counts(found).write.parquet(pairs_path)
    counts = spark.read.parquet(pairs_path)

    slabs = -(-counts.count() // most_pairs) or 1
    links = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l"))
    links = links.select("row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    best = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best")
    total = F.sum(F.col("docs") * F.col("times")).alias("count_sum")
    sums = None
    for s in range(slabs):
        part = counts if slabs == 1 else counts.filter(F.pmod(F.xxhash64("a"), F.lit(slabs)) == s)
        met = links.join(F.broadcast(part.select("pair", "docs", "best")), "pair").groupBy("row").agg(best, total)
        sums = met if sums is None else sums.unionAll(met)
    if slabs > 1:
        sums = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    none = F.lit(0).cast("long")
    return found.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256",
    )
