"""URL filter: a sorted array of 64-bit digests, memory-mapped by every task.

Rules are written once as one file: sorted xxhash digests, the rules' full strings and their verdicts.
Spark ships the file to each machine, where all tasks map the same pages. A batch of URLs is turned into
keys (each host suffix with each path length that a rule has), all keys are hashed and looked up by one
vectorised binary search, and a found digest counts only if the stored string is the key itself.

Defined results: a null URL, or one without ``://``, has an empty host and path and fits no rule; a path
starts with a rule's path as plain text, so a URL without a path fits no rule that ends in ``/``; repeated
rows are judged each; no rows give no rows; only the two named columns are read. Among rules that fit, the
longest string wins, then the one with the longer host. A rule given twice with both verdicts blocks.
"""

from __future__ import annotations

import mmap
import os
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewatt.llm.common import UPPER

# Rules up to this number are shipped as a file (about 60 MB); more are joined.
MAX_SHIPPED_RULES = 1_000_000

_LOWER = str.maketrans(UPPER, UPPER.lower())
_AFTER = re.compile(r"([^/?#]*)([^?#]*)")
SCHEMA = "id long, url string, host string, path string, rule string, verdict string"


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    host, path = _AFTER.match(rest).groups()
    return host.translate(_LOWER), path


def keys_of(host: str, path: str, path_lengths: list[int]) -> list[tuple[str, int]]:
    """Every rule string that could fit, longest first, with the length of its host."""
    if not host:
        return []
    suffixes = [host]
    at = host.find(".")
    while at >= 0:
        suffixes.append(host[at + 1 :])
        at = host.find(".", at + 1)
    out = [(s + path[:n], len(s)) for s in suffixes if s for n in path_lengths if n <= len(path)]
    out.sort(key=lambda k: (-len(k[0]), -k[1]))
    return out


class DigestArray:
    """Reads the file that :func:`write_rules` makes, without loading it."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self._map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        n, m = np.frombuffer(self._map, np.int64, 2)
        self.lengths = np.frombuffer(self._map, np.int64, m, 16).tolist()
        at = 16 + 8 * m
        self.digests = np.frombuffer(self._map, np.uint64, n, at)
        self.ends = np.frombuffer(self._map, np.int64, n + 1, at + 8 * n)
        self.blocked = np.frombuffer(self._map, np.uint8, n, at + 16 * n + 8)
        self._text = at + 17 * n + 8

    def find(self, keys: list[bytes]) -> np.ndarray:
        """Position of each key, or -1."""
        wanted = np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), np.uint64, len(keys))
        at = np.searchsorted(self.digests, wanted)
        out = np.full(len(keys), -1)
        near = np.flatnonzero(at < len(self.digests))
        for i in near[self.digests[at[near]] == wanted[near]]:
            j = int(at[i])
            while j < len(self.digests) and self.digests[j] == wanted[i]:  # digests may collide
                if self._map[self._text + self.ends[j] : self._text + self.ends[j + 1]] == keys[i]:
                    out[i] = j
                    break
                j += 1
        return out


def write_rules(rules: Iterable[tuple[str, str, str]], path: str) -> None:
    """Write (host, path, verdict) rules as one digest array."""
    verdicts: dict[bytes, int] = {}
    lengths = set()
    for host, rule_path, verdict in rules:
        key = (host.translate(_LOWER) + rule_path).encode()
        verdicts[key] = max(verdicts.get(key, 0), int(verdict == "block"))
        lengths.add(len(rule_path))
    ordered = sorted((xxhash.xxh64_intdigest(k), k) for k in verdicts)
    with open(path, "wb") as f:
        f.write(np.array([len(ordered), len(lengths)], np.int64).tobytes())
        f.write(np.array(sorted(lengths), np.int64).tobytes())
        f.write(np.array([d for d, _ in ordered], np.uint64).tobytes())
        f.write(np.cumsum([0] + [len(k) for _, k in ordered]).astype(np.int64).tobytes())
        f.write(np.array([verdicts[k] for _, k in ordered], np.uint8).tobytes())
        f.write(b"".join(k for _, k in ordered))


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str, str]] | DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    otherwise: str = "allow",
    max_shipped: int = MAX_SHIPPED_RULES,
) -> DataFrame:
    """``id, url, host, path, rule, verdict`` for every row of ``pages``.

    ``rules`` are (host, path, verdict) rows; a URL in none of them gets ``otherwise``.
    """
    spark = pages.sparkSession
    wanted = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"))
    if isinstance(rules, DataFrame):
        if rules.count() > max_shipped:
            return _judge_by_join(wanted, rules, otherwise)
        rules = [tuple(r) for r in rules.select("host", "path", "verdict").collect()]
    return wanted.mapInArrow(_judged(_ship(spark, rules), otherwise), SCHEMA)


def _ship(spark: SparkSession, rules: list[tuple[str, str, str]]) -> str:
    """Let Spark copy the rules' file to every executor, also to those that start later."""
    name = f"url-rules-{uuid.uuid4().hex}.bin"
    path = os.path.join(tempfile.mkdtemp(prefix="sievewatt-rules-"), name)
    write_rules(rules, path)
    spark.sparkContext.addFile(path)
    return name


def _judged(name: str, otherwise: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = DigestArray(SparkFiles.get(name))
        for batch in batches:
            urls = batch.column("url").to_pylist()
            split = [split_url(u) for u in urls]
            keys = [keys_of(h, p, index.lengths) for h, p in split]
            flat = [k for own in keys for k, _ in own]
            found = index.find([k.encode() for k in flat])
            rule: list[str | None] = [None] * len(urls)
            verdict = [otherwise] * len(urls)
            at = 0
            for i, own in enumerate(keys):
                hit = next((j for j in range(at, at + len(own)) if found[j] >= 0), None)
                if hit is not None:
                    rule[i] = flat[hit]
                    verdict[i] = "block" if index.blocked[found[hit]] else "allow"
                at += len(own)
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("id"),
                    "url": pa.array(urls, pa.string()),
                    "host": pa.array([h for h, _ in split], pa.string()),
                    "path": pa.array([p for _, p in split], pa.string()),
                    "rule": pa.array(rule, pa.string()),
                    "verdict": pa.array(verdict, pa.string()),
                }
            )

    return run


def _judge_by_join(wanted: DataFrame, rules: DataFrame, otherwise: str) -> DataFrame:
    """The same for lists too long to ship: keys meet rules in a shuffle by digest, then by full string."""
    listed = (
        rules.groupBy(F.concat(F.translate("host", UPPER, UPPER.lower()), "path").alias("key"))
        .agg(F.max(F.col("verdict") == "block").alias("blocked"))
        .withColumn("digest", F.xxhash64("key"))
    )
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().collect()]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [split_url(u) for u in batch.column("url").to_pylist()]
            keys = [[k for k, _ in keys_of(h, p, lengths)] for h, p in split]
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("id"),
                    "url": batch.column("url").cast(pa.string()),
                    "host": pa.array([h for h, _ in split], pa.string()),
                    "path": pa.array([p for _, p in split], pa.string()),
                    "keys": pa.array(keys, pa.list_(pa.string())),
                }
            )

    # one row per distinct URL carries its keys, so that a URL that repeats is looked up once
    urls = wanted.select(F.lit(0).cast("long").alias("id"), "url").distinct()
    made = urls.mapInArrow(keyed, "id long, url string, host string, path string, keys array<string>").drop("id")
    probes = made.select("url", F.posexplode("keys").alias("place", "key")).withColumn("digest", F.xxhash64("key"))
    best = (
        probes.join(listed, ["digest", "key"])
        .groupBy("url")
        .agg(F.min(F.struct("place", "key", "blocked")).alias("best"))
    )
    judged = made.drop("keys").alias("m").join(best.alias("b"), F.expr("m.url <=> b.url"), "left").select(
        F.col("m.url").alias("url"),
        "host",
        "path",
        F.col("best.key").alias("rule"),
        F.expr("CASE WHEN best IS NULL THEN NULL WHEN best.blocked THEN 'block' ELSE 'allow' END").alias("verdict"),
    )
    return wanted.alias("w").join(judged.alias("j"), F.expr("w.url <=> j.url"), "left").select(
        "id", "w.url", "host", "path", "rule", F.coalesce("verdict", F.lit(otherwise)).alias("verdict")
    )
