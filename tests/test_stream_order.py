"""The cadence check on a stream, whatever chunks and micro-batches the rows come in."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from helpers import COLS, at

from sievewatt.sources import sinks
from sievewatt.streaming import checks, ingest

SCHEMA = "household_id string, timestamp timestamp, energy_kwh double, arrival bigint"
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2",
    "spark.sql.shuffle.partitions": "3",
}


@pytest.fixture
def small_chunks(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def plain(rows):
    """Judge the rows one by one in order of arrival."""
    latest, out = {}, []
    for h, m, arrival in sorted(rows, key=lambda r: (r[2], r[1])):
        seen = latest.get(h)
        diff = None if seen is None else m - seen
        kind = "ok" if seen is None or diff == 30 else "duplicate" if diff == 0 else "late" if diff < 0 else "gap"
        latest[h] = m if seen is None else max(seen, m)
        out.append((h, m, kind))
    return sorted(out)


@pytest.mark.parametrize("run_rows,piece_rows", [(checks.RUN_ROWS, checks.PIECE_ROWS), (7, 3)])
def test_order_does_not_depend_on_chunks(small_chunks, folder, run_rows, piece_rows):
    spark, rng = small_chunks, random.Random(1)
    rows = [("steady", 30 * i, i) for i in range(60)] + [("odd", rng.choice([30 * i, 30 * i, 30 * i + 7, 0]), i) for i in range(40)]
    for part in range(2):  # arrivals of the first file precede those of the second
        own = [r for r in rows if (r[2] >= 25) == bool(part)]
        rng.shuffle(own)
        data = [(h, at(m), 1.0, a) for h, m, a in own]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    judged = checks.stream_cadence(stream, COLS, 30, 1, run_rows=run_rows, piece_rows=piece_rows)
    ingest.write_stream(judged, f"{folder}/out", f"{folder}/check", trigger=None).awaitTermination()
    got = sorted((r["household_id"], int((r["timestamp"] - at(0)).total_seconds() // 60), r["cadence"]) for r in sinks.read_parts(spark, f"{folder}/out").collect())
    assert got == plain(rows)


class Kept:
    """State held in dictionaries."""

    def __init__(self):
        self.values, self.single = {}, None

    def getValueState(self, *_):
        return self

    def getMapState(self, *_):
        return Pieces()

    def exists(self):
        return self.single is not None

    def get(self):
        return self.single

    def update(self, value):
        self.single = value


class Pieces:
    def __init__(self):
        self.held, self.most = {}, 0

    def updateValue(self, key, value):
        self.held[key] = value

    def getValue(self, key):
        return self.held[key]

    def clear(self):
        self.most, self.held = len(self.held), {}


def test_an_entity_of_two_million_rows_is_judged_in_bounded_memory():
    n, chunk = 2_000_000, 10_000
    order = np.random.default_rng(2).permutation(n)

    def chunks():
        for at in range(0, n, chunk):
            arrival = order[at : at + chunk].astype(np.int64)
            # every 1000th reading is two days behind, every 500th comes twice
            us = (arrival - (arrival % 500 == 0)) * 1_800_000_000 - np.where(arrival % 1000 == 1, 172_800_000_000, 0)
            yield pd.DataFrame({"id": "hot", "us": us, "arrival": arrival})

    judge = checks._Cadence(["id"], 30, 1, checks.RUN_ROWS, checks.PIECE_ROWS, False)
    judge.init(Kept())
    counts, rows = Counter(), 0
    tracemalloc.start()
    for out in judge.handleInputRows(("hot",), chunks(), None):
        counts.update(out["cadence"])
        rows += len(out)
    stored = sum(len(v[0]) for v in judge.pieces.held.values())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == n and stored == 0 and judge.pieces.most > n // checks.PIECE_ROWS
    # the store itself (16 bytes a row) lies in this test's memory; the processor adds a few MB to it
    assert peak < 16 * n + 30e6
    assert counts["late"] == n // 1000 and counts["duplicate"] == n // 500 - 1


def test_state_of_a_silent_entity_is_dropped(small_chunks, folder):
    spark = small_chunks
    day = 24 * 60
    parts = [[("a", 0, 0), ("b", 0, 1)], [("b", 9 * day, 2)], [("b", 9 * day + 30, 3)], [("a", 9 * day + 30, 4), ("b", 9 * day + 90, 5)]]
    for part in parts:
        data = [(h, at(m), 1.0, a) for h, m, a in part]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    judged = checks.stream_cadence(stream, COLS, 30, 1, watermark="2 days")
    ingest.write_stream(judged, f"{folder}/out", f"{folder}/check", trigger=None).awaitTermination()
    got = sorted((r["household_id"], int((r["timestamp"] - at(0)).total_seconds() // 60), r["cadence"]) for r in sinks.read_parts(spark, f"{folder}/out").collect())
    # a's state went when the watermark passed it, so its return is no gap; b was forgotten only after its own return
    assert [g for g in got if g[0] == "a"] == [("a", 0, "ok"), ("a", 9 * day + 30, "ok")]
    assert [g for g in got if g[0] == "b"] == [("b", 0, "ok"), ("b", 9 * day, "gap"), ("b", 9 * day + 30, "ok"), ("b", 9 * day + 90, "gap")]
