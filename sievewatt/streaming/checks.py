"""Quality checks that run on the stream itself."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sievewatt.config import CheckSettings, Cols
from sievewatt.functions.columns import MINUTES_PER_DAY, micros, number
from sievewatt.operators.checks import Rule, schema_rules


def stream_completeness(df: DataFrame, cols: Cols, watermark: str = "2 days", cfg: CheckSettings = CheckSettings()) -> DataFrame:
    """Completeness and rule counts per entity and day, as a windowed streaming aggregate.

    Rules that need the entity's whole history (spikes) are left to the batch checks.
    """
    v = number(cols.value)
    rules = [
        Rule("", "negative_count", v < cfg.min_value),
        Rule("", "above_max_count", v > cfg.max_value),
        *[r for r in schema_rules(df, cols, cfg.enums, cfg.value_range) if r.count != "null_timestamp_count"],
    ]
    expected = int(MINUTES_PER_DAY / cfg.interval_minutes)
    counts = (
        _event_time(df, cols)
        .filter(F.col(cols.ts).isNotNull())
        .withWatermark(cols.ts, watermark)
        .groupBy(F.window(cols.ts, "1 day").alias("_w"), *cols.entity)
        .agg(F.count(F.lit(1)).alias("actual_records"), *[F.count_if(r.when).alias(r.count) for r in rules])
    )
    return counts.select(
        *cols.entity,
        F.to_date(F.col("_w.start")).alias("score_date"),
        "actual_records",
        F.lit(expected).cast("long").alias("expected_records"),
        (1 - F.col("actual_records") / F.lit(float(expected))).alias("missing_rate"),
        *[r.count for r in rules],
    )


def _event_time(df: DataFrame, cols: Cols) -> DataFrame:
    """Watermarks need a timestamp with a zone; times without one are read in the session's."""
    return df.withColumn(cols.ts, F.col(cols.ts).cast("timestamp"))


def newest_results(updates: DataFrame, keys: Sequence[str], batch: str = "_batch_no") -> DataFrame:
    """Latest row per key of a table of streaming updates."""
    rest = [c for c in updates.columns if c not in keys]
    latest = updates.groupBy(*keys).agg(F.max(F.struct(batch, *[c for c in rest if c != batch])).alias("_r"))
    return latest.select(*keys, *[F.col("_r")[c].alias(c) for c in rest if c != batch])


def stream_dedupe(df: DataFrame, cols: Cols, watermark: str = "2 days") -> DataFrame:
    """First row per entity and time; state is dropped once the watermark has passed."""
    return _event_time(df, cols).withWatermark(cols.ts, watermark).dropDuplicatesWithinWatermark([*cols.entity, cols.ts])


# Rows of one entity that are sorted in memory at a time, and of each sorted run while runs are merged.
RUN_ROWS = 65_536
PIECE_ROWS = 4_096


class _Cadence(StatefulProcessor):
    """Keeps the latest time per entity and judges every reading in order of arrival, then of time.

    Spark hands a trigger's rows of one entity over in chunks of any size and order. They are sorted in runs of
    bounded size; only if there is more than one run do the runs go into the map state, in pieces, and are merged
    from there piece by piece and then removed. What is in memory is one run, or one piece of each run.

    With ``forget`` an event-time timer drops the latest time of an entity once the watermark has passed it.
    """

    def __init__(self, entity: Sequence[str], interval: float, tolerance: float, run_rows: int, piece_rows: int, forget: bool):
        self.entity, self.interval, self.tolerance = list(entity), interval * 6e7, tolerance * 6e7
        self.run_rows, self.piece_rows, self.forget = run_rows, piece_rows, forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", "us bigint")
        self.pieces = handle.getMapState("pieces", "run int, piece int", "rows binary")

    def handleInputRows(self, key, rows, timerValues):
        latest = self.latest.get()[0] if self.latest.exists() else None
        before = latest
        for us in self._in_order(rows):
            kind, latest = self._judged(us, latest)
            out = {name: [value] * len(us) for name, value in zip(self.entity, key, strict=True)}
            yield pd.DataFrame({**out, "_us": us, "cadence": kind})
        if latest is not None:
            self.latest.update((latest,))
        if self.forget and latest is not None and latest != before:
            if before is not None:
                self.handle.deleteTimer(before // 1000 + 1)
            self.handle.registerTimer(latest // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.latest.clear()
        return iter(())

    def _in_order(self, rows) -> Iterator[np.ndarray]:
        """The times of all rows, sorted by arrival and time, in parts."""
        held, size, lengths = [], 0, []
        for chunk in rows:
            # only the order of the columns is certain here, not their names
            held.append(chunk.iloc[:, [-2, -1]].to_numpy(np.int64))
            size += len(chunk)
            if size >= self.run_rows:
                lengths.append(self._store(len(lengths), held))
                held, size = [], 0
        if not lengths:
            yield from ([_sorted(held)[:, 0]] if size else [])
            return
        if size:
            lengths.append(self._store(len(lengths), held))
        yield from self._merged(lengths)
        self.pieces.clear()

    def _store(self, run: int, held: list[np.ndarray]) -> int:
        whole = _sorted(held)
        starts = range(0, len(whole), self.piece_rows)
        for piece, at in enumerate(starts):
            self.pieces.updateValue((run, piece), (whole[at : at + self.piece_rows].tobytes(),))
        return len(starts)

    def _piece(self, run: int, piece: int) -> np.ndarray:
        return np.frombuffer(bytes(self.pieces.getValue((run, piece))[0]), np.int64).reshape(-1, 2)

    def _merged(self, lengths: list[int]) -> Iterator[np.ndarray]:
        at = [0] * len(lengths)
        current = {run: self._piece(run, 0) for run in range(len(lengths))}
        while current:
            # up to the smallest end of a piece that others of its run follow, nothing is missing
            ends = [tuple(p[-1, ::-1]) for run, p in current.items() if at[run] + 1 < lengths[run]]
            ready = []
            for run, p in list(current.items()):
                n = len(p)
                if ends:
                    arrival, us = min(ends)
                    n = int(((p[:, 1] < arrival) | ((p[:, 1] == arrival) & (p[:, 0] <= us))).sum())
                ready.append(p[:n])
                if n < len(p):
                    current[run] = p[n:]
                elif at[run] + 1 < lengths[run]:
                    at[run] += 1
                    current[run] = self._piece(run, at[run])
                else:
                    del current[run]
            yield _sorted(ready)[:, 0]

    def _judged(self, us: np.ndarray, latest: int | None) -> tuple[np.ndarray, int | None]:
        """What each of the times, in order, is against the latest before it; and the latest after them."""
        if not len(us):
            return np.zeros(0, object), latest
        start = us[0] if latest is None else latest
        seen = np.maximum(np.concatenate([[start], np.maximum.accumulate(us)[:-1]]), start)
        diff = us - seen
        kind = np.full(len(us), "ok", object)
        kind[np.abs(diff - self.interval) > self.tolerance] = "gap"
        kind[diff == 0] = "duplicate"
        kind[diff < 0] = "late"
        if latest is None:
            kind[0] = "ok"
        return kind, int(max(start, us.max()))

    def close(self) -> None:
        pass


def _sorted(parts: list[np.ndarray]) -> np.ndarray:
    """Rows (time, arrival) of all parts, by arrival and time."""
    whole = np.concatenate(parts)
    return whole[np.lexsort((whole[:, 0], whole[:, 1]))]


def stream_cadence(
    df: DataFrame,
    cols: Cols,
    interval: float = 30,
    tolerance: float = 1,
    watermark: str | None = None,
    run_rows: int = RUN_ROWS,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """(entity, ts, cadence): each reading is ok, a gap, a duplicate or late.

    Compared with the latest time seen for the entity so far, in order of arrival (then of time) within
    a micro-batch and across micro-batches, however Spark cuts them up. A task holds a bounded number of rows of an
    entity, whatever a micro-batch has of it. Needs the RocksDB state store.

    State is one time per entity. With a ``watermark`` it is dropped when the watermark passes that time, and
    Spark drops readings behind the watermark; an entity that comes back later starts anew.
    """
    # The worker in which Spark sets up the state gets no shipped files, so the processor travels by value.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    arrival = cols.arrival if cols.arrival in df.columns else cols.ts
    rank = micros(arrival) if "timestamp" in dict(df.dtypes)[arrival] else F.col(arrival).cast("long")
    timed = df.filter(F.col(cols.ts).isNotNull())
    slim = timed.select(*cols.entity, micros(cols.ts).alias("_us"), rank.alias("_arrival"))
    if watermark:
        marked = _event_time(timed, cols).withWatermark(cols.ts, watermark)
        slim = marked.select(*cols.entity, F.col(cols.ts).alias("_at"), micros(cols.ts).alias("_us"), rank.alias("_arrival"))
    kinds = dict(slim.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in cols.entity) + ", _us bigint, cadence string"
    judged = slim.groupBy(*cols.entity).transformWithStateInPandas(
        statefulProcessor=_Cadence(cols.entity, interval, tolerance, run_rows, piece_rows, watermark is not None),
        outputStructType=schema,
        outputMode="Append",
        timeMode="EventTime" if watermark else "None",
    )
    at = F.timestamp_micros("_us").cast(df.schema[cols.ts].dataType)
    return judged.select(*cols.entity, at.alias(cols.ts), "cadence")
