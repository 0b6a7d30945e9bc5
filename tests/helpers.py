from datetime import datetime, timedelta

from sievewatt.config import Cols

START = datetime(2024, 1, 1)
COLS = Cols(("household_id",), "timestamp", "energy_kwh", "arrival")


def at(minutes):
    return START + timedelta(minutes=minutes)


def readings(spark, rows):
    """rows of (household, minutes after midnight or None, value); arrival is the row's place."""
    data = [(h, None if m is None else at(m), v, i) for i, (h, m, v) in enumerate(rows)]
    return spark.createDataFrame(data, "household_id string, timestamp timestamp, energy_kwh double, arrival bigint")


def by(df, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


def same_rows(a, b):
    names = sorted(a.columns)
    assert names == sorted(b.columns)
    left, right = ([tuple(_plain(r[n]) for n in names) for r in df.collect()] for df in (a, b))
    assert sorted(left, key=repr) == sorted(right, key=repr)


def _plain(v):
    return round(v, 9) if isinstance(v, float) else v
