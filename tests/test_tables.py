import json
import os
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import types as T

from sievewatt.governance import audit, schema
from sievewatt.plans import reports
from sievewatt.sources import tables


def frame(spark, rows, cols="id int, value string"):
    return spark.createDataFrame(rows, cols)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_versions_time_travel_and_history(spark, folder):
    assert tables.latest(spark, folder + "/t") is None
    assert tables.history(spark, folder + "/t").count() == 0
    path = folder + "/t"
    assert tables.write(frame(spark, [(1, "a"), (2, "b")]), path) == 0
    between = datetime.now(timezone.utc)
    time.sleep(0.05)
    assert tables.write(frame(spark, [(1, "a"), (2, "b"), (3, "c")]), path) == 1
    assert tables.latest(spark, path) == 1
    assert ids(tables.read(spark, path)) == [1, 2, 3]
    assert ids(tables.read(spark, path, version=0)) == [1, 2]
    assert ids(tables.read(spark, path, as_of=between)) == [1, 2]
    rows = tables.history(spark, path).collect()
    assert [(r["version"], r["rows_written"]) for r in rows] == [(1, 3), (0, 2)]
    with pytest.raises(tables.TableMissing):
        tables.read(spark, path, version=7)


def test_append_restore_append(spark, folder):
    path = folder + "/t"
    tables.write(frame(spark, [(1, "a")]), path)
    tables.write(frame(spark, [(2, "b")]), path, mode="append")
    tables.write(frame(spark, [(9, "z")]), path)
    assert tables.restore(spark, path, 1) == 3
    assert ids(tables.read(spark, path)) == [1, 2]
    tables.write(frame(spark, [(3, "c")]), path, mode="append")
    assert ids(tables.read(spark, path)) == [1, 2, 3]
    assert ids(tables.read(spark, path, version=2)) == [9]
    tables.restore(spark, path, 2, folder + "/other")
    assert ids(tables.read(spark, folder + "/other")) == [9]


def test_a_writer_that_died_before_publishing_is_invisible(spark, folder):
    path = folder + "/t"
    tables.write(frame(spark, [(1, "a")]), path)
    frame(spark, [(2, "b")]).write.parquet(f"{path}/data/snapshot=half")
    with open(f"{path}/log/_draft", "w", encoding="utf-8") as fh:
        fh.write('{"version": 9')
    assert tables.latest(spark, path) == 0
    assert ids(tables.read(spark, path)) == [1]


def test_two_writers_cannot_publish_one_version(spark, folder):
    path = folder + "/t"
    tables.write(frame(spark, [(1, "a")]), path)
    entry = json.loads(open(f"{path}/log/0000000000.json", encoding="utf-8").read())
    with pytest.raises(Exception, match="exists|Exists"):
        tables._publish(spark, path, **{**entry, "version": 0})
    assert ids(tables.read(spark, path)) == [1]


def test_a_replayed_batch_changes_nothing(spark, folder):
    path = folder + "/t"
    for _ in range(2):
        tables.write(frame(spark, [(1, "a")]), path, mode="append", writer="w", batch_id=0)
    tables.write(frame(spark, [(2, "b")]), path, mode="append", writer="w", batch_id=1)
    assert ids(tables.read(spark, path)) == [1, 2]
    assert tables.latest(spark, path) == 1


def test_partitioned_and_empty_tables(spark, folder):
    path = folder + "/t"
    tables.write(frame(spark, [(1, "a"), (2, "b")]), path, partition_by=["value"])
    tables.write(frame(spark, [(3, "a")]), path, mode="append", partition_by=["value"])
    df = tables.read(spark, path)
    assert ids(df.filter("value = 'a'")) == [1, 3]
    assert df.columns == ["id", "value"]
    tables.write(frame(spark, []), folder + "/empty")
    assert tables.read(spark, folder + "/empty").count() == 0
    assert tables.rows_written(spark, folder + "/empty") == 0


def test_compare_counts_row_level_differences(spark, folder):
    path = folder + "/t"
    tables.write(frame(spark, [(1, "a"), (2, "b"), (3, None)]), path)
    tables.write(frame(spark, [(2, "B"), (3, None), (4, "d"), (5, "e")]), path)
    row = tables.compare(spark, path, 0, 1, ["id"]).first()
    assert (row["count_v1"], row["count_v2"], row["row_diff"], row["schema_equal"]) == (3, 4, 1, True)
    assert (row["added"], row["removed"], row["changed"]) == (2, 1, 1)
    plain = tables.compare(spark, path, 0, 1).first()
    assert (plain["count_v1"], plain["count_v2"]) == (3, 4)


def test_vacuum_keeps_what_recent_versions_use(spark, folder):
    path = folder + "/t"
    tables.write(frame(spark, [(1, "a")]), path)
    tables.write(frame(spark, [(2, "b")]), path)
    tables.write(frame(spark, [(3, "c")]), path, mode="append")
    assert tables.vacuum(spark, path, hours=1) == []
    assert len(tables.vacuum(spark, path, hours=0)) == 1
    assert ids(tables.read(spark, path)) == [2, 3]
    assert len(os.listdir(path + "/data")) == 2


def test_optimize_keeps_rows_and_clusters_them(spark, folder):
    path = folder + "/t"
    df = spark.range(4000).selectExpr("cast(id % 64 as int) as id", "cast(id as string) as value", "id as n")
    tables.write(df.repartition(7), path)
    tables.optimize(spark, path, zorder=["id", "n"], files=4)
    out = tables.read(spark, path)
    assert sorted(r["n"] for r in out.collect()) == list(range(4000))
    widths = out.selectExpr("spark_partition_id() p", "id").groupBy("p").agg({"id": "max"}).collect()
    assert len(widths) <= 4
    assert tables.history(spark, path).first()["operation"] == "optimize"


def test_merge_adds_columns_and_widens_types(spark, folder):
    path = folder + "/t"
    schema.evolve(frame(spark, [(1, "a")]), path)
    schema.evolve(frame(spark, [(2**40, 1.5)], "id bigint, extra double"), path)
    df = tables.read(spark, path)
    assert dict(df.dtypes) == {"id": "bigint", "value": "string", "extra": "double"}
    assert sorted(map(tuple, df.collect())) == [(1, "a", None), (2**40, None, 1.5)]
    assert dict(tables.read(spark, path, version=0).dtypes)["id"] == "int"


def test_fail_mode_writes_on_match_and_raises_otherwise(spark, folder):
    path = folder + "/t"
    schema.evolve(frame(spark, [(1, "a")]), path, "fail")
    schema.evolve(frame(spark, [(2, "b")]), path, "fail")
    assert ids(tables.read(spark, path)) == [1, 2]
    with pytest.raises(ValueError, match="removed"):
        schema.evolve(frame(spark, [(1,)], "id int"), path, "fail")
    with pytest.raises(ValueError, match="types"):
        schema.evolve(frame(spark, [(1, 2)], "id int, value int"), path, "fail")
    with pytest.raises(ValueError, match="new columns"):
        schema.evolve(frame(spark, [(1, "a", 1)], "id int, value string, x int"), path, "fail", allow_new=False)
    with pytest.raises(ValueError, match="widened"):
        schema.evolve(frame(spark, [(1, 2)], "id int, value int"), path, "merge")
    schema.evolve(frame(spark, [(7,)], "id int"), path, "overwrite")
    assert tables.read(spark, path).columns == ["id"]


def test_overwrite_with_matching_schema_only(spark, folder):
    path = folder + "/t"
    tables.write(frame(spark, [(1, "a")]), path, must_match=True)
    tables.write(frame(spark, [(2, "b")]), path, must_match=True)
    assert ids(tables.read(spark, path)) == [2]
    with pytest.raises(ValueError):
        tables.write(frame(spark, [(1,)], "id int"), path, must_match=True)


def test_schema_comparison(spark):
    a, b = frame(spark, []), frame(spark, [], "id bigint, other string")
    rows = {r["column"]: r["status"] for r in schema.schema_diff(a, b).collect()}
    assert rows == {"id": "type_differs", "other": "only_in_table2", "value": "only_in_table1"}
    assert schema.schema_matches(a, a.schema)
    assert not schema.schema_matches(a, b.schema)
    assert not schema.schema_matches(a, T.StructType(list(reversed(a.schema.fields))))


def test_audit_log(spark, folder):
    path = folder + "/audit"
    assert audit.row_count(spark, path) == 0
    first = datetime(2024, 1, 1)
    audit.log_run(spark, path, "a", {"k": 1}, row_counts={"t": 5}, run_timestamp=first)
    audit.log_run(spark, path, "b", status="FAILED", error_message="x", run_timestamp=first + timedelta(days=1))
    audit.log_run(spark, path, "a", row_counts={"t": 6, "u": 1}, run_timestamp=first + timedelta(days=400))
    assert [r["pipeline_name"] for r in audit.query_runs(spark, path).collect()] == ["a", "b", "a"]
    assert audit.query_runs(spark, path, "a", "SUCCESS", limit=1).first()["row_counts"] == {"t": 6, "u": 1}
    assert audit.query_runs(spark, path, status="FAILED").first()["error_message"] == "x"
    latest = {r["table"]: r["rows"] for r in reports.latest_run(tables.read(spark, path)).collect()}
    assert latest == {"t": 6, "u": 1}
    audit.apply_retention(spark, path, 365, now=first + timedelta(days=401))
    assert audit.row_count(spark, path) == 1
    assert audit.table_version(spark, path) == 3
    with pytest.raises(ValueError):
        audit.log_run(spark, path, "a", status="MAYBE")
