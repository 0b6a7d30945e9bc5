"""A sample of the registered queries against their SQL; ``check_oracle.py`` compares them all."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import TABLES, canonical

SF = "/root/testdata/sf0.001"

SAMPLE = [
    "clean_readings",
    "forward_fill",
    "rejected_rows",
    "consumption_analytics",
    "completeness_spine",
    "temporal_metrics",
    "business_metrics",
    "schema_metrics",
    "quality_scores",
    "incidents_every_rule",
    "expectations",
    "score_quantiles",
    "training_set",
    "train_test_split",
    "version_compare",
    "stream_completeness",
    "stream_cadence",
    "osm_buildings",
    "buildings_by_area",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_entry_and_registry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    result = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(names, result.fetchall())


def test_filters_and_columns_reach_the_scan(spark):
    plan = entry.queries()["completeness_daily"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan and "event_type" not in plan
    untimed = entry.queries()["temporal_metrics"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "value" not in untimed.split("ReadSchema")[1].split("\n")[0]


def test_rolling_features_need_six_shuffles(spark):
    """Two of the weather, one each of incidents, readings, their meeting with the scores, and holidays."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = entry.queries()["rolling_features"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    shuffles = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line]
    assert len(shuffles) <= 6 and "SinglePartition" not in plan


WITHOUT = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as e
names = set(e.queries())
assert "quality_scores" in names and "pipeline" not in names and not any(n.startswith("op1_") for n in names)
assert set(e.oracle_sql()) <= names
"""


def copied(folder, leave_out):
    root = os.path.dirname(os.path.abspath(entry.__file__))
    skip = shutil.ignore_patterns("__pycache__", "llm", "corpus_pipeline.py") if leave_out else shutil.ignore_patterns("__pycache__")
    for name in ("sievewatt", "catalog"):
        shutil.copytree(f"{root}/{name}", f"{folder}/{name}", ignore=skip)
    for name in os.listdir(root):
        if name.endswith(".py") and not (leave_out and name == "corpus_pipeline.py"):
            shutil.copy(f"{root}/{name}", folder)


def test_the_rest_works_without_the_training_data_operators(folder):
    copied(folder, True)
    subprocess.run([sys.executable, "-c", WITHOUT, folder], check=True, cwd="/tmp")


def test_a_broken_import_is_not_hidden(folder):
    copied(folder, False)
    if not os.path.exists(f"{folder}/sievewatt/llm"):
        pytest.skip("the operators are not there")
    with open(f"{folder}/corpus_pipeline.py", "a") as f:
        f.write("\nimport no_such_module\n")
    done = subprocess.run([sys.executable, "-c", WITHOUT, folder], cwd="/tmp", capture_output=True, text=True)
    assert done.returncode and "no_such_module" in done.stderr


WORKERS = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as e
from sievewatt.session import build_session
spark = build_session("workers", "local[2]", spark__ui__enabled="false", spark__sql__shuffle__partitions="2")
print("rows", e.queries()[sys.argv[2]](spark, sys.argv[3]).count())
"""


def test_workers_get_the_code(folder):
    """Python workers find the package although only the driver's path names it."""
    copied(folder, False)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", WORKERS, folder, "stream_cadence", SF], cwd="/tmp", env=env, capture_output=True, text=True
    )
    assert "rows" in done.stdout, done.stderr[-2000:]
