"""Driver contract: entry, registered queries against their SQL, and running without the optional part."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF
from tools.oracle_check import TABLES, rows_of

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["building_id", "apartment_id", "event_date"]
    assert df.count() > 0


@pytest.mark.parametrize("name", [
    "features_daily", "label_metrics_unscored", "alerts_store_upsert", "alerts_store_for_date", "alerts_store_delete",
    "incremental_ingest_runs", "meter_table_range", "ingest_audit", "stream_alert_counts", "lof_novelty_global",
    "stream_alerts_quarantine", "stream_ingest_audit", "meter_batch_replay"])
def test_query_against_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    cur = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    df = E.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(cols)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got == rows_of(cols, cur.fetchall()) and got


def run_elsewhere(code, cwd):
    return subprocess.run([sys.executable, "-c", code], cwd=cwd, capture_output=True, text=True, timeout=240,
                          env={**os.environ, "PYTHONPATH": ""})


@pytest.mark.parametrize("missing", ["thermolytics.llm", "xxhash"])
def test_without_the_optional_part(tmp_path, missing):
    out = run_elsewhere(f"""
import sys
sys.path.insert(0, {ROOT!r})
sys.modules[{missing!r}] = None
import __spark_entry__ as E
print(len(E.queries()), set(E.oracle_sql()) <= set(E.queries()), any(k.startswith("op") or k == "pipeline" for k in E.queries()))
""", tmp_path)
    assert out.returncode == 0, out.stderr[-2000:]
    n, subset, optional = out.stdout.split()[-3:]
    assert int(n) >= 38 and subset == "True" and optional == "False"


def test_kernels_run_from_any_directory(tmp_path):
    """The Python workers cannot import the package there: the kernels travel with their code."""
    out = run_elsewhere(f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as E
from thermolytics.session import get_session
spark = get_session("local[2]", shuffle_partitions=2)
print("ROWS", E.queries()["lof_by_building"](spark, {SF!r}).count())
""", tmp_path)
    assert "ROWS" in out.stdout and int(out.stdout.split()[-1]) > 100, out.stderr[-2000:]
