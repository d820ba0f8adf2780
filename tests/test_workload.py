"""Every registered query against its SQL on the smallest test tables."""

import importlib.util
import math
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parent.parent
DATA = Path("/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]

spec = importlib.util.spec_from_file_location("spark_entry", ROOT / "__spark_entry__.py")
entry_module = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry_module)
ENTRIES = entry_module.ENTRIES
QUERIES, ORACLES = ({n: q for n, q in f().items() if n in ENTRIES} for f in (entry_module.queries, entry_module.oracle_sql))

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    yield con
    con.close()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def ordered(rows, columns, names):
    index = [columns.index(n) for n in names]
    out = [tuple(plain(r[i]) for i in index) for r in rows]
    return sorted(out, key=lambda r: [(v is not None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, duck, name):
    got = QUERIES[name](spark, str(DATA))
    want = duck.sql(ORACLES[name])
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    assert ordered(got.collect(), got.columns, names) == ordered(want.fetchall(), want.columns, names)


def test_entry(spark):
    result = entry_module.entry(spark)
    assert result.columns == ["day", "status", "n_events"] and result.count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


ORDERED = ["check_mutually_exclusive_ranges", "check_mutually_exclusive_ranges_no_gaps", "check_sequential_values",
           "check_sequential_dates", "lag_gap", "lead_next", "last_row_flag", "dense_identity", "job_payments", "job_other_charges",
           "job_alerts", "job_pre_alerts", "job_sign_ups", "check_mutually_exclusive_ranges_gaps_required"]


@pytest.mark.parametrize("name", ORDERED)
def test_ordered_queries_put_no_rows_into_one_task(spark, name):
    lines = QUERIES[name](spark, str(DATA))._jdf.queryExecution().executedPlan().toString().splitlines()
    fed = [lines[i + 1] for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert all("Aggregate" in line for line in fed), fed
