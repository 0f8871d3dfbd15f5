"""Every catalog query against its SQL twin, and the shape of its plan."""

import datetime
import decimal
import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from paperloom.catalog import ORACLES, QUERIES, fixtures, keyed_queries

DATA = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are absent")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return round(float(value), 6)
    if isinstance(value, bool):
        return value
    if isinstance(value, int):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def test_entry_points(spark):
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert entry_module.entry(spark).columns[:2] == ["id", "task_type"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, oracle, name):
    frame = QUERIES[name](spark, str(DATA))
    columns = sorted(frame.columns)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|ArrowEvalPython", plan)
    got = [tuple(plain(v) for v in row) for row in frame.select(*columns).collect()]
    result = oracle.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = [tuple(plain(row[i]) for i in order) for row in result.fetchall()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("name", ["up_clean_reviews", "up_rejected_reviews", "up_clean_papers"])
def test_upserts_land_the_columns_of_their_table_only(spark, monkeypatch, name):
    """Payloads that no row of the result holds are neither made nor written."""
    landed = []
    for module in (keyed_queries, fixtures):
        inner = module.land
        monkeypatch.setattr(module, "land", lambda df, name, inner=inner: landed.append(df.columns) or inner(df, name))
    wanted = {*QUERIES[name](spark, str(DATA)).columns, "start_index", "reject_reason"}
    assert landed and all(set(columns) <= wanted for columns in landed)
