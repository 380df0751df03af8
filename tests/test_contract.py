"""Every registered query against its SQL, and what its plan may not contain."""

from __future__ import annotations

import glob
import os

import pytest

import __spark_entry__ as contract
from oracle_queries import oracles

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(file).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{file}'")
    return connection


KINDS = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda row: tuple((v is None, str(v)) for v in row))


def test_every_query_has_sql():
    assert contract.PLANS.keys() == oracles().keys()


@pytest.mark.parametrize("name", contract.PLANS)
def test_query_gives_what_its_sql_gives(spark, tables, name):
    df = contract.queries()[name](spark, SF)
    columns = sorted(df.columns)
    expected = tables.sql(contract.oracle_sql()[name])
    assert columns == sorted(expected.columns)
    kinds = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: KINDS[kind] for c, kind in df.dtypes} == kinds
    found = df.select(*[f"`{c}`" for c in columns]).collect()
    chosen = expected.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert in_order(found) == in_order(chosen)

    plan = df._jdf.queryExecution().executedPlan().toString()
    for costly in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "Scan ExistingRDD"):
        assert costly not in plan


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:3] == ["price_year", "commodity", "pricetype"] and df.count() > 0
