"""Every registered query agrees with its SQL on the smallest driver tables."""

import datetime
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from doctables.plans.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


def norm(value):
    if value is None or value != value:
        return "\0"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(float(value)) if isinstance(value, float) else str(value)


def rows(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, sorted(zip(*[[norm(v) for v in c] for c in columns]))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    got = rows(entry_module.queries()[name](spark, SF).toArrow())
    want = rows(duck.sql(ORACLE[name]).to_arrow_table())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["path", "sheet_no", "row", "text"]
