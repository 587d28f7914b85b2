"""Registered queries against their SQL in DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest
from folioframe.plans import queries as layout

SF = "/root/testdata/sf0.001"


def canonical(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    plain = lambda v: None if v is None or isinstance(v, float) and math.isnan(v) or str(v) in ("<NA>", "None") else round(float(v), 6) if isinstance(v, float) else str(v)
    return sorted((tuple(map(plain, r)) for r in frame.itertuples(index=False)), key=repr)


def database(folder=SF):
    con = duckdb.connect()
    for name in os.listdir(folder):
        con.sql(f"create view {name.removesuffix('.parquet')} as select * from read_parquet('{folder}/{name}')")
    return con


@pytest.mark.parametrize("name", sorted(layout.queries()))
def test_layout_query(spark, name):
    found = layout.queries()[name](spark, SF).toPandas()
    want = database().sql(layout.oracle_sql()[name]).df()
    assert sorted(found.columns) == sorted(want.columns)
    assert canonical(found.convert_dtypes()) == canonical(want.convert_dtypes())


def test_fixture_counts(spark):
    rows = layout.queries()["document_status"](spark, SF).groupBy("status").count().collect()
    assert {r["status"]: r["count"] for r in rows} == {"complete": 30, "partial": 116, "failed": 4}


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 150
    assert set(layout.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
