"""The driver's contract: names, equal columns, and results equal to SQL on the smallest tables."""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {"p2_found", "p5_found"} <= set(entry.queries())


@needs_data
def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def rows(values):
    return sorted(tuple("~" if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in values)


@needs_data
@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if not re.match(r"p[134678]_", n)))
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    got = entry.queries()[name](spark, DATA)
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert rows(got.select(*columns).collect()) == rows(want)
