"""Every query with SQL against DuckDB on the smallest tables."""

from __future__ import annotations

import math
import os
from pathlib import Path

import pytest

from rowsmith.plans import registry

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, bool):
        return v
    try:
        return round(float(v), 4) if not isinstance(v, str) else v
    except (TypeError, ValueError):
        return str(v)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, name):
    import duckdb

    df = registry.queries()[name](spark, DATA)
    got = [tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()]
    if name not in registry.oracle_sql():
        assert len(set(map(str, got))) == len(got)
        return
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}'")
    rel = con.sql(registry.oracle_sql()[name])
    cols = sorted(rel.columns)
    assert cols == sorted(df.columns)
    at = [rel.columns.index(c) for c in cols]
    want = [tuple(plain(r[i]) for i in at) for r in rel.fetchall()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    if DATA.endswith("sf0.001"):
        assert entry.entry(spark).count() > 0
