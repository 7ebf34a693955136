"""Every catalogue query against its DuckDB oracle on the smallest fixture."""

import math
import threading
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from strata.sources.driver_tables import TABLES

SF = "/root/testdata/sf0.001"
ORACLE = E.oracle_sql()


def _norm(v):
    if isinstance(v, float) and not math.isnan(v):
        return float(f"{v:.12g}")
    if hasattr(v, "is_nan"):
        return str(v)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["date_key", "category", "orders_count", "units_sold", "revenue"]
    assert df.schema["revenue"].dataType.simpleString() == "double"
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    srows = Counter(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    if name not in ORACLE:
        assert sum(srows.values()) > 0
        return
    rel = con.execute(ORACLE[name])
    ocols = [x[0] for x in rel.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    orows = Counter(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert srows == orows


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle_ends_under_a_limit(con, name):
    stop = threading.Timer(20, con.interrupt)
    stop.start()
    try:
        con.execute(f"SELECT * FROM ({ORACLE[name]}) LIMIT 1").fetchall()
    finally:
        stop.cancel()
