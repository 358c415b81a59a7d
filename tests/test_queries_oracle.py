"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as ent
from greenledger.plans.queries import QUERIES
from greenledger.plans.standins import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.12g}"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def digest(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(norm(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ent.queries()) and set(QUERIES) <= set(ent.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = ent.queries()[name](spark, SF)
    res = duck.execute(ent.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert digest(sdf.columns, [tuple(r) for r in sdf.collect()]) == digest(dcols, res.fetchall())


def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "ef_id"


def test_dim_factors_is_sorted(spark):
    got = [(r["source"], r["country_code"], r["factor_name"], r["source_year"])
           for r in ent.queries()["dim_factors"](spark, SF).collect()]
    key = [(s, c or "￿", f or "￿", y) for s, c, f, y in got]
    assert key == sorted(key)
