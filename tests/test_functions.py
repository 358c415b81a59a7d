import duckdb
import pytest
from pyspark.sql import functions as F

from greenledger.functions import (
    concat_nulls,
    concat_skip_nulls,
    is_kilogram_unit,
    lower_first,
    round3_then_grams,
    strip_trailing_group,
    surrogate_key,
)


def duck(sql):
    return duckdb.connect().execute(sql).fetchone()[0]


def one(spark, col, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(col.alias("y")).first()["y"]


def test_surrogate_key_matches_duckdb(spark):
    df = spark.createDataFrame([("7", 2024)], "id string, year int")
    got = df.select(surrogate_key(F.lit("defra"), "id", "year").alias("k")).first()["k"]
    want = duck("select md5(concat_ws('|', 'defra', '7', 2024))")
    assert got == want


def test_surrogate_key_skips_nulls(spark):
    df = spark.createDataFrame([(None, 1)], "a string, b int")
    got = df.select(surrogate_key(F.lit("s"), "a", "b").alias("k")).first()["k"]
    assert got == duck("select md5('s|1')")


def test_concat_flavours(spark):
    df = spark.createDataFrame([("a", None)], "a string, b string")
    r = df.select(concat_skip_nulls("a", "b", F.lit("c")).alias("s"),
                  concat_nulls("a", "b", F.lit("c")).alias("p")).first()
    assert r["s"] == "ac" and r["p"] is None


@pytest.mark.parametrize("text,want", [
    ("Échelle", "échelle"), ("Ballon", "ballon"), ("x", "x"), ("", ""), ("ABC", "aBC"),
])
def test_lower_first(spark, text, want):
    assert one(spark, lower_first("x"), text) == want


def test_lower_first_null(spark):
    assert one(spark, lower_first("x"), None) is None


@pytest.mark.parametrize("text,want", [
    ("Corde (geC/pièce)", "Corde"),
    ("Tapis (grand) (kgeC/pièce)", "Tapis (grand)"),
    ("Échelle", "Échelle"),
    ("Sac (geC/pièce)  ", "Sac"),
    ("Sac (geC/pièce)\n", "Sac"),
])
def test_strip_trailing_group(spark, text, want):
    assert one(spark, strip_trailing_group("x"), text) == want


@pytest.mark.parametrize("text,want", [
    ("Banc (kgeC/pièce)", True), ("Banc (kgC/pièce)", True), ("Banc (kgCO2e/piece)", True),
    ("Banc (geC/pièce)", False), ("Banc (kec/pièce)", False), ("Banc kgeC/", False),
])
def test_kilogram_unit(spark, text, want):
    assert one(spark, is_kilogram_unit("x"), text) is want


def test_round_then_grams_matches_duckdb_on_halfway_values(spark):
    values = [2.0035, 0.5005, 1.0005, 0.0015, 123.4565, 7.0, 0.0] + [k / 10000 for k in range(1, 3000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = {r["x"]: r["y"] for r in df.select("x", round3_then_grams("x").alias("y")).collect()}
    con = duckdb.connect()
    con.execute("create table t(x double)")
    con.executemany("insert into t values (?)", [(v,) for v in values])
    want = dict(con.execute("select x, round(x, 3) * 1000.0 from t").fetchall())
    assert got == want
    assert got[2.0035] == 2003.0
