import datetime as dt

import pytest
from pyspark.sql import functions as F

from greenledger.operators import checks as ck
from greenledger.operators.dimension import (
    build_dimension,
    current_only,
    flag_current,
    order_gold,
    prepare,
    rank_editions,
)
from greenledger.plans.clean import conform_all
from tests.conftest import rows

D = dt.date
CONF = ("id string, factor_name string, description string, gCO2e_per_unit double, unit string, "
        "ghg_scope string, country_code string, source string, source_year int, valid_from date, "
        "valid_to date, sub_category string, category string, uncertainty_pct double")


def conformed(spark):
    data = [
        # two editions of one factor
        ("a1", "Gas", None, 1.0, "kWh", "Scope 1", "GLOBAL", "defra", 2023, D(2023, 1, 1), D(2023, 12, 31), "Fuel", "Energy", None),
        ("a2", "Gas", None, 2.0, "kWh", "Scope 1", "GLOBAL", "defra", 2024, D(2024, 1, 1), D(2024, 12, 31), "Fuel", "Energy", None),
        # same name, other unit: its own group
        ("b1", "Gas", None, 3.0, "litres", "Scope 1", "GLOBAL", "defra", 2023, D(2023, 1, 1), D(2023, 12, 31), "Fuel", "Energy", None),
        # tie on name, unit and edition: the smaller id wins
        ("c2", "Oil", None, 4.0, "kWh", "Scope 1", "GLOBAL", "defra", 2024, D(2024, 1, 1), D(2024, 12, 31), "Fuel", "Energy", None),
        ("c1", "Oil", None, 5.0, "kWh", "Scope 3", "GLOBAL", "defra", 2024, D(2024, 1, 1), D(2024, 12, 31), "Fuel", "Energy", None),
        # NULL name falls back to sub-category and joins that group
        ("d1", None, None, 6.0, "kWh", "Scope 2", "GLOBAL", "defra", 2022, D(2022, 1, 1), D(2022, 12, 31), "Oil", "Energy", None),
        # other source, open-ended
        ("e1", "Ball", "x", 7.0, "piece", "Scope 3", "GLOBAL", "ademe", 2016, D(2016, 1, 1), D(9999, 12, 31), "Sports", "Materials", 0.2),
    ]
    return spark.createDataFrame(data, CONF)


def test_rank_and_flag_agree(spark):
    p = prepare(conformed(spark))
    ranked = {r["id"]: r["rn"] for r in rank_editions(p).collect()}
    flagged = {r["id"]: r["is_current"] for r in flag_current(p).collect()}
    assert ranked == {"a1": 2, "a2": 1, "b1": 1, "c1": 1, "c2": 2, "d1": 3, "e1": 1}
    assert flagged == {k: v == 1 for k, v in ranked.items()}


def wide(spark, n=30000):
    """A frame larger than the range sample, with one hot group and repeated ids."""
    return spark.range(n).selectExpr(
        f"concat('i', id % {n // 3}) AS id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('n', id % 500) END AS factor_name",
        "repeat('x', int(id % 50)) AS description", "id * 1.5D AS gCO2e_per_unit", "'kWh' AS unit", "'S' AS ghg_scope",
        "'NO' AS country_code", "CASE WHEN id % 7 = 0 THEN NULL ELSE 'nve' END AS source", "int(2000 + id % 20) AS source_year",
        "make_date(int(2000 + id % 20), 1, 1) AS valid_from", "make_date(int(2000 + id % 20), 12, 31) AS valid_to",
        "cast(NULL AS string) AS sub_category", "'c' AS category", "cast(NULL AS double) AS uncertainty_pct", "id AS line")


@pytest.mark.parametrize("reuse", ["true", "false"])
@pytest.mark.parametrize("partitions", [3, 17])
def test_range_ranks_equal_the_window_with_all_columns(spark, reuse, partitions):
    df = wide(spark)
    before = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        got = rank_editions(df, tiebreak=("id", "line"), partitions=partitions)
        assert got.columns == [*df.columns, "rn"]
        want = rank_editions(df, tiebreak=("id", "line"), method="window")
        assert got.count() == df.count()
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    finally:
        spark.conf.set("spark.sql.exchange.reuse", before)


def test_one_current_row_when_ids_repeat(spark):
    df = wide(spark, 3000).drop("line").withColumn("id", F.lit("same"))
    df = df.unionByName(df)  # wholly repeated rows too
    flagged = flag_current(df)
    assert flagged.count() == df.count() and flagged.columns == [*df.columns, "is_current"]
    groups = flagged.groupBy("source", "factor_name", "unit").agg(F.count_if("is_current").alias("n"))
    assert [r["n"] for r in groups.select("n").distinct().collect()] == [1]


def test_exactly_one_current_per_group(spark):
    dim = build_dimension(conformed(spark))
    per_group = dim.groupBy("source", "factor_name", "unit").agg(
        F.count_if("is_current").alias("n"))
    assert {r["n"] for r in per_group.collect()} == {1}
    assert dim.count() == 7


def test_gold_columns_and_fallbacks(spark):
    dim = {r["ef_id"]: r for r in build_dimension(conformed(spark)).collect()}
    assert dim["d1"]["factor_name"] == "Oil"
    assert dim["a1"]["uncertainty_pct"] == 0.0 and dim["e1"]["uncertainty_pct"] == 0.2
    assert list(build_dimension(conformed(spark)).columns) == [
        "ef_id", "source", "factor_name", "description", "gCO2e_per_unit", "unit", "ghg_scope",
        "category", "sub_category", "country_code", "source_year", "valid_from", "valid_to",
        "is_current", "uncertainty_pct"]


def test_current_only(spark):
    cur = current_only(prepare(conformed(spark)))
    assert rows(cur, "id") == [("a2",), ("b1",), ("c1",), ("e1",)]


def test_order_gold_nulls_last(spark):
    df = spark.createDataFrame(
        [("x", "nve", None, "A", 2020, D(2020, 1, 1)), ("y", "nve", "NO", "A", 2020, D(2020, 1, 1)),
         ("z", "ademe", "GLOBAL", "B", 2016, D(2016, 1, 1))],
        "ef_id string, source string, country_code string, factor_name string, source_year int, valid_from date")
    assert [r["ef_id"] for r in order_gold(df).collect()] == ["z", "y", "x"]


def test_conform_all_types(spark):
    cat = conformed(spark).drop("uncertainty_pct")
    ser = cat.drop("sub_category", "category")
    prod = conformed(spark)
    u = conform_all(cat, ser, prod)
    assert u.count() == 21
    assert dict(u.dtypes)["uncertainty_pct"] == "double"
    assert {r["category"] for r in u.where("source_year = 2022").collect()} == {"Energy", "Materials"}


# -------------------------------------------------------------------- checks
def test_gold_suite_passes_on_clean_dimension(spark):
    res = ck.run_checks(build_dimension(conformed(spark)), "gold", ck.gold_suite())
    assert res.count() == 16
    assert all(r["passed"] for r in res.collect())


def test_each_check_kind_fails_on_a_violating_frame(spark):
    df = spark.createDataFrame(
        [("k1", "defra", -1.0, "Scope 9", D(2024, 1, 1), D(2023, 1, 1)),
         ("k1", "other", None, "Scope 8", D(2024, 1, 1), D(2025, 1, 1)),
         ("k2", "other", 1.0, "Scope 8", None, D(2025, 1, 1)),
         (None, "nve", 2.0, "Scope 1", D(2024, 1, 1), D(2025, 1, 1))],
        "ef_id string, source string, gCO2e_per_unit double, ghg_scope string, valid_from date, valid_to date")
    suite = [ck.unique("ef_id"), ck.not_null("ef_id"), ck.accepted("source", ck.SOURCES),
             ck.not_null("gCO2e_per_unit"), ck.expression("gCO2e_per_unit", "gCO2e_per_unit >= 0"),
             ck.accepted("ghg_scope", ck.SCOPES), ck.expression("valid_from", ck.FROM_BEFORE_TO)]
    got = {(r["check"], r["column"]): r["failing"] for r in ck.run_checks(df, "m", suite).collect()}
    assert got == {
        ("unique", "ef_id"): 1,                       # k1 twice; NULL ignored
        ("not_null", "ef_id"): 1,
        ("accepted_values", "source"): 1,             # one distinct bad value
        ("not_null", "gCO2e_per_unit"): 1,
        ("expression", "gCO2e_per_unit >= 0"): 1,     # NULL passes
        ("accepted_values", "ghg_scope"): 2,
        ("expression", "valid_from <= valid_to"): 1,  # NULL passes
    }


def test_suite_sizes():
    sizes = [len(s()) for s in (ck.series_suite, ck.products_suite, ck.catalog_suite,
                                ck.gold_suite, ck.translation_suite)]
    assert sizes == [18, 20, 19, 16, 2] and sum(sizes) == 75


def test_range_rank_equals_window_rank_on_a_hot_group(spark):
    hot = [(f"h{i:04d}", "Hot", "kWh", D(2000 + i % 20, 1, 1), D(2000 + i % 20, 12, 31)) for i in range(900)]
    cold = [(f"c{i}", f"N{i % 7}", "kWh", D(2010 + i % 3, 1, 1), None) for i in range(60)]
    nulls = [(f"z{i}", None, "kWh", D(2011, 1, 1), D(2011, 12, 31)) for i in range(5)]
    df = spark.createDataFrame(hot + cold + nulls,
                               "id string, factor_name string, unit string, valid_from date, valid_to date")
    df = df.withColumn("source", F.lit("s"))
    window = {r["id"]: r["rn"] for r in rank_editions(df, method="window").collect()}
    for parts in (1, 3, 16):
        ranged = {r["id"]: r["rn"] for r in rank_editions(df, method="range", partitions=parts).collect()}
        assert ranged == window
    assert sorted(v for k, v in window.items() if k.startswith("h")) == list(range(1, 901))


def test_range_rank_without_exchange_reuse(spark):
    hot = [(f"h{i:04d}", "Hot", "kWh", D(2000 + i % 20, 1, 1), D(2000 + i % 20, 12, 31)) for i in range(400)]
    df = spark.createDataFrame(hot, "id string, factor_name string, unit string, valid_from date, valid_to date") \
        .withColumn("source", F.lit("s"))
    window = {r["id"]: r["rn"] for r in rank_editions(df, method="window").collect()}
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        ranged = {r["id"]: r["rn"] for r in rank_editions(df, method="range", partitions=6).collect()}
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
    assert ranged == window


@pytest.mark.parametrize("hashed,suspects", [("xxhash64({})", 1_000_000), ("xxhash64({})", 0), ("CAST(length({}) AS BIGINT)", 1_000_000),
                                             ("CAST(length({}) AS BIGINT)", 0)])
def test_unique_counts_are_exact_whatever_the_hash(spark, monkeypatch, hashed, suspects):
    """Keys that share a hash are told apart; a hot key and nulls count as before."""
    monkeypatch.setattr(ck, "_HASH", hashed)
    monkeypatch.setattr(ck, "SUSPECTS", suspects)
    rows = [(f"k{i}", i % 7 if i % 5 else None, "hot") for i in range(400)] + [("k3", 1, "hot"), ("k3", 2, None), ("k9", 3, "hot"), (None, 4, "x")]
    df = spark.createDataFrame(rows, "a string, b int, c string").repartition(3)
    got = {r["column"]: (r["failing"], r["passed"]) for r in ck.run_checks(
        df, "m", [ck.unique("a"), ck.unique("b"), ck.unique("c"), ck.unique("concat(a, c, b)"), ck.not_null("a")]).collect() if r["check"] == "unique"}
    assert got == {"a": (2, False), "b": (7, False), "c": (1, False), "concat(a, c, b)": (0, True)}


def test_unique_keys_cross_the_shuffle_as_hashes(spark):
    plan = ck._failures(spark.range(10).selectExpr("CAST(id AS STRING) AS a"), [ck.unique("a")])._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan and "named_struct" not in plan.split("Aggregate")[0]
