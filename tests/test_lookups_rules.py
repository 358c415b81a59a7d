import pytest
from pyspark.sql import functions as F

from greenledger.operators.lookups import (
    assert_unique_key,
    drop_listed,
    map_values,
    unmatched_keys,
    wildcard_lookup,
)
from greenledger.plans.clean import CatalogRules, clean_catalog, map_catalog
from greenledger.plans.reference_rules import (
    CATALOG_NAME_RULES,
    CATALOG_REWRITE_CATEGORY,
    CATALOG_TERRITORY,
)
from tests.conftest import rows

TR_SCHEMA = "factor_name_fr string, factor_name_en string, federation string"


def test_wildcard_lookup_cases(spark):
    data = spark.createDataFrame(
        [("1", "Ballon", "FOOT"), ("2", "Ballon", "RUGBY"), ("3", "Ballon", "TENNIS"),
         ("4", "Corde", "FOOT"), ("5", "Inconnu", "FOOT")], "id string, name string, fed string")
    lk = spark.createDataFrame(
        [("Ballon", "Football", "FOOT"), ("Ballon", "Rugby ball", "RUGBY"),
         ("Ballon", "Ball", None), ("Corde", "Rope", None)], TR_SCHEMA)
    out = wildcard_lookup(data, lk, "name", "factor_name_fr", "fed", "federation", ["factor_name_en"])
    got = rows(out, "id", "factor_name_en")
    assert got == [
        ("1", "Ball"), ("1", "Football"),      # generic + specific: fans out to two rows
        ("2", "Ball"), ("2", "Rugby ball"),
        ("3", "Ball"),                         # generic only
        ("4", "Rope"),
        ("5", None),                           # no match keeps the row
    ]


def test_wildcard_lookup_on_a_hot_name(spark):
    """One name with 3,000 scopes and 6,000 rows: no row meets the other scopes of its name."""
    data = spark.range(6000).selectExpr("id", "'hot' AS name", "concat('s', id % 4000) AS fed", "'x' AS federation")
    lk = spark.range(3000).selectExpr("'hot' AS factor_name_fr", "concat('en', id) AS factor_name_en", "concat('s', id) AS federation").unionByName(
        spark.createDataFrame([("hot", "any", None), ("hot", "any too", None), ("hot", "en5", "s5"), (None, "none", None)], TR_SCHEMA))
    out = wildcard_lookup(data, lk, "name", "factor_name_fr", "fed", "federation", ["factor_name_en"])
    assert out.columns == ["id", "name", "fed", "federation", "factor_name_en"]
    got = {}
    for r in out.collect():
        got.setdefault(r["id"], []).append(r["factor_name_en"])
    own = lambda i: [f"en{i % 4000}"] * (2 if i % 4000 == 5 else 1) if i % 4000 < 3000 else []
    assert {i: sorted(v) for i, v in got.items()} == {i: sorted([*own(i), "any", "any too"]) for i in range(6000)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    assert len(joins) == 2 and not any(" OR " in j or "isnull" in j for j in joins)


def test_wildcard_lookup_with_null_names_scopes_and_an_empty_lookup(spark):
    data = spark.createDataFrame([("1", None, "FOOT"), ("2", "Ballon", None)], "id string, name string, fed string")
    lk = spark.createDataFrame([(None, "x", None), (None, "y", "FOOT"), ("Ballon", "Football", "FOOT"), ("Ballon", "Ball", None)], TR_SCHEMA)
    args = ("name", "factor_name_fr", "fed", "federation", ["factor_name_en"])
    assert rows(wildcard_lookup(data, lk, *args), "id", "factor_name_en") == [("1", None), ("2", "Ball")]
    assert rows(wildcard_lookup(data, lk.limit(0), *args), "id", "factor_name_en") == [("1", None), ("2", None)]


def test_repeated_mapping_keys_are_refused(spark):
    from greenledger.plans.clean import CatalogRules

    ov = spark.createDataFrame([], "category string, sub_category string, should_drop boolean")
    one = spark.createDataFrame([("a", "x")], "category_old string, category_new string")
    many = spark.createDataFrame([(k, v) for k in "abcdefgh" for v in "xy"], "sub_category_old string, sub_category_new string")
    with pytest.raises(ValueError, match=r"sub-category mapping: duplicate keys \['a', 'b', 'c', 'd', 'e'\] and 3 more"):
        CatalogRules(ov, one, many)


def test_drop_listed_duplicates_and_nulls(spark):
    data = spark.createDataFrame([("a", "x", "1"), ("a", "y", "2"), ("b", "x", "3"), (None, "x", "4")],
                                 "category string, sub_category string, id string")
    ov = spark.createDataFrame([("a", "x", True), ("a", "x", True), ("b", "x", False), (None, "x", True)],
                               "category string, sub_category string, should_drop boolean")
    out = drop_listed(data, ov, ["category", "sub_category"])
    assert rows(out, "id") == [("2",), ("3",), ("4",)]


def test_map_values_and_unmatched(spark):
    data = spark.createDataFrame([("Fuels",), ("Other",), (None,)], "category string")
    mp = spark.createDataFrame([("Fuels", "Energy")], "category_old string, category_new string")
    out = map_values(data, mp, "category", "category_old", "category_new")
    assert rows(out) == [(None, None), ("Fuels", "Energy"), ("Other", None)]
    assert rows(unmatched_keys(data, mp, "category", "category_old")) == [("Other",)]


def test_assert_unique_key(spark):
    lk = spark.createDataFrame([("Ballon", "Ball", None), ("Ballon ", "Ball2", None)], TR_SCHEMA)
    key = F.expr("concat(trim(factor_name_fr), '¦', coalesce(federation, ''))")
    with pytest.raises(ValueError, match="duplicate"):
        assert_unique_key(lk, key)
    ok = spark.createDataFrame([("Ballon", "Ball", None), ("Ballon", "B", "FOOT")], TR_SCHEMA)
    assert_unique_key(ok, key)


# --------------------------------------------------------------------- naming rules
STAGED = ("id string, factor_name string, sub_category string, category string, "
          "sub_sub_category string, column_text string, country_code string")

# Invented catalog rows, one per naming rule (FIXTURES.md section 2), with the
# expected name after the real rule table.
CASES = [
    # id, category, sub_category, level3, level4, column text, expected name, country
    ("r1", "Hotel", "Hotel stay", "UK", None, None, "Hotel stay - UK", "GLOBAL"),
    ("r2", "Passenger vehicles", "Cars (by size)", "Small car", None, "Diesel", "Small car - Diesel", "GLOBAL"),
    ("r2n", "Passenger vehicles", "Cars (by size)", "Small car", None, None, None, "GLOBAL"),
    ("r3", "Passenger vehicles", "Motorbike", "Small", None, None, "Small motorbike", "GLOBAL"),
    ("r4", "WTT- vehicles", "WTT- Motorbike", "Small", None, None, "WTT- Small motorbike", "GLOBAL"),
    ("r5", "Delivery vehicles", "HGV (all diesel)", "Rigid", None, "50% Laden",
     "Heavy Goods Vehicles - Rigid - 50% Laden", "GLOBAL"),
    ("r6", "Freighting goods", "Cargo ship", "Bulk carrier", "10,000 dwt", None,
     "Bulk carrier - Cargo Ship - 10,000 dwt", "GLOBAL"),
    ("r7", "WTT- delivery", "WTT- cargo ship", "Bulk carrier", "10,000 dwt", None,
     "WTT- Bulk carrier - Cargo - 10,000 dwt", "GLOBAL"),
    ("r8", "UK electricity", "Electricity: UK", "Electricity: UK", None, None, "Electricity", "GB"),
    ("r8n", "WTT- UK electricity", "WTT- Electricity", "Electricity", None, None, None, "GB"),
    ("r9", "Waste disposal", "Refuse", "Household", None, "Landfill", "Household - Landfill", "GLOBAL"),
    ("r10", "Passenger transport", "Ferry", "Foot passenger", None, None, "Ferry -Foot passenger", "GLOBAL"),
    ("r11", "WTT- transport", "WTT- Bus", "Local bus", None, None, "WTT- Local bus", "GLOBAL"),
    ("r12", "Fuels", "Gaseous fuels", "Butane", None, None, "Butane", "GLOBAL"),
    ("c5", "WTT- fuels", "Petrol stations", "Petrol", None, None, "WTT- Petrol", "GLOBAL"),
    ("drop", "Managed assets", "Managed cars", "Car", None, None, "<dropped>", "GLOBAL"),
]


@pytest.fixture
def catalog_rules(spark):
    return CatalogRules(
        overrides=spark.createDataFrame(
            [("Managed assets", "Managed cars", True), ("Managed assets", "Managed cars", True)],
            "category string, sub_category string, should_drop boolean"),
        category_map=spark.createDataFrame(
            [("Passenger vehicles", "Transport"), ("Waste disposal", "Waste"), ("Fuels", "Energy")],
            "category_old string, category_new string"),
        sub_category_map=spark.createDataFrame(
            [("Cars (by size)", "Cars"), ("HGV (all diesel)", "Heavy Goods Vehicles"),
             ("Cargo ship", "Cargo Ship"), ("WTT- cargo ship", "WTT- Cargo Ship"),
             ("Electricity: UK", "Electricity")],
            "sub_category_old string, sub_category_new string"),
        name_rules=CATALOG_NAME_RULES,
        territory=CATALOG_TERRITORY,
        rewrite_category=CATALOG_REWRITE_CATEGORY,
    )


def staged_catalog(spark):
    data = [(c[0], c[3], c[2], c[1], c[4], c[5], "GLOBAL") for c in CASES]
    return spark.createDataFrame(data, STAGED).withColumns({
        "gCO2e_per_unit": F.lit(1.0), "unit": F.lit("kWh"), "ghg_scope": F.lit("Scope 1"),
        "source": F.lit("defra"), "source_year": F.lit(2024),
        "valid_from": F.lit("2024-01-01").cast("date"), "valid_to": F.lit("2024-12-31").cast("date")})


def test_reference_rule_table(spark, catalog_rules):
    out = {r["id"]: r for r in clean_catalog(staged_catalog(spark), catalog_rules).collect()}
    assert "drop" not in out
    for case in CASES:
        if case[0] == "drop":
            continue
        assert out[case[0]]["factor_name"] == case[6], case[0]
        assert out[case[0]]["country_code"] == case[7], case[0]


def test_key_rewrite_happens_after_the_drop_list(spark, catalog_rules):
    m = {r["id"]: r for r in map_catalog(staged_catalog(spark), catalog_rules).collect()}
    assert m["c5"]["sub_category"] == "WTT- fuels"
    assert m["r2"]["sub_category_new"] == "Cars" and m["r12"]["category_new"] == "Energy"


def test_description_skips_nulls(spark, catalog_rules):
    out = {r["id"]: r for r in clean_catalog(staged_catalog(spark), catalog_rules).collect()}
    assert out["r2"]["description"] == "GHG Emission factor for Cars belonging to category Transport"
    assert out["r1"]["description"] == "GHG Emission factor for Hotel stay belonging to category Hotel"


RULED = "category string, sub_category string, sub_sub_category string, column_text string, factor_name string, category_new string, sub_category_new string, fields int"


def ruled_rows(n, seed):
    import random

    rng = random.Random(seed)
    pick = lambda: rng.choice(["Gas", "Fuel oil", "WTT", "UK ", "", None, "x{y}", "a|b"])
    return [(*[pick() for _ in range(7)], i) for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_rule_table_equals_the_case(spark, seed):
    import random

    from greenledger.operators.rules import NameRule, apply_name_rules, apply_rule_table, rule_table

    rng = random.Random(seed)
    tests = ["name", "sub", "sub_orig", "category_new", "level4", "text"]
    rules = [NameRule(rng.choice(tests), tuple(rng.sample(["Gas", "Fuel oil", "WTT", "UK ", "", "other"], rng.randint(1, 3))),
                      rng.choice(["{sub} - {name}", "plain", "{text}", "{sub_orig_lower_first}: {level4}!", "", "{name}{name}"])) for _ in range(12)]
    df = spark.createDataFrame(ruled_rows(300, seed), RULED)
    for mine in (rules, rules[:1], [], CATALOG_NAME_RULES):
        want = apply_name_rules(df, list(mine))
        got = apply_rule_table(df, rule_table(spark, list(mine)))
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_ten_thousand_rules(spark):
    from greenledger.operators.rules import NameRule, apply_rule_table, rule_table

    rules = [NameRule("sub_orig" if i % 2 else "text", (f"v{i % 6000}",), f"rule {i} {{name}}") for i in range(10_000)]
    df = spark.range(6000).selectExpr("'c' AS category", "concat('v', id) AS sub_category", "CAST(NULL AS STRING) AS sub_sub_category",
                                      "concat('v', (id + 1) % 6000) AS column_text", "concat('n', id) AS factor_name",
                                      "CAST(NULL AS STRING) AS category_new", "CAST(NULL AS STRING) AS sub_category_new")
    out = apply_rule_table(df, rule_table(spark, rules))
    first = {}
    for i, r in enumerate(rules):
        first.setdefault((r.test, r.values[0]), i)
    for r in out.collect():
        i = int(r["sub_category"][1:])
        hits = [first[k] for k in (("sub_orig", f"v{i}"), ("text", f"v{(i + 1) % 6000}")) if k in first]
        assert r["factor_name"] == (f"rule {min(hits)} n{i}" if hits else f"n{i}")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 2 and plan.count("CASE WHEN") < 12


def test_rule_table_refuses_unknown_fields(spark):
    from greenledger.operators.rules import NameRule, rule_table

    for rule in (NameRule("nope", ("a",), "x"), NameRule("name", ("a",), "{nope}")):
        with pytest.raises(KeyError, match="unknown"):
            rule_table(spark, [rule])
