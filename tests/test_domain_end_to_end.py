"""Invented publisher rows (FIXTURES.md) through the whole flow:
validate -> land bronze -> scan -> stage -> clean -> union -> dimension ->
checks -> publish -> reconcile, with expected values worked out by hand
(rounded values are taken from DuckDB, the reference's engine)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from greenledger.contracts import CATALOG, PRODUCTS, SERIES
from greenledger.functions.scalars import surrogate_key
from greenledger.operators import checks as ck
from greenledger.operators.dimension import build_dimension, order_gold
from greenledger.operators.validate import ContractError
from greenledger.plans.clean import (
    CatalogRules,
    clean_catalog,
    clean_products,
    clean_series,
    conform_all,
)
from greenledger.plans.ingest import SourceSpec, run_sources
from greenledger.plans.reference_rules import (
    CATALOG_NAME_RULES,
    CATALOG_REWRITE_CATEGORY,
    CATALOG_TERRITORY,
)
from greenledger.plans.staging import stage_catalog, stage_products, stage_series
from greenledger.sources.bronze import scan_bronze
from greenledger.plans.build import publish_checked
from greenledger.sources.publish import current_version, publish_snapshot, read_snapshot, reconcile_counts

D = dt.date

PRODUCTS_ROWS = [
    ("1", "Corde (geC/pièce)", "120", "0.2", "7", "ALPHA", ""),
    ("2", "Sac (geC/pièce)", "80", "", "7", "ALPHA", ""),
    ("3", "Sac (geC/pièce)", "90", "", "8", "BETA", ""),
    ("4", "Banc (kgeC/pièce)", "5", "0.1", "8", "BETA", ""),
    ("5", "Échelle", "11", "", "8", "BETA", "x"),
    ("6", "Tapis (grand) (kgeC/pièce)", "3", "", "7", "ALPHA", ""),
    ("7", "Vide", "", "", "7", "ALPHA", ""),
]
TRANSLATIONS = [
    ("Corde (geC/pièce)", "Rope (gCO2e/piece)", None),
    ("Sac (geC/pièce)", "Bag (gCO2e/piece)", None),
    ("Sac (geC/pièce)", "Kit bag (gCO2e/piece)", "BETA"),
    ("Banc (kgeC/pièce)", "Bench (kgCO2e/piece)", "BETA"),
]
CAT_ROWS = [
    # ID, L1, L2, L3, L4, text, factor, UOM, scope, GHG/Unit, year
    ("10", "Fuels", "Gaseous fuels", "Butane", None, None, "2.0035", "tonnes", "Scope 1", "kg CO2e", "2023"),
    ("10", "Fuels", "Gaseous fuels", "Butane", None, None, "0.5005", "tonnes", "Scope 1", "kg CO2e", "2024"),
    ("11", "Fuels", "Gaseous fuels", "Butane", None, None, "1.0005", "litres", "Scope 1", "kg CO2e", "2024"),
    ("12", "Fuels", "Gaseous fuels", "Butane", None, None, "9.0", "tonnes", "Scope 1", "kg CO2", "2024"),
    ("13", "Passenger vehicles", "Cars (by size)", "Small car", None, "Diesel", "0.14", "km", "Scope 1", "kg CO2e", "2024"),
    ("14", "Passenger vehicles", "Cars (by size)", "Small car", None, None, "0.15", "km", "Scope 1", "kg CO2e", "2024"),
    ("15", "UK electricity", "Electricity: UK", "", None, None, "0.2", "kWh", "Scope 2", "kg CO2e", "2024"),
    ("16", "Managed assets", "Managed cars", "Car", None, None, "0.3", "km", "Scope 1", "kg CO2e", "2024"),
    ("17", "Fuels", "Gaseous fuels", "Propane", None, None, "-1", "tonnes", "Scope 1", "kg CO2e", "2024"),
    ("18", "Fuels", "Gaseous fuels", "Propane", None, None, "1.5", "tonnes", "Scope 1", "kg CO2e", "1999"),
    ("20", "Fuels", "Liquid fuels", "Diesel", None, None, "2.5", "litres", "Scope 1", "kg CO2e", "2024"),
    ("19", "Fuels", "Liquid fuels", "Diesel", None, None, "2.6", "litres", "Scope 1", "kg CO2e", "2024"),
]
SERIES_ROWS = [("2023", "8.0", "Market-based"), ("2024", "7.0", "Market-based"),
               ("2024", "19.0", "Location-based")]


def text_frame(spark, data, cols):
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in cols))


@pytest.fixture(scope="module")
def flow(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="gl-domain-")
    reg = {
        "ademe": SourceSpec("ademe", lambda s: text_frame(s, PRODUCTS_ROWS, PRODUCTS.names), PRODUCTS,
                            fixed_year=2016),
        "defra": SourceSpec("defra", lambda s: text_frame(s, CAT_ROWS, CATALOG.names), CATALOG),
        "nve": SourceSpec("nve", lambda s: text_frame(s, SERIES_ROWS, SERIES.names), SERIES),
    }
    report = {r["source"]: r["status"] for r in run_sources(spark, reg, root).collect()}
    assert report == {"ademe": "ok", "defra": "ok", "nve": "ok"}
    bronze = {n: scan_bronze(spark, root, n, reg[n].contract.names) for n in reg}
    rules = CatalogRules(
        overrides=spark.createDataFrame([("Managed assets", "Managed cars", True)],
                                        "category string, sub_category string, should_drop boolean"),
        category_map=spark.createDataFrame([("Fuels", "Energy"), ("Passenger vehicles", "Transport")],
                                           "category_old string, category_new string"),
        sub_category_map=spark.createDataFrame([("Cars (by size)", "Cars"), ("Electricity: UK", "Electricity")],
                                               "sub_category_old string, sub_category_new string"),
        name_rules=CATALOG_NAME_RULES, territory=CATALOG_TERRITORY,
        rewrite_category=CATALOG_REWRITE_CATEGORY)
    tr = spark.createDataFrame(TRANSLATIONS, "factor_name_fr string, factor_name_en string, federation string")
    sp, sc, ss = stage_products(bronze["ademe"]), stage_catalog(bronze["defra"]), stage_series(bronze["nve"])
    conformed = conform_all(clean_catalog(sc, rules), clean_series(ss), clean_products(sp, tr))
    dim = order_gold(build_dimension(conformed))
    return {"root": root, "staged": (sp, sc, ss), "dim": dim,
            "rows": {(r["source"], r["ef_id"], r["factor_name"]): r for r in dim.collect()}}


def key(spark, *parts):
    return spark.range(1).select(surrogate_key(*[F.lit(p) for p in parts]).alias("k")).first()["k"]


def find(flow, source, name):
    return sorted((r for (s, _, n), r in flow["rows"].items() if s == source and n == name),
                  key=lambda r: (r["valid_from"], r["ef_id"]))


def test_products(spark, flow):
    rope = find(flow, "ademe", "Rope")[0]
    assert rope["ef_id"] == key(spark, "ademe", "1")
    assert rope["gCO2e_per_unit"] == 120.0 and rope["uncertainty_pct"] == 0.2
    assert rope["description"] == "Cradle-to-gate GHG emissions from the production of rope"
    assert rope["valid_to"] == D(9999, 12, 31) and rope["source_year"] == 2016
    # generic + specific translation for BETA: the row fans out to two names
    assert {r["factor_name"] for r in flow["dim"].where("ef_id = '%s'" % key(spark, "ademe", "3")).collect()} \
        == {"Bag", "Kit bag"}
    assert find(flow, "ademe", "Bench")[0]["gCO2e_per_unit"] == 5000.0   # kilograms -> grams
    assert find(flow, "ademe", "Échelle")[0]["description"].endswith("production of échelle")
    assert find(flow, "ademe", "Tapis (grand)")[0]["gCO2e_per_unit"] == 3000.0
    assert not find(flow, "ademe", "Vide")                                 # skipped at ingestion


def test_catalog_rounding_editions_and_rules(spark, flow):
    butane = find(flow, "defra", "Butane")
    by_unit = {(r["unit"], r["source_year"]): r for r in butane}
    import duckdb
    want = duckdb.connect().execute(
        "select round(2.0035::double, 3) * 1000.0, round(0.5005::double, 3) * 1000.0, "
        "round(1.0005::double, 3) * 1000.0").fetchone()
    got = tuple(by_unit[k]["gCO2e_per_unit"] for k in (("tonnes", 2023), ("tonnes", 2024), ("litres", 2024)))
    assert got == want
    assert got[0] == 2003.0                                          # scale-then-round, not 2004
    assert by_unit[("tonnes", 2024)]["is_current"] and not by_unit[("tonnes", 2023)]["is_current"]
    assert by_unit[("litres", 2024)]["is_current"]                   # own (name, unit) group
    assert len(butane) == 3                                          # kg CO2 row filtered out
    assert find(flow, "defra", "Small car - Diesel")[0]["category"] == "Transport"
    assert find(flow, "defra", "Cars")[0]["ef_id"] == key(spark, "defra", "14", "2024")  # NULL name -> sub
    elec = find(flow, "defra", "Electricity")[0]
    assert elec["country_code"] == "GB" and elec["sub_category"] == "Electricity"
    assert not find(flow, "defra", "Car") and not find(flow, "defra", "Propane")   # drop-list, invalid rows
    diesel = find(flow, "defra", "Diesel")
    assert [r["is_current"] for r in sorted(diesel, key=lambda r: r["ef_id"])] == \
        [r["ef_id"] == min(x["ef_id"] for x in diesel) for r in sorted(diesel, key=lambda r: r["ef_id"])]


def test_series(spark, flow):
    mb = find(flow, "nve", "Electricity (Market-based)")
    assert [(r["source_year"], r["gCO2e_per_unit"], r["is_current"]) for r in mb] == \
        [(2023, 8.0, False), (2024, 7.0, True)]
    assert mb[0]["description"] == \
        "GHG Emission factor for Electricity (Market-based) belonging to category Energy"
    assert mb[0]["ef_id"] == key(spark, "nve", "market-based", "2023")


def test_checks_and_publish(spark, flow):
    sp, sc, ss = flow["staged"]
    res = {(r["model"], r["check"], r["column"]): r for r in
           ck.run_checks(flow["dim"], "dim", ck.gold_suite())
           .unionByName(ck.run_checks(sc, "stg_d", ck.catalog_suite())).collect()}
    failed = {k: v["failing"] for k, v in res.items() if not v["passed"]}
    # The fanned-out product row repeats its key: exactly one unique-check failure.
    assert failed == {("dim", "unique", "ef_id"): 1}
    target = flow["root"] + "/gold"
    assert publish_snapshot(flow["dim"], target) == flow["dim"].count()
    assert reconcile_counts(flow["dim"], read_snapshot(spark, target)).first()["matched"]
    # Behind the gate that failing check publishes nothing, and is named.
    gated = flow["root"] + "/gated"
    with pytest.raises(AssertionError, match=r"dim.unique\(ef_id\)=1"):
        publish_checked(flow["dim"], ck.run_checks(flow["dim"], "dim", ck.gold_suite()), gated)
    assert current_version(spark, gated) is None
    passing = [c for c in ck.gold_suite() if c.kind != "unique"]
    assert publish_checked(flow["dim"], ck.run_checks(flow["dim"], "dim", passing), gated).first()["matched"]


def test_strict_source_failure_is_reported(spark):
    import tempfile
    bad = PRODUCTS_ROWS + [("8", "Zero", "0", "", "7", "ALPHA", "")]
    reg = {"ademe": SourceSpec("ademe", lambda s: text_frame(s, bad, PRODUCTS.names), PRODUCTS, fixed_year=2016)}
    rep = run_sources(spark, reg, tempfile.mkdtemp()).first()
    assert rep["status"] == "error"
    assert "1 / 8 rows invalid" in rep["reason"]
    with pytest.raises(ContractError):
        from greenledger.operators.validate import enforce, validate
        enforce(validate(text_frame(spark, bad, PRODUCTS.names), PRODUCTS))
