import pytest

from greenledger.contracts import CATALOG, PRODUCTS, SERIES
from greenledger.operators.validate import (
    STATUS,
    ContractError,
    enforce,
    error_sample,
    validate,
)
from tests.conftest import rows

PRODUCT_COLS = ["__id", "Produit à l'unité", "Facteur d'émission", "Incertitude en %",
                "CodeFede", "Federation", "Remarques"]

# Invented rows covering FIXTURES.md section 1.
PRODUCT_ROWS = [
    ("1", "Corde (geC/pièce)", "120", "0.2", "7", "ALPHA", ""),
    ("2", "Sac (geC/pièce)", "80", "", "7", "ALPHA", None),
    ("3", "Sac (geC/pièce)", "90", " ", "8", "BETA", "note"),
    ("4", "Banc (kgeC/pièce)", "5", "0.1", "8", "BETA", ""),
    ("5", "Échelle", "11", "", "8", "BETA", "x"),
    ("6", "Tapis (grand) (kgeC/pièce)", "3", "", "7", "ALPHA", ""),
    ("7", "Vide", "", "", "7", "ALPHA", ""),          # blank factor: skipped
    ("8", "Zero", "0", "", "7", "ALPHA", ""),          # factor must be > 0
    ("9", "Texte", "abc", "", "7", "ALPHA", ""),       # not a number
    ("10", "Incertain", "4", "1.5", "7", "ALPHA", ""),  # uncertainty > 1
    ("11", "SansFede", "4", "", "7", " ", ""),         # blank federation
    (" ", "SansId", "4", "", "7", "ALPHA", ""),        # blank id
]


def products(spark, data=PRODUCT_ROWS, cols=PRODUCT_COLS):
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in cols))


def test_statuses_and_all_violations(spark):
    v = validate(products(spark), PRODUCTS)
    got = {r["__id"]: (r[STATUS], list(r["violations"])) for r in v.annotated.collect()}
    assert got["1"] == ("valid", [])
    assert got["7"] == ("skipped", [])
    assert got["8"] == ("invalid", ["Facteur d'émission: must be > 0"])
    assert got["9"] == ("invalid", ["Facteur d'émission: not a valid double"])
    assert got["10"] == ("invalid", ["Incertitude en %: must be >= 0 and <= 1"])
    assert got["11"] == ("invalid", ["Federation: must be non-blank"])
    assert got[" "] == ("invalid", ["__id: must be non-blank"])


def test_valid_rows_are_typed_and_blank_is_null(spark):
    v = validate(products(spark), PRODUCTS)
    valid = {r["__id"]: r for r in v.valid.collect()}
    assert set(valid) == {"1", "2", "3", "4", "5", "6"}
    assert valid["1"]["Facteur d'émission"] == 120.0
    assert valid["2"]["Incertitude en %"] is None
    assert valid["3"]["Incertitude en %"] is None      # whitespace only -> NULL
    assert valid["1"]["Remarques"] is None             # blank -> NULL
    assert valid["3"]["Remarques"] == "note"


def test_summary_partitions_the_input(spark):
    v = validate(products(spark), PRODUCTS)
    s = v.summary().first()
    assert (s["total"], s["valid"], s["invalid"], s["skipped"]) == (12, 6, 5, 1)
    assert s["valid"] + s["invalid"] + s["skipped"] == s["total"]
    assert v.rejected.count() == 5


def test_strict_policy_fails_with_sample(spark):
    v = validate(products(spark), PRODUCTS)
    with pytest.raises(ContractError) as e:
        enforce(v, key="__id")
    msg = str(e.value)
    assert "5 / 12 rows invalid" in msg
    assert "row 10: Incertitude en %: must be >= 0 and <= 1" in msg


def test_strict_policy_sample_is_capped_with_remainder(spark):
    data = [(str(i), "n", "-1", "", "1", "F", "") for i in range(30)]
    v = validate(products(spark, data), PRODUCTS)
    with pytest.raises(ContractError) as e:
        enforce(v, key="__id", n=20)
    assert "... and 10 more row(s) with errors" in str(e.value)


def test_strict_policy_empty_input_fails(spark):
    v = validate(products(spark, []), PRODUCTS)
    with pytest.raises(ContractError, match="empty"):
        enforce(v)


def test_strict_policy_passes_clean_input(spark):
    v = validate(products(spark, PRODUCT_ROWS[:7]), PRODUCTS)
    assert enforce(v).count() == 6


def test_missing_column_that_must_exist(spark):
    cols = PRODUCT_COLS[:-1]
    data = [r[:-1] for r in PRODUCT_ROWS[:2]]
    v = validate(products(spark, data, cols), PRODUCTS)
    got = [list(r["violations"]) for r in v.annotated.collect()]
    assert all(x == ["Remarques: field required"] for x in got)


def test_unknown_columns_are_ignored(spark):
    cols = PRODUCT_COLS + ["extra"]
    data = [r + ("zzz",) for r in PRODUCT_ROWS[:2]]
    v = validate(products(spark, data, cols), PRODUCTS)
    assert v.valid.count() == 2 and "extra" not in v.valid.columns


CAT_COLS = ["ID", "Level 1", "Level 2", "Level 3", "Level 4", "Column Text",
            "GHG Conversion Factor", "UOM", "Scope", "GHG/Unit", "year"]


def catalog(spark, data):
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in CAT_COLS))


def test_catalog_lenient_fill_and_ranges(spark):
    data = [
        ("a", "Fuels", "Gas", "", "", " ", "2.5", "kWh", "Scope 1", "kg CO2e", "2024"),
        ("b", "Fuels", "Gas", "Propane", "NaN?", None, "-1", "kWh", "Scope 1", "kg CO2e", "2024"),
        ("c", "Fuels", "Gas", "Propane", None, None, "1", "kWh", "Scope 1", "kg CO2e", "1999"),
        ("d", "Fuels", "Gas", "Propane", None, None, "", "kWh", "Scope 1", "kg CO2e", "2024"),
        ("e", "Fuels", "Gas", "Propane", None, None, "0", "kWh", "Scope 1", "kg CO2e", "2024"),
    ]
    v = validate(catalog(spark, data), CATALOG)
    st = {r["ID"]: (r[STATUS], list(r["violations"])) for r in v.annotated.collect()}
    assert st["a"] == ("valid", [])
    assert st["b"] == ("invalid", ["GHG Conversion Factor: must be >= 0"])
    assert st["c"] == ("invalid", ["year: must be >= 2000 and <= 2100"])
    assert st["d"] == ("skipped", [])
    assert st["e"] == ("valid", [])            # zero is a legitimate factor
    a = [r for r in v.valid.collect() if r["ID"] == "a"][0]
    assert a["Level 3"] == "Gas"               # filled from level 2
    assert a["Level 4"] is None and a["Column Text"] is None
    assert a["year"] == 2024 and a["GHG Conversion Factor"] == 2.5
    assert enforce(v).count() == 2             # lenient: never raises


def test_series_contract(spark):
    df = spark.createDataFrame([("2023", 12.5, "Market-based"), ("1990", 1.0, "X"),
                                ("2024", -1.0, " ")], "year string, co2_per_kWh double, factor_type string")
    v = validate(df, SERIES)
    got = rows(v.annotated.select("year", STATUS))
    assert got == [("1990", "invalid"), ("2023", "valid"), ("2024", "invalid")]
    bad = [list(r["violations"]) for r in v.rejected.collect() if r["year"] == "2024"][0]
    assert bad == ["co2_per_kWh: must be >= 0", "factor_type: must be non-blank"]


def test_error_sample_orders_by_key(spark):
    v = validate(products(spark), PRODUCTS)
    keys = [r["__id"] for r in error_sample(v.rejected, "__id", 3).collect()]
    assert keys == [" ", "10", "11"]


def test_blank_skip_and_fill_policies(spark):
    """Blank means white space of any kind; a catalog row is skipped, and its
    level filled, only when the cell is empty."""
    ok = {"ID": "1", "Level 1": "a", "Level 2": "b", "Level 3": "c", "Level 4": None, "Column Text": None,
          "GHG Conversion Factor": "1", "UOM": "kWh", "Scope": "s", "GHG/Unit": "kg", "year": "2024"}
    rows = [ok | {"ID": v} for v in (" ", "\t", "\u00a0", "\u3000\n")]
    rows += [ok | {"ID": "skip", "GHG Conversion Factor": v} for v in (None, "")]
    rows += [ok | {"ID": "bad", "GHG Conversion Factor": v} for v in (" ", "\t")]
    rows += [ok | {"ID": "filled", "Level 3": v} for v in (None, "")] + [ok | {"ID": "unfilled", "Level 3": " "}]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"`{c}` string" for c in ok))
    from greenledger.contracts import CATALOG, PRODUCTS
    from greenledger.operators.validate import validate
    v = validate(df, CATALOG)
    assert sorted((r["ID"], r["Level 3"]) for r in v.valid.collect()) == [("filled", "b"), ("filled", "b")]
    assert v.summary().first()["skipped"] == 2 and v.rejected.count() == 7
    # Product list: white space skips too, and an empty product name is a value.
    p = {"__id": "1", "Produit à l'unité": None, "Facteur d'émission": "2", "Incertitude en %": "\u00a0", "CodeFede": "1",
         "Federation": "F", "Remarques": "\t"}
    rows = [p, p | {"Facteur d'émission": "\u00a0"}, p | {"CodeFede": "\t"}]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"`{c}` string" for c in p))
    v = validate(df, PRODUCTS)
    got = v.valid.collect()
    assert len(got) == 1 and got[0]["Produit à l'unité"] == "" and got[0]["Incertitude en %"] is None and got[0]["Remarques"] is None
    assert tuple(v.summary().first())[1:] == (3, 1, 1, 1)
    assert validate(df.drop("Produit à l'unité"), PRODUCTS).summary().first()["valid"] == 0
