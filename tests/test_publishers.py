import pytest

from greenledger.contracts import CATALOG, SERIES
from greenledger.operators.validate import enforce, validate
from greenledger.plans.build import build_and_publish, publisher_registry
from greenledger.plans.clean import CatalogRules
from greenledger.sources.publish import current_version, read_snapshot
from greenledger.sources.publishers import read_catalog_export, read_series_sheets
from tests.conftest import rows


def write(path, text):
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write(text)
    return path


def test_catalog_export(spark, tmp_dir):
    p = write(f"{tmp_dir}/cat.csv",
              "ID, Scope ,Level 1,Level 2,Level 3,Level 4,Column Text,UOM,GHG/Unit,GHG Conversion Factor 2024\n"
              "1,Scope 1,Fuels,Gas,Butane,,,tonnes,kg CO2e,2.5\n"
              ",,,,,,,,,\n"
              "2,Scope 1,Fuels,Gas,,,,tonnes,kg CO2e,1.0\n")
    df = read_catalog_export(spark, p, 2024)
    assert "Scope" in df.columns and "GHG Conversion Factor" in df.columns
    valid = enforce(validate(df, CATALOG))
    assert rows(valid, "ID", "Level 3", "GHG Conversion Factor", "year") == [
        ("1", "Butane", 2.5, 2024), ("2", "Gas", 1.0, 2024)]


def test_catalog_export_without_factor_column_is_empty(spark, tmp_dir):
    p = write(f"{tmp_dir}/cat.csv", "ID,Level 1\n1,Fuels\n")
    assert read_catalog_export(spark, p, 2024).count() == 0


def test_series_sheets(spark, tmp_dir):
    sheets = {
        "Varedeklarasjon": write(f"{tmp_dir}/a.csv", " År ,co2,Note\n2023,8.0,x\n2024,7.0,y\n"),
        "Klimadeklarasjon 2024": write(f"{tmp_dir}/b.csv", "AR,CO2\n2024,19.0\n"),   # no year header: skipped
        "KLIMADEKLARASJON": write(f"{tmp_dir}/c.csv", "år,CO2\n2024,19.0\n"),
        "Readme": write(f"{tmp_dir}/d.csv", "År,CO2\n1,1\n"),                          # unknown sheet
    }
    df = read_series_sheets(spark, sheets)
    assert rows(df) == [("2023", "8.0", "Market-based"), ("2024", "19.0", "Location-based"),
                        ("2024", "7.0", "Market-based")]
    assert enforce(validate(df, SERIES)).count() == 3


def test_series_without_usable_sheet_fails(spark, tmp_dir):
    with pytest.raises(ValueError, match="no usable sheet"):
        read_series_sheets(spark, {"Readme": write(f"{tmp_dir}/d.csv", "År,CO2\n1,1\n")})


def publishers(spark, tmp_dir, factor="2.5", product_factor="120"):
    registry = publisher_registry(
        write(f"{tmp_dir}/products.csv",
              "Federation,__id,Produit à l'unité,Facteur d'émission,Incertitude en %,CodeFede,Remarques\n"
              f"ALPHA,1,Corde (geC/pièce),{product_factor},0.2,7,\nALPHA,2,Vide,,,7,\n"),
        {y: write(f"{tmp_dir}/cat{y}.csv",
                  f"Scope ,ID,Level 1,Level 2,Level 3,Level 4,Column Text,UOM,GHG/Unit,GHG Conversion Factor {y}\n"
                  f"Scope 1,{y},Fuels,Gas,Butane,,,tonnes,kg CO2e,{factor}\nScope 1,x,Fuels,Gas,Butane,,,tonnes,kg CO2e,-1\n")
         for y in (2023, 2024)},
        {"Varedeklarasjon": write(f"{tmp_dir}/a.csv", " År ,co2\n2023,8.0\n2024,7.0\n")})
    rules = CatalogRules(
        spark.createDataFrame([], "category string, sub_category string, should_drop boolean"),
        spark.createDataFrame([("Fuels", "Energy")], "category_old string, category_new string"),
        spark.createDataFrame([], "sub_category_old string, sub_category_new string"))
    translations = spark.createDataFrame([("Corde (geC/pièce)", "Rope (gCO2e/piece)", None)],
                                         "factor_name_fr string, factor_name_en string, federation string")
    return registry, translations, rules


def test_publisher_files_to_a_published_dimension(spark, tmp_dir):
    registry, translations, rules = publishers(spark, tmp_dir)
    target = f"{tmp_dir}/gold"
    done = build_and_publish(spark, registry, f"{tmp_dir}/bronze", translations, rules, target).first()
    assert tuple(done) == (5, 5, True)
    got = rows(read_snapshot(spark, target), "source", "factor_name", "gCO2e_per_unit", "source_year", "is_current")
    assert got == [("ademe", "Rope", 120.0, 2016, True), ("defra", "Butane", 2500.0, 2023, False),
                   ("defra", "Butane", 2500.0, 2024, True), ("nve", "Electricity (Market-based)", 7.0, 2024, True),
                   ("nve", "Electricity (Market-based)", 8.0, 2023, False)]


def test_a_failing_source_publishes_nothing(spark, tmp_dir):
    registry, translations, rules = publishers(spark, tmp_dir, product_factor="-3")
    with pytest.raises(RuntimeError, match="ademe: .*1 / 2 rows invalid"):
        build_and_publish(spark, registry, f"{tmp_dir}/bronze", translations, rules, f"{tmp_dir}/gold")
    assert current_version(spark, f"{tmp_dir}/gold") is None


def test_a_failing_check_publishes_nothing(spark, tmp_dir):
    registry, translations, rules = publishers(spark, tmp_dir)
    from greenledger.operators import checks as ck
    from greenledger.plans.build import suites
    declared = suites() | {"stg_catalog": [ck.expression("gCO2e_per_unit", "gCO2e_per_unit < 1000")]}
    with pytest.raises(AssertionError, match=r"stg_catalog.expression\(gCO2e_per_unit < 1000\)=2"):
        build_and_publish(spark, registry, f"{tmp_dir}/bronze", translations, rules, f"{tmp_dir}/gold", declared)
    assert current_version(spark, f"{tmp_dir}/gold") is None
