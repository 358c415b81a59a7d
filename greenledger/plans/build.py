"""The gated build: ingest, stage, clean, dimension, checks, publish.

Publishing happens only behind a passing run: every source must ingest, every
declared check of the staged models and of the dimension must pass, and the
published rows must match the dimension's count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from greenledger.contracts import CATALOG, PRODUCTS, SERIES
from greenledger.operators import checks as ck
from greenledger.operators.dimension import build_dimension
from greenledger.plans.clean import CatalogRules, clean_catalog, clean_products, clean_series, conform_all
from greenledger.plans.ingest import SourceSpec, all_ok, run_sources
from greenledger.plans.staging import PRODUCTS_EDITION_YEAR, stage_catalog, stage_products, stage_series
from greenledger.sources.bronze import read_publisher_csv, scan_bronze
from greenledger.sources.publish import publish_snapshot, read_snapshot, reconcile_written
from greenledger.sources.publishers import read_catalog_export, read_series_sheets
from greenledger.tables import written

MODELS = ("stg_series", "stg_products", "stg_catalog", "dim_factors")


def publisher_registry(products: str, catalog: dict[int, str], sheets: dict[str, str]) -> dict[str, SourceSpec]:
    """The three sources as their publishers deliver them: the product list's CSV,
    the catalog's export of each edition year, the series workbook's sheets by name."""
    def read_catalog(spark: SparkSession) -> DataFrame:
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                      [read_catalog_export(spark, path, year) for year, path in sorted(catalog.items())])

    return {
        "ademe": SourceSpec("ademe", lambda s: read_publisher_csv(s, products), PRODUCTS, fixed_year=PRODUCTS_EDITION_YEAR),
        "defra": SourceSpec("defra", read_catalog, CATALOG),
        "nve": SourceSpec("nve", lambda s: read_series_sheets(s, sheets), SERIES),
    }


def suites() -> dict[str, list]:
    """The declared checks of each model."""
    return dict(zip(MODELS, (ck.series_suite(), ck.products_suite(), ck.catalog_suite(), ck.gold_suite())))


def check_models(models: dict[str, DataFrame], declared: dict[str, list] | None = None) -> DataFrame:
    """One row per declared check of the given models."""
    declared = declared or suites()
    out = None
    for name, df in models.items():
        one = ck.run_checks(df, name, declared[name])
        out = one if out is None else out.unionByName(one)
    return out


def publish_checked(dim: DataFrame, results: DataFrame, target: str) -> DataFrame:
    """Publish ``dim`` if every check in ``results`` passed; else raise and
    publish nothing. Returns the reconciliation row (src_rows, dst_rows, matched)."""
    ck.assert_checks(results)
    rows = publish_snapshot(dim, target)
    return reconcile_written(dim.sparkSession, rows, read_snapshot(dim.sparkSession, target))


def build_and_publish(spark: SparkSession, registry: dict[str, SourceSpec], bronze_root: str,
                      translations: DataFrame, rules: CatalogRules, target: str,
                      declared: dict[str, list] | None = None) -> DataFrame:
    """The whole flow for the three publishers' sources; see the module text.

    Each staged relation and the dimension are written once, and checks and
    publishing read the written tables.
    """
    names = ["defra", "ademe", "nve"]
    report = run_sources(spark, registry, bronze_root, names, max_parallel=len(names))
    if not all_ok(report).first()["ok"]:
        bad = [f"{r['source']}: {r['reason']}" for r in report.where("status <> 'ok'").collect()]
        raise RuntimeError("ingestion failed, nothing published\n" + "\n".join(bad))

    def bronze(name):
        contract = registry[name].contract
        return scan_bronze(spark, bronze_root, name, contract.names + list(contract.keep))

    cat = written(stage_catalog(bronze("defra")), "stg-catalog")
    prod = written(stage_products(bronze("ademe")), "stg-products")
    ser = written(stage_series(bronze("nve")), "stg-series")
    dim = written(build_dimension(conform_all(clean_catalog(cat, rules), clean_series(ser),
                                              clean_products(prod, translations))), "dim")
    results = check_models(dict(zip(MODELS, (ser, prod, cat, dim))), declared)
    return publish_checked(dim, written(results, "checks"), target)
