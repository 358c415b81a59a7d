"""Registered queries: every operator of the inventory run on the driver's
tables through the stand-ins (see ``standins``). Each function takes
(spark, sf_dir) and returns a DataFrame over the whole input tables.
"""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from greenledger.contracts import CATALOG, PRODUCTS, SERIES, Contract
from greenledger.functions.scalars import (
    concat_nulls,
    concat_skip_nulls,
    lower_first,
    scale_if_kilogram,
    strip_trailing_group,
)
from greenledger.operators import checks as ck
from greenledger.operators.asof import asof_fallback
from greenledger.operators.dimension import (
    build_dimension,
    current_only,
    gold_columns,
    order_gold,
    prepare,
    rank_editions,
)
from greenledger.operators.lookups import drop_listed, map_values, unmatched_keys, wildcard_lookup
from greenledger.operators.rules import apply_name_rules, apply_rule_table, assign_country, rewrite_sub_category, rule_table
from greenledger.operators.usage import activity_factor_join, geo_fallback
from greenledger.operators.validate import (
    VIOLATIONS,
    blank_to_null,
    error_sample,
    fill_from_parent,
    validate,
)
from greenledger.plans import standins as si
from greenledger.plans.build import check_models, publish_checked
from greenledger.plans.clean import clean_catalog, clean_products, clean_series, conform_all, map_catalog
from greenledger.plans.ingest import SourceSpec, all_ok, ingest_source, run_sources
from greenledger.plans.staging import (
    PRODUCTS_EDITION_YEAR,
    stage_catalog,
    stage_products,
    stage_series,
)
from greenledger.session import work_dir
from greenledger.streaming.incremental import land_arrivals, landing_summary, run_until_caught_up
from greenledger.sources.bronze import (
    CSV_OPTIONS,
    distinct_years,
    land_bronze,
    rows_per_year,
    scan_bronze,
    union_tagged_sheets,
    year_slice,
)
from greenledger.sources.dimension_store import merge_into, read_dimension
from greenledger.sources.lookups import load_lookup
from greenledger.sources.publish import (
    check_schema,
    materialise,
    publish_snapshot,
    read_snapshot,
    read_valid_on,
    reconcile_written,
)
from greenledger.sources.publishers import read_catalog_export, read_series_sheets
from greenledger.tables import fresh_path, written

Query = Callable[[SparkSession, str], DataFrame]

# The catalog stand-in carries its source line number for error samples.
CATALOG_ROWS = dataclasses.replace(CATALOG, keep=("row_no",), row_key="row_no")
PRODUCTS_ROWS = dataclasses.replace(PRODUCTS, keep=("row_no",), row_key="row_no")
USABLE_DAY = "2019-06-30"
SLICE_YEAR = 2015


# ---------------------------------------------------------------- building blocks
def catalog_checked(spark, sf):
    return validate(si.catalog_raw(spark, sf), CATALOG_ROWS)


_INGESTED: dict[tuple, str] = {}


def ingested(spark, sf, source: str) -> DataFrame:
    """Bronze rows of one source as the transformation layer sees them:
    validated under the source's contract and landed as per-year CSV, the
    exchange format, by the ingestion runner (once per application and state of
    the input). Staging scans a Parquet copy of it: quoted line breaks make a
    CSV file one task, and a columnar copy is pruned by column and row group."""
    spec = source_registry(sf)[source]
    key = (*si.table_state(spark, sf), source)
    path = _INGESTED.get(key)
    if path is None:
        root = work_dir(spark, f"bronze-{uuid.uuid4().hex}")
        ingest_source(spark, spec, root)
        path = materialise(scan_bronze(spark, root, source, spec.contract.names + list(spec.contract.keep)),
                           fresh_path(spark, f"bronze-copy-{source}"))
        _INGESTED[key] = path
    return spark.read.parquet(path)


def catalog_valid(spark, sf):
    return ingested(spark, sf, "defra")


def products_valid(spark, sf):
    return ingested(spark, sf, "ademe")


def series_valid(spark, sf):
    return ingested(spark, sf, "nve")


def staged(spark, sf):
    return (stage_catalog(catalog_valid(spark, sf)), stage_products(products_valid(spark, sf)),
            stage_series(series_valid(spark, sf)))


def products_std(spark, sf):
    """Staged products with the translated-else-original name as ``std``."""
    j = wildcard_lookup(stage_products(products_valid(spark, sf)), si.translations(spark),
                        "factor_name", "factor_name_fr", "federation", "federation", ["factor_name_en"])
    return j.withColumn("std", F.coalesce("factor_name_en", "factor_name"))


def conformed(spark, sf):
    cat, prod, ser = staged(spark, sf)
    return conform_all(clean_catalog(cat, si.catalog_rules(spark)), clean_series(ser),
                       clean_products(prod, si.translations(spark)))


def dimension(spark, sf):
    return build_dimension(conformed(spark, sf))


# ---------------------------------------------------------------- staging
def q_stage_catalog(spark, sf):
    return stage_catalog(catalog_valid(spark, sf))


def q_stage_products(spark, sf):
    return stage_products(products_valid(spark, sf))


def q_stage_series(spark, sf):
    return stage_series(series_valid(spark, sf))


# ---------------------------------------------------------------- validation
def q_validate_lenient_rows(spark, sf):
    return catalog_checked(spark, sf).valid


def q_validate_rejected(spark, sf):
    return catalog_checked(spark, sf).rejected.withColumn(VIOLATIONS, F.array_join(VIOLATIONS, "; "))


def q_validation_summary(spark, sf):
    return (catalog_checked(spark, sf).summary()
            .unionByName(validate(si.products_raw(spark, sf, dirty=True), PRODUCTS).summary())
            .unionByName(validate(si.series_raw(spark, sf), SERIES).summary()))


def q_error_sample(spark, sf):
    rejected = catalog_checked(spark, sf).rejected
    remaining = rejected.select(F.greatest(F.count(F.lit(1)) - 20, F.lit(0)).cast("bigint")).scalar()
    return (error_sample(rejected, "row_no", 20)
            .select("row_no", "ID", F.array_join(VIOLATIONS, "; ").alias(VIOLATIONS),
                    remaining.alias("remaining")))


def q_parent_fill(spark, sf):
    return fill_from_parent(si.catalog_raw(spark, sf), "Level 3", "Level 2").select(
        "row_no", "Level 2", "Level 3")


def q_blank_to_null(spark, sf):
    cols = ["Incertitude en %", "Remarques"]
    return blank_to_null(si.products_raw(spark, sf), cols).select("__id", *cols)


# ---------------------------------------------------------------- lookups
def _wildcard(spark, sf, fanout):
    return wildcard_lookup(stage_products(products_valid(spark, sf)), si.translations(spark, fanout),
                           "factor_name", "factor_name_fr", "federation", "federation",
                           ["factor_name_en"]).select(
                               "id", "factor_name", "federation", "factor_name_en")


def q_wildcard_lookup(spark, sf):
    return _wildcard(spark, sf, False)


def q_wildcard_fanout(spark, sf):
    return _wildcard(spark, sf, True)


def q_drop_listed(spark, sf):
    rules = si.catalog_rules(spark)
    return drop_listed(stage_catalog(catalog_valid(spark, sf)), rules.overrides,
                       ["category", "sub_category"]).select(
                           "id", "category", "sub_category")


def q_map_category(spark, sf):
    rules = si.catalog_rules(spark)
    kept = drop_listed(stage_catalog(catalog_valid(spark, sf)), rules.overrides,
                       ["category", "sub_category"])
    kept = rewrite_sub_category(kept, rules.rewrite_category)
    return map_values(kept, rules.category_map, "category", "category_old", "category_new").select(
        "id", "category", "sub_category", "category_new")


def q_map_chain(spark, sf):
    return map_catalog(stage_catalog(catalog_valid(spark, sf)), si.catalog_rules(spark)).select(
        "id", "category", "sub_category", "category_new", "sub_category_new")


def q_name_rules(spark, sf):
    rules = si.catalog_rules(spark)
    m = map_catalog(stage_catalog(catalog_valid(spark, sf)), rules)
    return apply_name_rules(m, rules.name_rules).select("id", "factor_name")


def q_rule_table(spark, sf):
    """The naming rules as a table, joined instead of compiled."""
    rules = si.catalog_rules(spark)
    m = map_catalog(stage_catalog(catalog_valid(spark, sf)), rules)
    return apply_rule_table(m, rule_table(spark, rules.name_rules)).select("id", "factor_name")


def q_unmatched_lookup_keys(spark, sf):
    """Sub-categories (after drop-list and key rewrite) with no mapping row:
    the report that exposes near-miss labels between lookup tables."""
    rules = si.catalog_rules(spark)
    kept = drop_listed(stage_catalog(catalog_valid(spark, sf)), rules.overrides,
                       ["category", "sub_category"])
    kept = rewrite_sub_category(kept, rules.rewrite_category)
    return unmatched_keys(kept, rules.sub_category_map, "sub_category", "sub_category_old")


def q_country_rule(spark, sf):
    rules = si.catalog_rules(spark)
    m = map_catalog(stage_catalog(catalog_valid(spark, sf)), rules)
    return assign_country(m, rules.territory).select("id", "country_code")


# ---------------------------------------------------------------- scalar functions
def q_unit_scale(spark, sf):
    p = products_std(spark, sf)
    return p.select("id", F.col("std").alias("factor_name"),
                    scale_if_kilogram("gCO2e_per_unit", "std").alias("gCO2e_per_unit"))


def q_strip_unit_suffix(spark, sf):
    return products_std(spark, sf).select("id", strip_trailing_group("std").alias("factor_name"))


def q_lower_first(spark, sf):
    return products_std(spark, sf).select("id", lower_first("std").alias("factor_name"))


def q_null_concat(spark, sf):
    s = stage_catalog(catalog_valid(spark, sf))
    parts = [F.lit("L4 "), F.col("sub_sub_category"), F.lit(" / "), F.col("column_text")]
    return s.select("id", concat_skip_nulls(*parts).alias("skipped"),
                    concat_nulls(*parts).alias("propagated"))


# ---------------------------------------------------------------- cleaning, union, dimension
def q_clean_products(spark, sf):
    return clean_products(stage_products(products_valid(spark, sf)), si.translations(spark))


def q_clean_catalog(spark, sf):
    return clean_catalog(stage_catalog(catalog_valid(spark, sf)), si.catalog_rules(spark))


def q_clean_series(spark, sf):
    return clean_series(stage_series(series_valid(spark, sf)))


def q_conform_union(spark, sf):
    return conformed(spark, sf)


def q_rank_editions(spark, sf):
    return rank_editions(prepare(conformed(spark, sf)))


def q_flag_current(spark, sf):
    return dimension(spark, sf)


def q_current_only(spark, sf):
    return current_only(prepare(conformed(spark, sf))).select(
        "id", "source", "factor_name", "unit", "source_year", "gCO2e_per_unit")


def q_dim_factors(spark, sf):
    return order_gold(dimension(spark, sf))


def q_incremental_dimension(spark, sf):
    """The dimension made of all editions but the last two years', which then arrive one by one."""
    rows = written(prepare(conformed(spark, sf)), "conformed")
    target = work_dir(spark, f"gold-{uuid.uuid4().hex}", "dim_editions")
    late = sorted(r[0] for r in rows.select("source_year").distinct().collect() if r[0] is not None)[-2:]
    in_time = F.col("source_year").isNull() | ~F.col("source_year").isin(late)
    for part in (in_time, *[F.col("source_year") == year for year in late]):
        merge_into(rows.where(part), target, n_buckets=8)
    return gold_columns(read_dimension(spark, target))


# ---------------------------------------------------------------- checks
def q_check_suite(spark, sf):
    return check_models(checked_models(spark, sf))


def checked_models(spark, sf) -> dict[str, DataFrame]:
    """Each staged relation and the dimension, written once; checks read those tables."""
    cat, prod, ser = (written(df, "staged") for df in staged(spark, sf))
    dim = build_dimension(conform_all(clean_catalog(cat, si.catalog_rules(spark)), clean_series(ser),
                                      clean_products(prod, si.translations(spark))))
    return {"stg_series": ser, "stg_products": prod, "stg_catalog": cat, "dim_factors": written(dim, "dim")}


def q_check_unique_lookup(spark, sf):
    lk = si.shape(si.read_table(spark, sf, "part"), si.PART_TRANSLATIONS)
    return ck.run_checks(lk, "translations", ck.translation_suite())


# ---------------------------------------------------------------- aggregates
def q_rows_per_year(spark, sf):
    return rows_per_year(catalog_checked(spark, sf).valid)


def q_distinct_years(spark, sf):
    return distinct_years(catalog_checked(spark, sf).valid)


# ---------------------------------------------------------------- bronze, publish, runner
def q_bronze_roundtrip(spark, sf):
    root = work_dir(spark, f"bronze-{uuid.uuid4().hex}")
    landed = catalog_checked(spark, sf).valid_raw
    land_bronze(landed, root, "defra")
    return scan_bronze(spark, root, "defra", landed.columns)


def q_incremental_landing(spark, sf):
    """Publisher files arrive in a folder; an availableNow stream validates
    them and lands the valid rows per year; the landed bronze is read back."""
    base = work_dir(spark, f"arrivals-{uuid.uuid4().hex}")
    cols = CATALOG_ROWS.names + list(CATALOG_ROWS.keep)   # files carry the contract's column order
    si.catalog_raw(spark, sf).select(*[F.col(f"`{c}`") for c in cols]) \
        .write.options(**CSV_OPTIONS).csv(f"{base}/incoming")
    run_until_caught_up(land_arrivals(spark, f"{base}/incoming", CATALOG_ROWS, f"{base}/bronze", "defra"))
    return scan_bronze(spark, f"{base}/bronze", "defra", CATALOG_ROWS.names + list(CATALOG_ROWS.keep))


def q_landing_counters(spark, sf):
    """What the landing stream has counted over its batches, some files in each."""
    base = work_dir(spark, f"arrivals-{uuid.uuid4().hex}")
    cols = CATALOG_ROWS.names + list(CATALOG_ROWS.keep)
    si.catalog_raw(spark, sf).select(*[F.col(f"`{c}`") for c in cols]).repartition(4, "row_no") \
        .write.options(**CSV_OPTIONS).csv(f"{base}/incoming")
    run_until_caught_up(land_arrivals(spark, f"{base}/incoming", CATALOG_ROWS, f"{base}/bronze", "defra", max_files_per_trigger=2))
    return landing_summary(spark, f"{base}/bronze", "defra")


def q_tagged_sheets(spark, sf):
    return union_tagged_sheets(si.event_readings(spark, sf), "sheet", si.SHEET_PATTERNS,
                               {"year": " YEAR ", "co2_per_kWh": "CO2_PER_KWH"})


def q_publish_reconcile(spark, sf):
    dim = dimension(spark, sf)
    target = work_dir(spark, f"gold-{uuid.uuid4().hex}", "dim_factors")
    rows = publish_snapshot(dim, target)
    return reconcile_written(spark, rows, read_snapshot(spark, target))


def q_gated_publish(spark, sf):
    """The dimension published behind its checks. Every declared check gates;
    one check is added that always fails, in a second run that must be refused."""
    models = checked_models(spark, sf)
    results = written(check_models(models), "checks")
    target = work_dir(spark, f"gold-{uuid.uuid4().hex}", "dim_factors")
    check_schema(models["dim_factors"])
    outcome = []
    bad = spark.createDataFrame([("dim_factors", "expression", "always fails", 1, False)], results.schema)
    for name, gate in (("declared", results), ("failing", results.unionByName(bad))):
        try:
            row = publish_checked(models["dim_factors"], gate, target).first()
            outcome.append((name, "published", row["dst_rows"]))
        except AssertionError:
            outcome.append((name, "refused", None))
    return spark.createDataFrame(outcome, "gate string, outcome string, rows long")


def source_registry(sf: str) -> dict[str, SourceSpec]:
    return {
        "defra": SourceSpec("defra", lambda s: si.catalog_raw(s, sf), CATALOG_ROWS),
        "ademe": SourceSpec("ademe", lambda s: si.products_raw(s, sf), PRODUCTS,
                            fixed_year=PRODUCTS_EDITION_YEAR),
        "nve": SourceSpec("nve", lambda s: si.series_raw(s, sf), SERIES),
    }


def q_run_report(spark, sf):
    root = work_dir(spark, f"bronze-{uuid.uuid4().hex}")
    report = run_sources(spark, source_registry(sf), root, ["defra", "ademe", "nve", "unknown_src"],
                         max_parallel=3)
    return report.select("source", "status", "reason")


def q_all_sources_ok(spark, sf):
    root = work_dir(spark, f"bronze-{uuid.uuid4().hex}")
    good = run_sources(spark, source_registry(sf), root, max_parallel=3)
    mixed = run_sources(spark, source_registry(sf), root, ["nve", "unknown_src"])
    return (all_ok(good).withColumn("run", F.lit("registered"))
            .unionByName(all_ok(mixed).withColumn("run", F.lit("with an unknown source"))))


def q_strict_failure(spark, sf):
    """A strict source with invalid rows: the whole batch fails, and the report
    carries the whole reason (first 20 rows and how many more)."""
    spec = SourceSpec("ademe", lambda s: si.products_raw(s, sf, dirty=True), PRODUCTS_ROWS,
                      fixed_year=PRODUCTS_EDITION_YEAR)
    root = work_dir(spark, f"bronze-{uuid.uuid4().hex}")
    return run_sources(spark, {"ademe": spec}, root).select("source", "status", "reason")


# ---------------------------------------------------------------- publishers' own files
def q_publisher_landing(spark, sf):
    """``{year}/factors.csv`` files with the year inside and their columns in
    changing order, read back by header name and typed by the contract."""
    root = fresh_path(spark, "publisher")
    cols = ["year", "co2_per_kWh", "factor_type"]
    si.write_publisher_files(spark, si.series_raw(spark, sf), root, "nve", [cols[::-1], cols, [cols[1], cols[0], cols[2]]])
    return _typed(spark, SourceSpec("nve", lambda s: scan_bronze(s, root, "nve", cols, layout="publisher"), SERIES))


def _typed(spark, spec: SourceSpec, contract: Contract | None = None) -> DataFrame:
    return validate(spec.read(spark), contract or spec.contract).valid


def q_catalog_exports(spark, sf):
    """All editions of the catalog read from the publisher's exports."""
    root = fresh_path(spark, "exports")
    years = si.write_catalog_exports(spark, sf, root)

    def read(s):
        out = None
        for y in years:
            one = read_catalog_export(s, f"{root}/{y}", y)
            out = one if out is None else out.unionByName(one)
        return out

    return _typed(spark, SourceSpec("defra", read, CATALOG))


def q_series_sheets(spark, sf):
    """The workbook's usable sheets, tagged by name, under the series contract."""
    sheets = si.write_series_sheets(spark, sf, fresh_path(spark, "sheets"))
    return _typed(spark, SourceSpec("nve", lambda s: read_series_sheets(s, sheets, si.SHEET_PATTERNS), SERIES))


def q_edition_slice(spark, sf):
    """One edition of the landed catalog."""
    return year_slice(catalog_valid(spark, sf), SLICE_YEAR).select("ID", "Scope", "UOM", "year")


def q_lookup_csv(spark, sf):
    """A lookup written and loaded as CSV with its declared schema."""
    path = fresh_path(spark, "lookup")
    si.shape(si.read_table(spark, sf, "part"), si.PART_TRANSLATIONS).write.options(**CSV_OPTIONS).csv(path)
    return load_lookup(spark, path, si.TRANSLATION_SCHEMA)


def q_missing_column(spark, sf):
    """A required column that the input lacks fails every row that is not skipped (V7)."""
    return validate(si.catalog_raw(spark, sf).drop("Scope"), CATALOG).summary()


# ---------------------------------------------------------------- consumer side
_PUBLISHED: dict[tuple, str] = {}


def published(spark, sf) -> str:
    """Folder of the published dimension (once per application and state of the input)."""
    key = si.table_state(spark, sf)
    if key not in _PUBLISHED:
        target = work_dir(spark, f"gold-{uuid.uuid4().hex}", "dim_factors")
        publish_snapshot(written(dimension(spark, sf), "dim"), target)
        _PUBLISHED[key] = target
    return _PUBLISHED[key]


def q_usable_on(spark, sf):
    """What a consumer asks the published table: the files that may hold the day, nothing else."""
    return read_valid_on(spark, published(spark, sf), USABLE_DAY)


def q_activity_factor_join(spark, sf):
    out = activity_factor_join(si.event_activity(spark, sf), dimension(spark, sf), ["factor_name", "unit"],
                               "activity_date", "quantity")
    return out.select("event_id", "activity_date", "ef_id", "gCO2e_per_unit", "emissions")


def q_geo_fallback(spark, sf):
    act = si.located_activity(spark, sf)
    # Written once: the key check and every level read it.
    out = geo_fallback(act, written(si.location_factors(spark, sf), "location-factors"),
                       [("nation_code", "nation"), ("region_code", "region"), (None, "global", "GLOBAL")])
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", "geo_level", "gCO2e_per_unit",
                      (F.col("l_quantity") * F.col("gCO2e_per_unit")).alias("emissions"))


def q_asof_editions(spark, sf):
    """The newest of nested editions on each activity row's day, once per row."""
    out = activity_factor_join(si.edition_activity(spark, sf), written(si.edition_factors(spark, sf), "editions"),
                               ["factor_name", "unit"], "activity_date", "quantity")
    return out.select("l_orderkey", "l_linenumber", "activity_date", "ef_id", "gCO2e_per_unit", "emissions")


def q_geo_fallback_dated(spark, sf):
    """Nation, else region, else world, by unit and day."""
    act = si.located_lines(spark, sf).select(
        "l_orderkey", "l_linenumber", "nation_code", "region_code", F.col("l_linestatus").alias("unit"),
        F.col("l_shipdate").cast("date").alias("activity_date"))
    return asof_fallback(act, written(si.located_editions(spark, sf), "editions"),
                         [("nation_code", "nation"), ("region_code", "region"), (None, "global", "GLOBAL")],
                         ["unit"], "activity_date", ["ef_id", "gCO2e_per_unit"])


QUERIES: dict[str, Query] = {
    "stage_catalog": q_stage_catalog,
    "stage_products": q_stage_products,
    "stage_series": q_stage_series,
    "validate_lenient_rows": q_validate_lenient_rows,
    "validate_rejected": q_validate_rejected,
    "validation_summary": q_validation_summary,
    "error_sample": q_error_sample,
    "parent_fill": q_parent_fill,
    "blank_to_null": q_blank_to_null,
    "wildcard_lookup": q_wildcard_lookup,
    "wildcard_fanout": q_wildcard_fanout,
    "drop_listed": q_drop_listed,
    "map_category": q_map_category,
    "map_chain": q_map_chain,
    "name_rules": q_name_rules,
    "rule_table": q_rule_table,
    "country_rule": q_country_rule,
    "unmatched_lookup_keys": q_unmatched_lookup_keys,
    "unit_scale": q_unit_scale,
    "strip_unit_suffix": q_strip_unit_suffix,
    "lower_first": q_lower_first,
    "null_concat": q_null_concat,
    "clean_products": q_clean_products,
    "clean_catalog": q_clean_catalog,
    "clean_series": q_clean_series,
    "conform_union": q_conform_union,
    "rank_editions": q_rank_editions,
    "flag_current": q_flag_current,
    "current_only": q_current_only,
    "dim_factors": q_dim_factors,
    "incremental_dimension": q_incremental_dimension,
    "check_suite": q_check_suite,
    "check_unique_lookup": q_check_unique_lookup,
    "rows_per_year": q_rows_per_year,
    "distinct_years": q_distinct_years,
    "bronze_roundtrip": q_bronze_roundtrip,
    "incremental_landing": q_incremental_landing,
    "landing_counters": q_landing_counters,
    "tagged_sheets": q_tagged_sheets,
    "publish_reconcile": q_publish_reconcile,
    "gated_publish": q_gated_publish,
    "run_report": q_run_report,
    "all_sources_ok": q_all_sources_ok,
    "strict_failure": q_strict_failure,
    "publisher_landing": q_publisher_landing,
    "catalog_exports": q_catalog_exports,
    "series_sheets": q_series_sheets,
    "edition_slice": q_edition_slice,
    "lookup_csv": q_lookup_csv,
    "missing_column": q_missing_column,
    "usable_on": q_usable_on,
    "activity_factor_join": q_activity_factor_join,
    "geo_fallback": q_geo_fallback,
    "asof_editions": q_asof_editions,
    "geo_fallback_dated": q_geo_fallback_dated,
}
