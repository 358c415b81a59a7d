"""Publisher-shaped inputs derived from the driver's test tables.

The test tables are not emission factors, so each publisher format gets a
stand-in computed from one table, in bronze form (text columns):

    orders -> hierarchical catalog   status = level 1, priority = level 2,
                                     customer = level 3, price = factor,
                                     order year + 20 = edition
    part   -> product list           name + unit group, brand = scope
    events -> measured series        one value per (type, year) and
                                     activity rows for the interval join
    lineitem x supplier x nation x region -> located activity rows

The shaping expressions below are SQL text that Spark (``selectExpr``) and
the DuckDB oracle both run verbatim, so both engines start from identical
bronze rows; the operators under test are then written independently
(DataFrame API vs. SQL). Dirty values (blanks, bad numbers, out-of-range
years) are derived from key arithmetic so every scale factor has them.
The lookup rows are invented for these stand-ins.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from greenledger.operators.rules import NameRule, TerritoryRule
from greenledger.session import work_dir
from greenledger.sources.bronze import CSV_OPTIONS

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --------------------------------------------------------------------------
# Shaping expressions (SQL text shared by both engines)
# --------------------------------------------------------------------------
_CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"
_KG = (f"CAST(CAST(floor({_CENTS} / 100000) AS BIGINT) AS STRING) || '.' || "
       f"lpad(CAST({_CENTS} % 100000 AS STRING), 5, '0')")

CATALOG_RAW = {
    "ID": ("CASE o_orderkey % 107 WHEN 5 THEN ' ' WHEN 6 THEN chr(9) WHEN 7 THEN chr(160) "
           "ELSE CAST(o_orderkey AS STRING) END"),
    "Scope": ("CASE o_orderkey % 4 WHEN 0 THEN 'Scope 1' WHEN 1 THEN 'Scope 2' "
              "WHEN 2 THEN 'Scope 3' ELSE 'Outside of Scopes' END"),
    "Level 1": "o_orderstatus",
    "Level 2": "o_orderpriority",
    "Level 3": ("CASE WHEN o_custkey % 11 = 0 THEN '' WHEN o_custkey % 37 = 5 THEN ' ' "
                "ELSE 'Customer ' || CAST(o_custkey AS STRING) END"),
    "Level 4": ("CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL "
                "ELSE 'Tier ' || CAST(o_orderkey % 5 AS STRING) END"),
    "Column Text": "CASE WHEN o_orderkey % 7 = 3 THEN chr(9) ELSE 'Batch ' || CAST(o_orderkey % 7 AS STRING) END",
    "GHG Conversion Factor": (f"CASE WHEN o_orderkey % 97 = 1 THEN '' WHEN o_orderkey % 97 = 3 THEN ' ' "
                              f"WHEN o_orderkey % 89 = 2 THEN '-' || {_KG} "
                              f"WHEN o_orderkey % 83 = 3 THEN 'n/a' ELSE {_KG} END"),
    "UOM": "CASE o_orderstatus WHEN 'F' THEN 'tonne.km' WHEN 'O' THEN 'kWh' ELSE 'litres' END",
    "GHG/Unit": "CASE WHEN o_custkey % 13 = 0 THEN 'kg CO2' ELSE 'kg CO2e' END",
    "year": "CASE WHEN o_orderkey % 103 = 4 THEN '1999' ELSE CAST(year(o_orderdate) + 20 AS STRING) END",
    "row_no": "o_orderkey",
}

_UNIT_GROUP = ("CASE p_size % 6 WHEN 0 THEN ' (geC/pièce)' WHEN 1 THEN ' (kgeC/pièce)' "
               "WHEN 2 THEN ' (kgCO2e/pièce)' WHEN 4 THEN ' (kec/pièce)' "
               "ELSE ' (grand) (kgeC/pièce)' END")
_PRODUCT_NAME = f"CASE WHEN p_size % 6 = 3 THEN 'Éco ' || p_name ELSE p_name || {_UNIT_GROUP} END"
_PRICE = "CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING)"
_UNCERT = "'0.' || lpad(CAST(p_size AS STRING), 2, '0')"

PRODUCTS_RAW = {
    "__id": "CAST(p_partkey AS STRING)",
    "Produit à l'unité": _PRODUCT_NAME,
    "Facteur d'émission": f"CASE p_partkey % 50 WHEN 7 THEN '' WHEN 8 THEN chr(9) ELSE {_PRICE} END",
    "Incertitude en %": f"CASE WHEN p_size % 8 = 0 THEN '' WHEN p_size % 8 = 4 THEN chr(160) ELSE {_UNCERT} END",
    "CodeFede": "substr(p_brand, 7)",
    "Federation": "p_brand",
    "Remarques": "CASE p_size % 3 WHEN 0 THEN 'ok' WHEN 1 THEN chr(9) || ' ' ELSE '' END",
}

# The same product list with rows that break the contract.
PRODUCTS_DIRTY = dict(PRODUCTS_RAW)
PRODUCTS_DIRTY.update({
    "__id": "CASE p_partkey % 71 WHEN 23 THEN ' ' WHEN 24 THEN chr(160) ELSE CAST(p_partkey AS STRING) END",
    "Produit à l'unité": f"CASE WHEN p_partkey % 73 = 3 THEN '' ELSE {_PRODUCT_NAME} END",
    "Facteur d'émission": (f"CASE WHEN p_partkey % 50 = 7 THEN '' WHEN p_partkey % 53 = 11 THEN 'abc' "
                           f"WHEN p_partkey % 59 = 13 THEN '0' ELSE {_PRICE} END"),
    "Incertitude en %": (f"CASE WHEN p_partkey % 61 = 17 THEN '1.5' WHEN p_size % 4 = 0 THEN '' "
                         f"ELSE {_UNCERT} END"),
    "Federation": "CASE WHEN p_partkey % 67 = 19 THEN chr(9) ELSE p_brand END",
    "row_no": "p_partkey",
})

# Series rows: every event is a reading of its type in a derived year.
EVENT_READINGS = {
    "event_id": "event_id",
    "year": "CAST(2020 + event_id % 4 AS STRING)",
    "co2_per_kWh": "value",
    "factor_type": "event_type",
    "sheet": "'Sheet ' || upper(event_type)",
}

# Activity rows: metered consumption of the event type on a shifted date.
EVENT_ACTIVITY = {
    "event_id": "event_id",
    "factor_name": "'Electricity (' || event_type || ')'",
    "unit": "'kWh'",
    "activity_date": "make_date(CAST(year(ts) - user_id % 5 AS INT), month(ts), day(ts))",
    "quantity": "value",
}

# Dated factors whose editions nest: of each return flag (name) and line status (unit) there are yearly
# editions, quarterly revisions and monthly updates, told apart by the line number. An edition is
# valid from its first to its last shipping day.
_SHIPPED = "CAST(l_shipdate AS DATE)"
EDITION_KEYS = {
    "factor_name": "l_returnflag",
    "unit": "l_linestatus",
    "edition": ("CASE l_linenumber WHEN 1 THEN 'month ' || CAST(year(l_shipdate) * 100 + month(l_shipdate) AS STRING) "
                "WHEN 2 THEN 'quarter ' || CAST(year(l_shipdate) * 10 + quarter(l_shipdate) AS STRING) "
                "ELSE 'year ' || CAST(year(l_shipdate) AS STRING) END"),
}
EDITION_VALUES = {
    "valid_from": f"min({_SHIPPED})",
    "valid_to": f"max({_SHIPPED})",
    "gCO2e_per_unit": "max(l_extendedprice) / 1000",
}
# Activity rows for them: the shipped quantity, as many days later.
EDITION_ACTIVITY = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "factor_name": "l_returnflag",
    "unit": "l_linestatus",
    "activity_date": f"{_SHIPPED} + CAST(l_quantity AS INT)",
    "quantity": "l_quantity",
}

# Located dated factors. Each level has the editions of one return flag: nations one a year, valid for as many
# days as the largest quantity; regions one a quarter, likewise; the world one a month, valid
# for as many days as the largest line number. Hence every level has days without one.
LOCATED_LEVELS = {
    "nation": ("R", "nation_code", "year(l_shipdate)", "max(l_quantity)"),
    "region": ("A", "region_code", "year(l_shipdate) * 10 + quarter(l_shipdate)", "max(l_quantity)"),
    "global": ("N", "'GLOBAL'", "year(l_shipdate) * 100 + month(l_shipdate)", "max(l_linenumber)"),
}
LOCATED_VALUES = {
    "valid_from": f"min({_SHIPPED})",
    "valid_to": f"min({_SHIPPED}) + CAST({{days}} AS INT)",
    "gCO2e_per_unit": "max(l_extendedprice) / 1000",
}

# A translation-shaped lookup derived from part (for the lookup-key checks).
PART_TRANSLATIONS = {
    "factor_name_fr": "p_name",
    "factor_name_en": "upper(p_name)",
    "federation": "CASE WHEN p_size % 2 = 0 THEN NULL ELSE p_brand END",
}

# Sheet-name patterns of the series workbook stand-in (first match wins).
SHEET_PATTERNS = (("click", "Market-based"), ("view", "Location-based"))


def shape(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{sql} AS `{alias}`" for alias, sql in exprs.items()])


def table_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Path and last change of the input tables: a key for what is derived from them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return (spark.sparkContext.applicationId, fs.resolvePath(folder).toString(),
            *sorted((s.getPath().getName(), s.getModificationTime(), s.getLen()) for s in fs.listStatus(folder)))


_LANDED: dict[tuple, str] = {}


def landed(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """The stand-in's bronze rows, written once per application as parquet in
    the shared work folder and scanned from there.

    Publisher rows reach validation from a file scan, where every raw column
    is a plain attribute. Shaping them on the fly instead would let predicate
    pushdown inline each shaping expression into every check that reads it.
    """
    key = (*table_state(spark, sf_dir), name)
    path = _LANDED.get(key)
    if path is None:
        path = work_dir(spark, "standins", uuid.uuid4().hex, name)
        build().write.mode("overwrite").parquet(path)
        _LANDED[key] = path
    return spark.read.parquet(path)


def catalog_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "catalog",
                  lambda: shape(read_table(spark, sf_dir, "orders"), CATALOG_RAW))


def products_raw(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    exprs = PRODUCTS_DIRTY if dirty else PRODUCTS_RAW
    return landed(spark, sf_dir, "products_dirty" if dirty else "products",
                  lambda: shape(read_table(spark, sf_dir, "part"), exprs))


def series_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per (type, year): the largest reading of that year.

    ``max`` is exact and partial-aggregates map-side, so a hot event type is
    reduced before the shuffle.
    """
    r = shape(read_table(spark, sf_dir, "events"), EVENT_READINGS)
    return (r.groupBy("factor_type", "year")
             .agg(F.max("co2_per_kWh").alias("co2_per_kWh"))
             .select("year", "co2_per_kWh", "factor_type"))


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(read_table(spark, sf_dir, "events"), EVENT_READINGS)


def event_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(read_table(spark, sf_dir, "events"), EVENT_ACTIVITY)


def edition_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Editions that nest: factor_name, unit, ef_id, validity, value."""
    li = read_table(spark, sf_dir, "lineitem")
    keyed = li.selectExpr(*[f"{e} AS {c}" for c, e in EDITION_KEYS.items()], "l_shipdate", "l_extendedprice")
    return keyed.groupBy(*EDITION_KEYS).agg(*[F.expr(e).alias(c) for c, e in EDITION_VALUES.items()]).withColumnRenamed(
        "edition", "ef_id")


def edition_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(read_table(spark, sf_dir, "lineitem"), EDITION_ACTIVITY)


def located_editions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Editions per place and unit at three levels: country_code, unit, ef_id, validity, value."""
    act = located_lines(spark, sf_dir)
    out = None
    for level, (flag, place, edition, days) in LOCATED_LEVELS.items():
        one = act.where(F.col("l_returnflag") == flag).groupBy(
            F.expr(place).alias("country_code"), F.col("l_linestatus").alias("unit"),
            F.expr(f"'{level} ' || CAST({edition} AS STRING)").alias("ef_id")).agg(
            *[F.expr(e.format(days=days)).alias(c) for c, e in LOCATED_VALUES.items()])
        out = one if out is None else out.unionByName(one)
    return out


# --------------------------------------------------------------------------
# Lookup rows (invented for the stand-ins)
# --------------------------------------------------------------------------
TRANSLATIONS = [
    ("small ring (geC/pièce)", "Small ring (gCO2e/piece)", None),
    ("red widget (grand) (kgeC/pièce)", "Red widget (large) (kgCO2e/piece)", "Brand#17"),
    ("hot gear (kgeC/pièce)", "Hot gear (kgCO2e/piece)", "Brand#3"),
    ("hot gear (kgeC/pièce)", "Warm gear (kgCO2e/piece)", "Brand#4"),
    ("Éco small gizmo", "Eco small gizmo", None),
    ("blue bolt (kec/pièce)", "Blue bolt (kec/piece)", None),
    ("red widget (kgCO2e/pièce)", "Red widget (kgCO2e/piece)", "Brand#3"),
]
# A generic row next to specific ones for the same name: those rows fan out.
TRANSLATIONS_FANOUT = TRANSLATIONS + [("hot gear (kgeC/pièce)", "Gear (kgCO2e/piece)", None)]

OVERRIDES = [
    ("P", "5-LOW", True),
    ("P", "5-LOW", True),
    ("F", "1-URGENT", False),
    ("O", "2-HIGH", True),
    ("F", "3-MEDIUM ", True),
]
CATEGORY_MAP = [("F", "Fulfilled"), ("O", "Open")]
SUB_CATEGORY_MAP = [("1-URGENT", "Urgent"), ("2-HIGH", "High"), ("3-MEDIUM", "Medium"),
                    ("O", "Open orders")]
REWRITE_CATEGORY = "O"
NAME_RULES = [
    NameRule("sub", ("Hotel stay",), "{sub_orig} - {name}"),
    NameRule("sub_new", ("Urgent",), "{name} - {text}"),
    NameRule("sub", ("Open orders",), "{name} {sub_orig_lower_first}"),
    NameRule("sub", ("5-LOW",), "{sub_new}"),
    NameRule("sub", ("Medium",), "{sub} - {name} - {text}"),
    NameRule("sub", ("High",), "{name} - {sub} - {level4}"),
    NameRule("category_new", ("Fulfilled",), "{name} - {text}"),
    NameRule("sub", ("4-NOT SPECIFIED",), "Pre- {name}"),
]
TERRITORY = TerritoryRule("sub", ("Urgent", "2-HIGH"), "GB")

TRANSLATION_SCHEMA = T.StructType([
    T.StructField("factor_name_fr", T.StringType(), False),
    T.StructField("factor_name_en", T.StringType(), True),
    T.StructField("federation", T.StringType(), True),
])
OVERRIDE_SCHEMA = T.StructType([
    T.StructField("category", T.StringType(), True),
    T.StructField("sub_category", T.StringType(), True),
    T.StructField("should_drop", T.BooleanType(), True),
])
CATEGORY_MAP_SCHEMA = T.StructType([
    T.StructField("category_old", T.StringType(), False),
    T.StructField("category_new", T.StringType(), True),
])
SUB_MAP_SCHEMA = T.StructType([
    T.StructField("sub_category_old", T.StringType(), False),
    T.StructField("sub_category_new", T.StringType(), True),
])


def translations(spark: SparkSession, fanout: bool = False) -> DataFrame:
    return spark.createDataFrame(TRANSLATIONS_FANOUT if fanout else TRANSLATIONS, TRANSLATION_SCHEMA)


_RULES: dict = {}


def catalog_rules(spark: SparkSession):
    """The stand-in's rules, built (and their keys checked) once per application."""
    from greenledger.plans.clean import CatalogRules
    app = spark.sparkContext.applicationId
    if app not in _RULES:
        _RULES[app] = CatalogRules(
            overrides=spark.createDataFrame(OVERRIDES, OVERRIDE_SCHEMA),
            category_map=spark.createDataFrame(CATEGORY_MAP, CATEGORY_MAP_SCHEMA),
            sub_category_map=spark.createDataFrame(SUB_CATEGORY_MAP, SUB_MAP_SCHEMA),
            name_rules=NAME_RULES,
            territory=TERRITORY,
            rewrite_category=REWRITE_CATEGORY,
        )
    return _RULES[app]


# --------------------------------------------------------------------------
# Located activity (lineitem) and location factors for the geo fallback
# --------------------------------------------------------------------------
def located_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their supplier's nation and region names."""
    return located_lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity",
                                               "nation_code", "region_code")


def located_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of the line items with their supplier's nation and region names."""
    li = read_table(spark, sf_dir, "lineitem")
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    reg = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = (nat.join(F.broadcast(reg), nat.n_regionkey == reg.r_regionkey)
              .select("n_nationkey", F.col("n_name").alias("nation_code"),
                      F.col("r_name").alias("region_code")))
    # nation x region is bounded by the number of countries: safe to broadcast.
    sup_geo = sup.join(F.broadcast(geo), sup.s_nationkey == geo.n_nationkey).select(
        "s_suppkey", "nation_code", "region_code")
    # Suppliers grow with the data: no hint. AQE broadcasts them if they are
    # measured small, else sorts and merges and splits a hot supplier.
    return li.join(sup_geo, li.l_suppkey == sup_geo.s_suppkey).drop("s_suppkey")


def location_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Factors at three levels: nations (largest supplier balance), regions (largest
    customer balance) and one global value. Places with an odd number of
    suppliers, or an even number of customers, have none: uneven on purpose."""
    sup = read_table(spark, sf_dir, "supplier")
    cus = read_table(spark, sf_dir, "customer")
    nat = read_table(spark, sf_dir, "nation")
    reg = read_table(spark, sf_dir, "region")
    national = (sup.join(F.broadcast(nat), sup.s_nationkey == nat.n_nationkey)
                   .groupBy(F.col("n_name").alias("country_code"))
                   .agg((F.max("s_acctbal") / 1000.0).alias("gCO2e_per_unit"), F.count(F.lit(1)).alias("n"))
                   .where("n % 2 = 0").drop("n"))
    regional = (cus.join(F.broadcast(nat), cus.c_nationkey == nat.n_nationkey)
                   .join(F.broadcast(reg), nat.n_regionkey == reg.r_regionkey)
                   .groupBy(F.col("r_name").alias("country_code"))
                   .agg((F.max("c_acctbal") / 1000.0).alias("gCO2e_per_unit"), F.count(F.lit(1)).alias("n"))
                   .where("n % 2 = 1").drop("n"))
    world = cus.agg((F.max("c_acctbal") / 1000.0).alias("gCO2e_per_unit")).select(
        F.lit("GLOBAL").alias("country_code"), "gCO2e_per_unit")
    return national.unionByName(regional).unionByName(world)


# --------------------------------------------------------------------------
# Publisher files written from the stand-ins, to be read back by the readers
# --------------------------------------------------------------------------
def write_publisher_files(spark: SparkSession, df: DataFrame, root: str, source: str,
                          orders: list[list[str]]) -> None:
    """``{root}/{source}/{YYYY}/factors.csv`` with the year inside; the column
    order changes from edition to edition, as ``orders`` says."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    for k, year in enumerate(sorted(r[0] for r in df.select("year").distinct().collect())):
        part = f"{root}/{source}/_part-{year}"
        df.where(F.col("year") == year).select(*orders[k % len(orders)]).coalesce(1).write.options(**CSV_OPTIONS).csv(part)
        fs = fs_path(part).getFileSystem(spark._jsc.hadoopConfiguration())
        file = next(s.getPath() for s in fs.listStatus(fs_path(part)) if s.getPath().getName().startswith("part-"))
        fs.mkdirs(fs_path(f"{root}/{source}/{year}"))
        fs.rename(file, fs_path(f"{root}/{source}/{year}/factors.csv"))


def write_catalog_exports(spark: SparkSession, sf_dir: str, root: str) -> list[int]:
    """One export folder per edition, with padded headers, the factor column
    under its prefixed name, columns in another order, and an empty row."""
    rows = catalog_raw(spark, sf_dir)
    blank = spark.range(1).select(*[F.lit(None).cast("string").alias(c) for c in CATALOG_RAW if c != "row_no"])
    years = sorted(int(r[0]) for r in rows.select("year").distinct().collect())
    for year in years:
        mine = rows.where(F.col("year") == str(year)).drop("row_no").unionByName(blank).drop("year")
        names = {c: f" {c} " for c in mine.columns} | {"GHG Conversion Factor": f"GHG Conversion Factor {year}"}
        (mine.select(*[F.col(f"`{c}`").alias(names[c]) for c in sorted(mine.columns, reverse=True)])
         .write.options(**CSV_OPTIONS).csv(f"{root}/{year}"))
    return years


def write_series_sheets(spark: SparkSession, sf_dir: str, root: str) -> dict[str, str]:
    """{sheet name: path}: one CSV per event type, and one without the value column."""
    r = event_readings(spark, sf_dir)
    paths = {}
    for (sheet,) in r.select("sheet").distinct().orderBy("sheet").collect():
        paths[sheet] = f"{root}/{sheet.replace(' ', '_')}"
        (r.where(F.col("sheet") == sheet).select(F.col("event_id").alias("note"), F.col("co2_per_kWh").alias("co2 "),
                                                F.col("year").alias(" år")).write.options(**CSV_OPTIONS).csv(paths[sheet]))
    paths["Sheet VIEW notes"] = f"{root}/notes"
    r.select("event_id").write.options(**CSV_OPTIONS).csv(paths["Sheet VIEW notes"])
    return paths
