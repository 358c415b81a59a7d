"""Staging: rename, type and key each source into its staged shape.

Inputs are the validated bronze rows (typed) or raw text; every numeric
column goes through ``try_cast``, which is a no-op on typed input.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenledger.functions.scalars import (
    concat_skip_nulls,
    open_end,
    round3_then_grams,
    surrogate_key,
    year_end,
    year_start,
)
from greenledger.operators.validate import qcol

# ---------------------------------------------------------------------------
# Per-source constants of the staged relations.
# ---------------------------------------------------------------------------
PRODUCTS_EDITION_YEAR = 2016
PRODUCTS_CONST = {"unit": "piece", "ghg_scope": "Scope 3", "country_code": "GLOBAL",
                  "source": "ademe"}
CATALOG_KEPT_UNIT = "kg CO2e"
CATALOG_CONST = {"country_code": "GLOBAL", "source": "defra"}
SERIES_CONST = {"unit": "kWh", "ghg_scope": "Scope 2", "country_code": "NO", "source": "nve"}
SERIES_NAME = ("Electricity (", ")")


def default_edition_year(today: _dt.date) -> int:
    """The catalog edition fetched on ``today``: the previous calendar year.

    Passed explicitly to jobs; no query reads the clock.
    """
    return today.year - 1


def stage_products(df: DataFrame, edition_year: int = PRODUCTS_EDITION_YEAR) -> DataFrame:
    """Product list: one fixed edition valid from its first day without end."""
    c = PRODUCTS_CONST
    return df.select(
        surrogate_key(F.lit(c["source"]), qcol("__id")).alias("id"),
        qcol("Produit à l'unité").cast("string").alias("factor_name"),
        qcol("Facteur d'émission").try_cast("double").alias("gCO2e_per_unit"),
        F.lit(c["unit"]).alias("unit"),
        F.lit(c["ghg_scope"]).alias("ghg_scope"),
        F.lit(c["country_code"]).alias("country_code"),
        F.lit(c["source"]).alias("source"),
        F.lit(edition_year).cast("int").alias("source_year"),
        F.lit(_dt.date(edition_year, 1, 1)).alias("valid_from"),
        open_end().alias("valid_to"),
        F.coalesce(qcol("Incertitude en %").try_cast("double"), F.lit(0.0)).alias("uncertainty_pct"),
        qcol("CodeFede").cast("string").alias("sport_federation_code"),
        qcol("Federation").cast("string").alias("federation"),
    )


def stage_catalog(df: DataFrame, kept_unit: str = CATALOG_KEPT_UNIT) -> DataFrame:
    """Hierarchical catalog: keep one GHG unit, kg -> g, yearly validity."""
    c = CATALOG_CONST
    factor = qcol("GHG Conversion Factor").try_cast("double")
    year = qcol("year").try_cast("int")
    return df.where((qcol("GHG/Unit") == kept_unit) & factor.isNotNull()).select(
        surrogate_key(F.lit(c["source"]), qcol("ID"), year).alias("id"),
        qcol("Level 3").cast("string").alias("factor_name"),
        round3_then_grams(factor).alias("gCO2e_per_unit"),
        qcol("UOM").cast("string").alias("unit"),
        qcol("Scope").cast("string").alias("ghg_scope"),
        F.lit(c["country_code"]).alias("country_code"),
        F.lit(c["source"]).alias("source"),
        year.alias("source_year"),
        year_start(year).alias("valid_from"),
        year_end(year).alias("valid_to"),
        qcol("Level 2").cast("string").alias("sub_category"),
        qcol("Level 1").cast("string").alias("category"),
        qcol("Level 4").cast("string").alias("sub_sub_category"),
        qcol("Column Text").cast("string").alias("column_text"),
    )


def stage_series(df: DataFrame) -> DataFrame:
    """Measured series: one factor per (type, year)."""
    c = SERIES_CONST
    year = qcol("year").try_cast("int")
    ftype = qcol("factor_type")
    return df.select(
        surrogate_key(F.lit(c["source"]), F.lower(ftype), year).alias("id"),
        concat_skip_nulls(F.lit(SERIES_NAME[0]), ftype, F.lit(SERIES_NAME[1])).alias("factor_name"),
        qcol("co2_per_kWh").try_cast("double").alias("gCO2e_per_unit"),
        F.lit(c["unit"]).alias("unit"),
        F.lit(c["ghg_scope"]).alias("ghg_scope"),
        F.lit(c["country_code"]).alias("country_code"),
        F.lit(c["source"]).alias("source"),
        year.alias("source_year"),
        year_start(year).alias("valid_from"),
        year_end(year).alias("valid_to"),
    )
