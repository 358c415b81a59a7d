"""Declared schemas and the three bronze row contracts.

Bronze files are read as text; each contract says how a column is typed
(``try_cast``), which blanks mean NULL, and which constraints a row must meet.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class FieldSpec:
    """One column of a row contract.

    dtype          Spark SQL type the raw text is coerced to (lax, try_cast).
    required       NULL after blank handling is a violation; a column that is
                   missing from the input counts as NULL on every row.
    must_exist     the column must be present even when NULL values are fine.
    non_blank      blank / whitespace text is a violation.
    blank_is_null  blank text becomes NULL before any check.
    null_is_empty  NULL becomes empty text before any check: CSV can't tell an
                   empty cell from a missing one, and here empty is a value.
    gt / ge / le   range bounds (NaN always violates a bound).
    """

    name: str
    dtype: str = "string"
    required: bool = True
    must_exist: bool = False
    non_blank: bool = False
    blank_is_null: bool = False
    null_is_empty: bool = False
    gt: float | None = None
    ge: float | None = None
    le: float | None = None


@dataclass(frozen=True)
class Contract:
    """Row contract of one source.

    measure        rows whose measure is NULL or empty are *skipped* before
                   validation (counted apart from invalid rows); with
                   ``skip_blank`` rows with a measure of white space too.
    fill_from      (child, parent) pairs: a NULL or empty child takes the
                   parent's value; white space is a value.
    on_error       "drop" keeps valid rows and quarantines the rest;
                   "fail" fails the whole batch on any invalid row.
    row_key        column ordering the error sample (a source line number).
    """

    source: str
    fields: tuple[FieldSpec, ...]
    measure: str | None = None
    skip_blank: bool = False
    fill_from: tuple[tuple[str, str], ...] = ()
    on_error: str = "drop"
    row_key: str | None = None
    keep: tuple[str, ...] = field(default=())

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]


# ---------------------------------------------------------------------------
# Column names and constraints of the three publisher formats.
# ---------------------------------------------------------------------------
PRODUCTS = Contract(
    source="ademe",
    fields=(
        FieldSpec("__id", non_blank=True),
        FieldSpec("Produit à l'unité", null_is_empty=True),
        FieldSpec("Facteur d'émission", "double", gt=0.0),
        FieldSpec("Incertitude en %", "double", required=False, blank_is_null=True,
                  ge=0.0, le=1.0),
        FieldSpec("CodeFede", non_blank=True),
        FieldSpec("Federation", non_blank=True),
        FieldSpec("Remarques", required=False, must_exist=True, blank_is_null=True),
    ),
    measure="Facteur d'émission",
    skip_blank=True,
    on_error="fail",
)

CATALOG = Contract(
    source="defra",
    fields=(
        FieldSpec("ID", non_blank=True),
        FieldSpec("Level 1", non_blank=True),
        FieldSpec("Level 2", non_blank=True),
        FieldSpec("Level 3", non_blank=True),
        FieldSpec("Level 4", required=False, blank_is_null=True),
        FieldSpec("Column Text", required=False, blank_is_null=True),
        FieldSpec("GHG Conversion Factor", "double", ge=0.0),
        FieldSpec("UOM", non_blank=True),
        FieldSpec("Scope", non_blank=True),
        FieldSpec("GHG/Unit", non_blank=True),
        FieldSpec("year", "int", ge=2000, le=2100),
    ),
    measure="GHG Conversion Factor",
    fill_from=(("Level 3", "Level 2"),),
    on_error="drop",
)

SERIES = Contract(
    source="nve",
    fields=(
        FieldSpec("year", "int", ge=2000, le=2100),
        FieldSpec("co2_per_kWh", "double", ge=0.0),
        FieldSpec("factor_type", non_blank=True),
    ),
    on_error="fail",
)

CONTRACTS = {c.source: c for c in (PRODUCTS, CATALOG, SERIES)}

# Header prefix that locates the catalog's factor column (the header carries
# a varying suffix), and the header names searched in series sheets.
CATALOG_FACTOR_PREFIX = "GHG Conversion Factor"
SERIES_YEAR_HEADER = "År"
SERIES_VALUE_HEADER = "CO2"
# Sheet-name fragments of the series workbook and the factor type each sets.
SERIES_SHEET_PATTERNS = (("varedeklarasjon", "Market-based"), ("klimadeklarasjon", "Location-based"))


def text_schema(names: list[str]) -> T.StructType:
    """All-string schema for reading raw CSV (never inferSchema)."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# ---------------------------------------------------------------------------
# Conformed relation (union of the cleaned sources) and the gold dimension.
# ---------------------------------------------------------------------------
CONFORMED_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), True),
    T.StructField("factor_name", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
    T.StructField("gCO2e_per_unit", T.DoubleType(), True),
    T.StructField("unit", T.StringType(), True),
    T.StructField("ghg_scope", T.StringType(), True),
    T.StructField("country_code", T.StringType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("source_year", T.IntegerType(), True),
    T.StructField("valid_from", T.DateType(), True),
    T.StructField("valid_to", T.DateType(), True),
    T.StructField("sub_category", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("uncertainty_pct", T.DoubleType(), True),
])

GOLD_SCHEMA = T.StructType([
    T.StructField("ef_id", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("factor_name", T.StringType(), False),
    T.StructField("description", T.StringType(), True),
    T.StructField("gCO2e_per_unit", T.DoubleType(), False),
    T.StructField("unit", T.StringType(), False),
    T.StructField("ghg_scope", T.StringType(), False),
    T.StructField("category", T.StringType(), True),
    T.StructField("sub_category", T.StringType(), True),
    T.StructField("country_code", T.StringType(), False),
    T.StructField("source_year", T.IntegerType(), False),
    T.StructField("valid_from", T.DateType(), False),
    T.StructField("valid_to", T.DateType(), False),
    T.StructField("is_current", T.BooleanType(), False),
    T.StructField("uncertainty_pct", T.DoubleType(), True),
])

# Column list of the serving table, in its declared order; loads name the
# columns explicitly so a reordered frame can never land shifted.
PUBLISH_COLUMNS = (
    "ef_id", "factor_name", "description", "gCO2e_per_unit", "unit", "source",
    "ghg_scope", "category", "sub_category", "country_code", "source_year",
    "valid_from", "valid_to", "is_current", "uncertainty_pct",
)
# Declared text lengths of the serving table.
PUBLISH_MAX_LENGTHS = {"ef_id": 32, "source": 16}
