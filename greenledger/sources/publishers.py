"""Readers for the publishers' file exports.

Each reader returns raw bronze rows (text columns) ready for the source's
contract. Spreadsheet workbooks arrive as CSV exports, one file per sheet,
starting at the header row. Only file headers are inspected on the driver;
rows are read, tagged and unioned by Spark.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from greenledger.contracts import (
    CATALOG,
    CATALOG_FACTOR_PREFIX,
    SERIES_SHEET_PATTERNS,
    SERIES_VALUE_HEADER,
    SERIES_YEAR_HEADER,
)
from greenledger.sources.bronze import (
    find_column,
    normalise_sheet,
    read_publisher_csv,
    resolve_prefixed_column,
    sheet_tag,
)


def read_catalog_export(spark: SparkSession, path: str, year: int) -> DataFrame:
    """One edition of the hierarchical catalog: trimmed headers, no empty
    rows, the factor column found by its header prefix, and the edition year.
    A missing factor column gives an empty frame, not a failure."""
    df = normalise_sheet(read_publisher_csv(spark, path))
    df = resolve_prefixed_column(df, CATALOG_FACTOR_PREFIX, "GHG Conversion Factor", on_missing="empty")
    keep = [c for c in CATALOG.names if c in df.columns and c != "year"]
    return df.select(*[F.col(f"`{c}`") for c in keep]).withColumn("year", F.lit(str(year)))


def read_series_sheets(spark: SparkSession, sheets: dict[str, str],
                       patterns: tuple[tuple[str, str], ...] = SERIES_SHEET_PATTERNS) -> DataFrame:
    """All usable sheets of the series workbook as (year, co2_per_kWh, factor_type).

    ``sheets`` maps sheet name -> CSV path. A sheet whose name matches no
    pattern, or that lacks the year or value header (matched ignoring case
    and surrounding blanks), is skipped; no usable sheet is an error.
    """
    frames = []
    for name, path in sheets.items():
        tag = next((t for needle, t in patterns if needle.lower() in name.lower()), None)
        if tag is None:
            continue
        df = read_publisher_csv(spark, path)
        year_col = find_column(df.columns, SERIES_YEAR_HEADER)
        value_col = find_column(df.columns, SERIES_VALUE_HEADER)
        if year_col is None or value_col is None:
            continue
        frames.append(df.select(F.col(f"`{year_col}`").alias("year"),
                                F.col(f"`{value_col}`").alias("co2_per_kWh"),
                                sheet_tag(F.lit(name), patterns).alias("factor_type")))
    if not frames:
        raise ValueError("no usable sheet: no data extracted from any sheet")
    return reduce(lambda a, b: a.unionByName(b), frames)
