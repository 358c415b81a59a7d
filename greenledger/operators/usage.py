"""Consumer-side operators over the published dimension (extension: the
dataset's documented meaning, not a transform of the source jobs).

E1 usable_on            factors valid on a day
E2 activity_factor_join activity rows x the factor valid on their date
E3 geo_fallback         most specific location factor: nation, region, global
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenledger.operators.asof import asof_join
from greenledger.operators.lookups import assert_unique_key


def usable_on(df: DataFrame, day: _dt.date | str) -> DataFrame:
    """Rows with valid_from <= day <= valid_to (E1); pushed to the scan as two
    range predicates when the dimension is read from parquet."""
    d = F.lit(day).cast("date")
    return df.where((F.col("valid_from") <= d) & (F.col("valid_to") >= d))


def activity_factor_join(activity: DataFrame, factors: DataFrame, keys: list[str],
                         date_col: str, quantity_col: str,
                         take: tuple[str, ...] = ("ef_id", "gCO2e_per_unit"),
                         out: str = "emissions") -> DataFrame:
    """LEFT as-of join: each activity row, once, with the newest factor of its
    ``keys`` that is valid on its day, and ``quantity x factor`` (E2).

    Editions may overlap and nest: the latest ``valid_from`` wins, then the latest
    ``valid_to``, then the largest ``take`` values. Rows without a valid factor
    keep NULL factor and emissions. See :mod:`greenledger.operators.asof` for the plan.
    """
    joined = asof_join(activity, factors, keys, date_col, list(take))
    value = "gCO2e_per_unit" if "gCO2e_per_unit" in take else take[-1]
    return joined.withColumn(out, F.col(quantity_col) * F.col(value))


def geo_fallback(activity: DataFrame, factors: DataFrame, levels: list[tuple],
                 code_col: str = "country_code", value_col: str = "gCO2e_per_unit",
                 out_value: str = "gCO2e_per_unit", out_level: str = "geo_level") -> DataFrame:
    """Most specific factor wins: try each level in order, keep the first match.

    ``levels``: ``(activity_column, level_name)`` for a per-row location, or
    ``(None, level_name, code)`` for a level every row shares (the global
    value). Per-row levels are LEFT equi-joins against the location factors;
    a shared level is an uncorrelated scalar subquery evaluated once (no
    cross join). A ``coalesce`` in priority order picks the winner: no
    candidate pairs and no per-activity ranking shuffle.

    A location code must occur once; a repeated one is an error, found before
    anything is joined. ``factors`` is read once per level and once for that
    check, so pass a written table if it is expensive to compute.
    """
    f = factors.select(F.col(code_col).alias("__code"), F.col(value_col).alias("__val"))
    assert_unique_key(f, F.col("__code"), "location factors")
    out = activity
    vals, names = [], []
    for i, level in enumerate(levels):
        col, name = level[0], level[1]
        if col is None:
            shared = f.where(F.col("__code") == F.lit(level[2])).select(F.max("__val")).scalar()
            out = out.withColumn(f"__val{i}", shared)   # bound once, referenced below
        else:
            fi = f.select(F.col("__code").alias(f"__code{i}"), F.col("__val").alias(f"__val{i}"))
            out = out.join(fi, F.col(col) == F.col(f"__code{i}"), "left").drop(f"__code{i}")
        vals.append(F.col(f"__val{i}"))
        names.append(F.when(F.col(f"__val{i}").isNotNull(), F.lit(name)))
    return (out.withColumn(out_value, F.coalesce(*vals))
               .withColumn(out_level, F.coalesce(*names))
               .drop(*[f"__val{i}" for i in range(len(levels))]))
