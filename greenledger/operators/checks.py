"""Declarative data checks: a list of checks in, one result row per check out.

Failure counts follow the usual data-test conventions:
    not_null        rows where the column is NULL
    expression      rows where the expression is false (NULL passes)
    accepted_values distinct non-NULL values outside the list
    unique          distinct non-NULL keys that occur more than once

Plan: all checks of a model share ONE scan and one partially-aggregated
shuffle of what fails. Unique keys go into it as 64-bit hashes; only keys whose
hash occurs twice are compared themselves, in a second scan that data with unique keys
never needs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from greenledger.tables import written

RESULT_SCHEMA = T.StructType([
    T.StructField("model", T.StringType(), False),
    T.StructField("check", T.StringType(), False),
    T.StructField("column", T.StringType(), False),
    T.StructField("failing", T.LongType(), False),
    T.StructField("passed", T.BooleanType(), False),
])


@dataclass(frozen=True)
class Check:
    kind: str                         # not_null | unique | accepted_values | expression
    column: str                       # column name, or the SQL text of an expression
    values: tuple = ()
    expr: str | None = None           # expression checks: SQL predicate

    @property
    def label(self) -> str:
        return self.expr if self.kind == "expression" else self.column


def not_null(c: str) -> Check:
    return Check("not_null", c)


def unique(c: str) -> Check:
    return Check("unique", c)


def accepted(c: str, values) -> Check:
    return Check("accepted_values", c, tuple(values))


def expression(c: str, predicate: str) -> Check:
    """``predicate`` is a SQL boolean over the row, e.g. ``"gCO2e_per_unit >= 0"``."""
    return Check("expression", c, expr=predicate)


def _key(check: Check) -> Column:
    return F.expr(check.column)


def _sql_literal(v) -> str:
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _failure_sql(i: int, ch: Check) -> str:
    """SQL for one check's (check, value, hash) array: empty when it passes."""
    val, key = "CAST(NULL AS STRING)", "CAST(NULL AS BIGINT)"
    if ch.kind == "not_null":
        bad = f"({ch.column}) IS NULL"
    elif ch.kind == "expression":
        bad = f"NOT coalesce(({ch.expr}), TRUE)"
    elif ch.kind == "unique":  # every key's hash is emitted; repeats are counted later
        bad, key = f"({ch.column}) IS NOT NULL", _HASH.format(f"CAST(({ch.column}) AS STRING)")
    else:
        vals = ", ".join(_sql_literal(v) for v in ch.values)
        bad = f"({ch.column}) IS NOT NULL AND ({ch.column}) NOT IN ({vals})"
        val = f"CAST(({ch.column}) AS STRING)"
    return (f"CASE WHEN {bad} THEN array(named_struct('i', {i}, 'v', {val}, 'h', {key})) "
            f"ELSE CAST(array() AS ARRAY<STRUCT<i: INT, v: STRING, h: BIGINT>>) END")


_HASH = "xxhash64({})"
#: Suspect hashes (12 bytes each) that are broadcast to the second scan; more are joined by a shuffle.
SUSPECTS = 1_000_000


def _failures(df: DataFrame, checks: list[Check]) -> DataFrame:
    """(i, v, h, n) of what fails: pairs of check and value, and of check and key
    hash where the hash occurs more than once. One pass; a hot value or key is one row per task."""
    pairs = "concat(" + ", ".join(_failure_sql(i, ch) for i, ch in enumerate(checks)) + ")"
    failures = df.selectExpr(f"explode({pairs}) AS f").selectExpr("f.i AS i", "f.v AS v", "f.h AS h")
    return failures.groupBy("i", "v", "h").agg(F.count(F.lit(1)).alias("n")).where(F.col("h").isNull() | (F.col("n") > 1))


def _repeated(df: DataFrame, checks: list[Check], suspects: DataFrame, n: int) -> DataFrame:
    """(i, repeated): keys that occur more than once, among those with a suspect hash (i, h)."""
    keys = [f"named_struct('i', {i}, 'v', {text}, 'h', {_HASH.format(text)})"
            for i, ch in enumerate(checks) if ch.kind == "unique" for text in [f"CAST(({ch.column}) AS STRING)"]]
    rows = df.selectExpr(f"explode(array({', '.join(keys)})) AS f").select("f.*").where("v IS NOT NULL")
    held = rows.join(F.broadcast(suspects) if n <= SUSPECTS else suspects, ["i", "h"], "left_semi")
    return held.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1").groupBy("i").agg(
        F.count(F.lit(1)).alias("repeated"))


def _flat_checks(df: DataFrame, model: str, checks: list[Check]) -> DataFrame:
    """All checks of a model in ONE pass over it, and a second one over the
    keys if a hash repeats. What fails is written; a local catalogue of the checks
    fills in zero failures."""
    spark = df.sparkSession
    found = written(_failures(df, checks), "failures")
    per_check = found.where("h IS NULL").groupBy("i").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("values"))
    meta = spark.createDataFrame([(i, ch.kind, ch.label) for i, ch in enumerate(checks)], "i int, check string, column string")
    # One row per declared check: a proven size bound.
    joined = meta.join(F.broadcast(per_check), "i", "left")
    suspects = found.where("h IS NOT NULL").select("i", "h")
    n = suspects.count() if any(ch.kind == "unique" for ch in checks) else 0
    if n:
        joined = joined.join(F.broadcast(_repeated(df, checks, suspects, n)), "i", "left")
    else:
        joined = joined.withColumn("repeated", F.lit(None).cast("long"))
    failing = (F.when(F.col("check") == "accepted_values", F.col("values"))
                .when(F.col("check") == "unique", F.col("repeated"))
                .otherwise(F.col("rows")))
    return joined.select(F.lit(model).alias("model"), "check", "column",
                         F.coalesce(failing, F.lit(0)).alias("failing"))


def run_checks(df: DataFrame, model: str, checks: list[Check]) -> DataFrame:
    """One result row per check: model, check, column, failing, passed."""
    out = _flat_checks(df, model, checks)
    return out.select("model", "check", "column", F.col("failing").cast("bigint").alias("failing"),
                      (F.col("failing") == 0).alias("passed"))


def check_unique(df: DataFrame, key: str, model: str = "model") -> DataFrame:
    return run_checks(df, model, [unique(key)])


def check_not_null(df: DataFrame, cols: list[str], model: str = "model") -> DataFrame:
    return run_checks(df, model, [not_null(c) for c in cols])


def check_accepted(df: DataFrame, col: str, values, model: str = "model") -> DataFrame:
    return run_checks(df, model, [accepted(col, values)])


def check_expr(df: DataFrame, col: str, predicate: str, model: str = "model") -> DataFrame:
    return run_checks(df, model, [expression(col, predicate)])


def assert_checks(results: DataFrame) -> None:
    """Raise when any check failed, naming every one (used to gate publishing).

    ``results`` has one row per declared check, so the collected rows are bounded.
    """
    failed = results.where(~F.col("passed")).orderBy("model", "check", "column").collect()
    if failed:
        detail = ", ".join(f"{r['model']}.{r['check']}({r['column']})={r['failing']}" for r in failed)
        raise AssertionError(f"data checks failed: {detail}")


# ---------------------------------------------------------------------------
# The declared suites of the staged models, the gold dimension
# and the translation lookup (75 checks).
# ---------------------------------------------------------------------------
SCOPES = ("Scope 1", "Scope 2", "Scope 3", "Outside of Scopes")
SOURCES = ("ademe", "defra", "nve")
FROM_BEFORE_TO = "valid_from <= valid_to"


def series_suite() -> list[Check]:
    return [
        unique("id"), not_null("id"), not_null("factor_name"),
        not_null("gCO2e_per_unit"), expression("gCO2e_per_unit", "gCO2e_per_unit > 0"),
        not_null("unit"), accepted("unit", ["kWh"]),
        not_null("ghg_scope"), accepted("ghg_scope", ["Scope 2"]),
        not_null("country_code"), accepted("country_code", ["NO"]),
        not_null("source"), accepted("source", ["nve"]),
        not_null("source_year"), expression("source_year", "source_year BETWEEN 2000 AND 2100"),
        not_null("valid_to"), not_null("valid_from"),
        expression("valid_from", FROM_BEFORE_TO),
    ]


def products_suite() -> list[Check]:
    return [
        unique("id"), not_null("id"), not_null("factor_name"),
        not_null("gCO2e_per_unit"), expression("gCO2e_per_unit", "gCO2e_per_unit >= 0"),
        not_null("unit"), accepted("unit", ["piece"]),
        not_null("ghg_scope"), accepted("ghg_scope", ["Scope 3"]),
        not_null("country_code"), accepted("country_code", ["GLOBAL"]),
        not_null("source"), accepted("source", ["ademe"]),
        not_null("source_year"), accepted("source_year", [2016]),
        not_null("valid_from"), not_null("valid_to"),
        not_null("sport_federation_code"), not_null("federation"),
        expression("valid_from", FROM_BEFORE_TO),
    ]


def catalog_suite() -> list[Check]:
    return [
        unique("id"), not_null("id"), not_null("factor_name"),
        not_null("gCO2e_per_unit"), expression("gCO2e_per_unit", "gCO2e_per_unit >= 0"),
        not_null("unit"),
        not_null("ghg_scope"), accepted("ghg_scope", list(SCOPES)),
        not_null("country_code"), accepted("country_code", ["GLOBAL"]),
        not_null("source"), accepted("source", ["defra"]),
        not_null("source_year"), expression("source_year", "source_year BETWEEN 2000 AND 2100"),
        not_null("sub_category"), not_null("category"),
        not_null("valid_from"), not_null("valid_to"),
        expression("valid_from", FROM_BEFORE_TO),
    ]


def gold_suite() -> list[Check]:
    return [
        unique("ef_id"), not_null("ef_id"),
        not_null("source"), accepted("source", list(SOURCES)),
        not_null("factor_name"),
        not_null("gCO2e_per_unit"), expression("gCO2e_per_unit", "gCO2e_per_unit >= 0"),
        not_null("unit"),
        not_null("ghg_scope"), accepted("ghg_scope", list(SCOPES)),
        not_null("country_code"), not_null("source_year"),
        not_null("valid_from"), not_null("valid_to"), not_null("is_current"),
        expression("valid_from", FROM_BEFORE_TO),
    ]


TRANSLATION_KEY = "concat(trim(factor_name_fr), '¦', coalesce(federation, ''))"


def translation_suite() -> list[Check]:
    return [unique(TRANSLATION_KEY), not_null("factor_name_fr")]
