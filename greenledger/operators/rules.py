"""Rule tables: ordered naming rules, territory rule, key rewrite.

Rules are data. Each naming rule tests one column against a value list and,
on the first hit, builds the name from a template such as
``"{sub} - {name} - {text}"``; template parts are joined with NULL
propagation (a NULL part makes the name NULL). A short, fixed rule list compiles to one
chained CASE expression; a table of any number of rules is joined instead, by
column and value.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from greenledger.functions.scalars import lower_first
from greenledger.tables import free_name


@dataclass(frozen=True)
class NameRule:
    test: str
    values: tuple[str, ...]
    template: str


def render(template: str, fields: dict[str, Column]) -> Column:
    """Compile a template to a NULL-propagating concatenation."""
    parts: list[Column] = []
    for literal, field, _spec, _conv in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is not None:
            if field not in fields:
                raise KeyError(f"unknown template field {field!r}; known: {sorted(fields)}")
            parts.append(fields[field])
    if not parts:
        return F.lit("")
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def name_case(rules: list[NameRule], fields: dict[str, Column], default: Column) -> Column:
    """First matching rule wins; no match keeps ``default``."""
    expr = None
    for rule in rules:
        cond = fields[rule.test].isin(list(rule.values))
        value = render(rule.template, fields)
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return default if expr is None else expr.otherwise(default)


def catalog_fields() -> dict[str, Column]:
    """Fields of a catalog row after both mappings (see ``clean_catalog``).

    name      level-3 name            sub       mapped-else-original sub-category
    sub_orig  original sub-category   sub_new   mapped sub-category (NULL if none)
    sub_orig_lower_first              category_new  mapped category (NULL if none)
    level4    fourth level            text      column text
    """
    return {
        "name": F.col("factor_name"),
        "sub": F.coalesce(F.col("sub_category_new"), F.col("sub_category")),
        "sub_orig": F.col("sub_category"),
        "sub_orig_lower_first": lower_first(F.col("sub_category")),
        "sub_new": F.col("sub_category_new"),
        "category_new": F.col("category_new"),
        "level4": F.col("sub_sub_category"),
        "text": F.col("column_text"),
    }


def apply_name_rules(df: DataFrame, rules: list[NameRule], out: str = "factor_name") -> DataFrame:
    fields = catalog_fields()
    return df.withColumn(out, name_case(rules, fields, fields["name"]))


RULE_SCHEMA = "priority long, test string, value string, parts array<struct<literal: string, field: string>>"


def rule_parts(template: str, fields: dict[str, Column]) -> list[tuple[str | None, str | None]]:
    """(literal, field) parts of a template, one of each pair None; unknown fields are an error."""
    out: list[tuple[str | None, str | None]] = []
    for literal, field, _spec, _conv in string.Formatter().parse(template):
        if literal:
            out.append((literal, None))
        if field is not None:
            if field not in fields:
                raise KeyError(f"unknown template field {field!r}; known: {sorted(fields)}")
            out.append((None, field))
    return out


def rule_table(spark: SparkSession, rules: list[NameRule], fields: dict[str, Column] | None = None) -> DataFrame:
    """Rules as rows (priority, test, value, parts), one per value; see ``RULE_SCHEMA``."""
    fields = catalog_fields() if fields is None else fields
    rows = []
    for priority, rule in enumerate(rules):
        if rule.test not in fields:
            raise KeyError(f"unknown test field {rule.test!r}; known: {sorted(fields)}")
        parts = rule_parts(rule.template, fields)
        rows += [(priority, rule.test, value, parts) for value in rule.values]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def apply_rule_table(df: DataFrame, rules: DataFrame, out: str = "factor_name",
                     fields: dict[str, Column] | None = None, default: Column | None = None) -> DataFrame:
    """``df`` with ``out`` as the first matching rule builds it, ``default`` (the
    name field) where none matches; what ``name_case`` gives for the same rules.

    One LEFT equi-join per tested field on its value; a value's rules are reduced
    to the one of least ``priority`` before. Of the fields' winners the least
    priority counts, and its template is filled by substitution. The number of
    rules changes neither the plan nor the work per row, and a hot value meets one row of rules. Rules of
    one priority and value must agree, and a field that no rule tests isn't joined.
    """
    fields = catalog_fields() if fields is None else fields
    default = fields["name"] if default is None else default
    tested = [r["test"] for r in rules.select("test").distinct().collect()]  # names of fields: len(fields) at most
    unknown = sorted(set(tested) - set(fields))
    if unknown:
        raise KeyError(f"unknown test fields {unknown}; known: {sorted(fields)}")
    row, name, best = (free_name(df.columns, c) for c in ("fields", "default", "best"))
    wide = df.withColumns({row: F.struct(*[c.alias(f) for f, c in fields.items()]), name: default})
    found = []
    for i, test in enumerate(sorted(tested)):
        value, rule = free_name(wide.columns, f"value{i}"), free_name(wide.columns, f"rule{i}")
        least = rules.where((F.col("test") == test) & F.col("value").isNotNull()).groupBy(F.col("value").alias(value)).agg(
            F.min_by(F.struct("priority", "parts"), "priority").alias(rule))
        wide = wide.join(least, F.col(f"{row}.{test}") == F.col(value), "left").drop(value)
        found.append(rule)
    if not found:
        return wide.withColumn(out, F.col(name)).drop(*[c for c in (row, name) if c != out])
    first = F.least(*[F.col(r) for r in found]) if len(found) > 1 else F.col(found[0])
    values = F.create_map(*[x for f in fields for x in (F.lit(f), F.col(f"{row}.{f}"))])
    filled = F.transform(f"{best}.parts", lambda p: F.when(p["field"].isNull(), p["literal"]).otherwise(values[p["field"]]))
    text = F.when(~F.exists(filled, lambda x: x.isNull()), F.array_join(filled, ""))
    wide = wide.withColumn(best, first)
    return wide.withColumn(out, F.when(F.col(best).isNotNull(), text).otherwise(F.col(name))).drop(row, name, best, *found)


@dataclass(frozen=True)
class TerritoryRule:
    test: str
    values: tuple[str, ...]
    code: str


def assign_country(df: DataFrame, rule: TerritoryRule, out: str = "country_code") -> DataFrame:
    """Listed sub-categories get the national code, others keep theirs (C4)."""
    fields = catalog_fields()
    return df.withColumn(
        out, F.when(fields[rule.test].isin(list(rule.values)), F.lit(rule.code)).otherwise(F.col(out)))


def rewrite_sub_category(df: DataFrame, category_value: str | None) -> DataFrame:
    """Rows of one category copy the category into sub_category."""
    if category_value is None:
        return df
    return df.withColumn(
        "sub_category",
        F.when(F.col("category") == category_value, F.col("category")).otherwise(F.col("sub_category")))
