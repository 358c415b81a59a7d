"""Per-source cleaning (C1, C2, C6) and the conformed union."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenledger.functions.scalars import (
    concat_nulls,
    concat_skip_nulls,
    lower_first,
    scale_if_kilogram,
    strip_trailing_group,
)
from greenledger.operators.dimension import conform, union_sources
from greenledger.operators.lookups import assert_unique_key, drop_listed, map_values, wildcard_lookup
from greenledger.operators.rules import (
    NameRule,
    TerritoryRule,
    apply_name_rules,
    assign_country,
    rewrite_sub_category,
)

# ---------------------------------------------------------------------------
# Description sentences and per-source conformed constants.
# ---------------------------------------------------------------------------
PRODUCTS_DESCRIPTION = "Cradle-to-gate GHG emissions from the production of "
CATALOG_DESCRIPTION = ("GHG Emission factor for ", " belonging to category ")
SERIES_DESCRIPTION = ("GHG Emission factor for ", " belonging to category Energy")
PRODUCTS_CONFORM = {"sub_category": "Sports Equipment", "category": "Materials"}
SERIES_CONFORM = {"sub_category": "Electricity", "category": "Energy", "uncertainty_pct": None}
CATALOG_CONFORM = {"uncertainty_pct": None}


def clean_products(staged: DataFrame, translations: DataFrame) -> DataFrame:
    """Translate names (wildcard lookup), scale kilogram units, strip the unit group.

    ``translations``: factor_name_fr, factor_name_en, federation (NULL = any);
    a name and federation that occur twice are an error.
    """
    assert_unique_key(translations, F.struct("factor_name_fr", "federation"), "translations")
    j = wildcard_lookup(staged, translations, name="factor_name", lookup_name="factor_name_fr",
                        scope="federation", lookup_scope="federation", take=["factor_name_en"])
    std = F.coalesce(F.col("factor_name_en"), F.col("factor_name"))
    return j.select(
        "id",
        strip_trailing_group(std).alias("factor_name"),
        concat_nulls(F.lit(PRODUCTS_DESCRIPTION), strip_trailing_group(lower_first(std))).alias("description"),
        scale_if_kilogram(F.col("gCO2e_per_unit"), std).alias("gCO2e_per_unit"),
        "unit", "ghg_scope", "country_code", "source", "source_year", "valid_from", "valid_to",
        "uncertainty_pct", "sport_federation_code",
    )


@dataclass
class CatalogRules:
    """User-supplied lookups and rules of the catalog cleaning."""

    overrides: DataFrame          # category, sub_category, should_drop
    category_map: DataFrame       # category_old, category_new
    sub_category_map: DataFrame   # sub_category_old, sub_category_new
    name_rules: list[NameRule] = field(default_factory=list)
    territory: TerritoryRule | None = None
    rewrite_category: str | None = None

    def __post_init__(self) -> None:
        """Both mappings must have unique keys: a repeated one would multiply rows."""
        assert_unique_key(self.category_map, F.col("category_old"), "category mapping")
        assert_unique_key(self.sub_category_map, F.col("sub_category_old"), "sub-category mapping")


def map_catalog(staged: DataFrame, rules: CatalogRules) -> DataFrame:
    """Drop-list on the original keys, key rewrite, then both mappings."""
    kept = drop_listed(staged, rules.overrides, ["category", "sub_category"])
    kept = rewrite_sub_category(kept, rules.rewrite_category)
    mapped = map_values(kept, rules.category_map, "category", "category_old", "category_new")
    return map_values(mapped, rules.sub_category_map, "sub_category",
                      "sub_category_old", "sub_category_new")


def clean_catalog(staged: DataFrame, rules: CatalogRules) -> DataFrame:
    """Catalog cleaning: mappings, rule-built names, description, territory."""
    m = map_catalog(staged, rules)
    sub = F.coalesce(F.col("sub_category_new"), F.col("sub_category"))
    cat = F.coalesce(F.col("category_new"), F.col("category"))
    m = m.withColumn("description", concat_skip_nulls(
        F.lit(CATALOG_DESCRIPTION[0]), sub, F.lit(CATALOG_DESCRIPTION[1]), cat))
    if rules.territory is not None:
        m = assign_country(m, rules.territory)
    m = apply_name_rules(m, rules.name_rules)
    return m.select(
        "id", "factor_name", "description", "gCO2e_per_unit", "unit", "ghg_scope", "country_code",
        "source", "source_year", "valid_from", "valid_to",
        cat.alias("category"), sub.alias("sub_category"), "sub_sub_category", "column_text",
    )


def clean_series(staged: DataFrame) -> DataFrame:
    """Series cleaning: add the description sentence."""
    return staged.select(
        "id", "factor_name",
        concat_skip_nulls(F.lit(SERIES_DESCRIPTION[0]), F.col("factor_name"),
                          F.lit(SERIES_DESCRIPTION[1])).alias("description"),
        "gCO2e_per_unit", "unit", "ghg_scope", "country_code", "source", "source_year",
        "valid_from", "valid_to",
    )


def conform_all(catalog: DataFrame, series: DataFrame, products: DataFrame) -> DataFrame:
    """The three cleaned sources aligned to one schema and unioned."""
    return union_sources(
        conform(catalog, CATALOG_CONFORM),
        conform(series, SERIES_CONFORM),
        conform(products, PRODUCTS_CONFORM),
    )
