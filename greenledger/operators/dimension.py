"""Multi-source union and the versioned (edition-flagged) dimension.

Plan shape at scale: the union is narrow; flagging the latest edition is the
only wide step. ``current_only`` keeps rank 1 per group, which Catalyst plans
as a *partial* WindowGroupLimit before the shuffle, so a group holding a third
of all rows still sends at most one row per map task. ``flag_current`` writes
the rows once and joins the winners back by row number (a unique key: no hot
partition) instead of running a full window over each group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greenledger.contracts import CONFORMED_SCHEMA
from greenledger.tables import free_name, numbered, with_positions, written

CONFORMED_COLUMNS = [f.name for f in CONFORMED_SCHEMA.fields]
EDITION_KEYS = ("source", "factor_name", "unit")
GOLD_ORDER = ("source", "country_code", "factor_name", "source_year", "valid_from")


def conform(df: DataFrame, constants: dict[str, object] | None = None) -> DataFrame:
    """Select the conformed columns, adding constants and typed NULLs."""
    constants = constants or {}
    cols = []
    for f in CONFORMED_SCHEMA.fields:
        if f.name in constants:
            c = F.lit(constants[f.name])
        elif f.name in df.columns:
            c = F.col(f.name)
        else:
            c = F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def union_sources(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name, safe against column-order drift."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def prepare(df: DataFrame) -> DataFrame:
    """Name falls back to sub-category; unknown uncertainty becomes 0."""
    return df.withColumns({
        "factor_name": F.coalesce(F.col("factor_name"), F.col("sub_category")),
        "uncertainty_pct": F.coalesce(F.col("uncertainty_pct"), F.lit(0.0)),
    })


def edition_order(tiebreak: tuple[str, ...] = ("id",)) -> list[Column]:
    """Newest edition first (NULL dates last), then ``tiebreak`` ascending."""
    return ([F.col("valid_from").desc_nulls_last(), F.col("valid_to").desc_nulls_last()]
            + [F.col(t).asc_nulls_last() for t in tiebreak])


def rank_editions(df: DataFrame, keys: tuple[str, ...] = EDITION_KEYS,
                  tiebreak: tuple[str, ...] = ("id",), out: str = "rn",
                  method: str = "range", partitions: int | None = None) -> DataFrame:
    """row_number over (keys) by newest edition, as bigint.

    ``method="window"``: one hash shuffle on the keys; every row of a group
    meets in one task, so a group holding a third of all rows is one task.
    ``method="range"`` (default): the same numbers, skew-proof. The rows are
    written once with a row number. A projection of keys, edition order and row
    number is dealt by range of that order, so a hot group is spread over many
    sorted partitions, and gets global positions (see ``with_positions``). A
    row's number is its position less its group's first one; it is joined back
    by row number, a unique key. Rows that tie on everything else are ordered
    by row number.
    """
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*edition_order(tiebreak))
        return df.withColumn(out, F.row_number().over(w).cast("bigint"))
    row = free_name(df.columns, "row")
    base = written(numbered(df, row), "editions")
    used = dict.fromkeys([*keys, "valid_from", "valid_to", *tiebreak])
    order = [F.col(k).asc_nulls_first() for k in keys] + edition_order(tiebreak) + [F.col(row)]
    placed = written(with_positions(base.select(*used, row), order, "dealt", partitions=partitions)
                     .select(*keys, row, "pos"), "placed")
    firsts = placed.groupBy(*keys).agg(F.min("pos").alias("_first"))
    firsts = written(firsts.select(*[F.col(k).alias(f"_f_{k}") for k in keys], "_first"), "firsts")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_f_{k}")) for k in keys])
    ranks = placed.join(firsts, same).select(
        row, (F.col("pos") - F.col("_first") + 1).cast("bigint").alias("_rank"))
    return base.join(ranks, row).select(*df.columns, F.col("_rank").alias(out))


def current_only(df: DataFrame, keys: tuple[str, ...] = EDITION_KEYS,
                 tiebreak: tuple[str, ...] = ("id",)) -> DataFrame:
    """Only the latest edition of each group (W3): one row, whatever ties."""
    # A filtered row_number lets Catalyst keep only rank 1 per group on each
    # map task (partial WindowGroupLimit) before the shuffle.
    rn = free_name(df.columns, "rn")
    return rank_editions(df, keys, tiebreak, rn, method="window").where(F.col(rn) == 1).drop(rn)


def flag_current(df: DataFrame, keys: tuple[str, ...] = EDITION_KEYS,
                 tiebreak: tuple[str, ...] = ("id",), out: str = "is_current") -> DataFrame:
    """All rows kept; ``is_current`` is true on each group's latest edition.

    The rows are written once with a row number (their lineage is evaluated
    once), winners are found on the written keys and joined back by row number:
    exactly one row per group, even when ids repeat.
    """
    row = free_name(df.columns, "row")
    base = written(numbered(df, row), "editions")
    used = dict.fromkeys([*keys, "valid_from", "valid_to", *tiebreak, row])
    winners = current_only(base.select(*used), keys, (*tiebreak, row)).select(
        row, F.lit(True).alias("_current"))
    return base.join(winners, row, "left").select(
        *df.columns, F.coalesce("_current", F.lit(False)).alias(out))


def gold_columns(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("id").alias("ef_id"), "source", "factor_name", "description", "gCO2e_per_unit",
        "unit", "ghg_scope", "category", "sub_category", "country_code", "source_year",
        "valid_from", "valid_to", "is_current", "uncertainty_pct")


def build_dimension(conformed: DataFrame, tiebreak: tuple[str, ...] = ("id",)) -> DataFrame:
    """Conformed union -> name fallback -> latest-edition flag -> gold columns."""
    return gold_columns(flag_current(prepare(conformed), tiebreak=tiebreak))


def order_gold(df: DataFrame) -> DataFrame:
    """Total order of the gold table, NULLs last (O1).

    ``ef_id`` closes the order, which makes it deterministic and lets the
    range partitioner split a run of identical leading keys.
    """
    keys = list(GOLD_ORDER) + (["ef_id"] if "ef_id" in df.columns else [])
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in keys])
