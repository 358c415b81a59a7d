"""Lookup joins: wildcard translation, drop-list, value mapping.

Lookup tables are user-supplied and usually small, but nothing here relies on
that: no join carries a hint. The planner broadcasts a lookup whose known or
measured size in bytes is below its threshold, and else sorts and merges, with
skewed partitions split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenledger.operators.validate import qcol

def wildcard_lookup(df: DataFrame, lookup: DataFrame, name: str, lookup_name: str,
                    scope: str, lookup_scope: str, take: list[str]) -> DataFrame:
    """LEFT join on name equality where a NULL lookup scope matches any scope.

    A name with both a generic (NULL scope) and a matching specific row yields
    two output rows: the fan-out is part of the semantics, not removed here.

    Two equi-joins, on (name, scope) with the specific rows and on name with the
    generic ones, each side merged to one row per key before: no row is tested against all scopes of
    its name, and a hot name meets one row in each join. What both found is put in one list and
    exploded; the list is as long as the lookup repeats a key.
    """
    lk = lookup.select(qcol(lookup_name).alias("__lk_name"), qcol(lookup_scope).alias("__lk_scope"),
                       F.struct(*[qcol(c) for c in take]).alias("__lk")).where("__lk_name IS NOT NULL")
    specific = lk.where("__lk_scope IS NOT NULL").groupBy("__lk_name", "__lk_scope").agg(F.collect_list("__lk").alias("__lk_own"))
    generic = lk.where("__lk_scope IS NULL").groupBy(F.col("__lk_name").alias("__lk_any")).agg(F.collect_list("__lk").alias("__lk_all"))
    joined = (df.join(specific, (qcol(name) == F.col("__lk_name")) & (qcol(scope) == F.col("__lk_scope")), "left")
                .join(generic, qcol(name) == F.col("__lk_any"), "left"))
    none = F.array().cast(generic.schema["__lk_all"].dataType)
    found = F.concat(F.coalesce("__lk_own", none), F.coalesce("__lk_all", none))
    out = joined.withColumn("__lk", F.explode_outer(found))
    return out.select(*[qcol(c) for c in df.columns], *[F.col(f"__lk.`{c}`").alias(c) for c in take])


def drop_listed(df: DataFrame, overrides: DataFrame, keys: list[str],
                flag: str = "should_drop") -> DataFrame:
    """Remove rows whose key pair is flagged in the override list.

    Written as a left-anti join against the flagged keys, so duplicated list
    entries cannot multiply rows; NULL keys never match (kept).
    """
    flagged = overrides.where(F.coalesce(qcol(flag), F.lit(False))).select(
        *[qcol(k) for k in keys])
    return df.join(flagged, keys, "left_anti")


def map_values(df: DataFrame, mapping: DataFrame, key: str, old: str, new: str) -> DataFrame:
    """LEFT join a single-key mapping; unmatched rows get NULL ``new``.

    The mapping key must be unique (see :func:`assert_unique_key`).
    """
    mp = mapping.select(qcol(old).alias("__map_old"), qcol(new))
    return df.join(mp, qcol(key) == F.col("__map_old"), "left").drop("__map_old")


def duplicate_keys(lookup: DataFrame, key: Column) -> DataFrame:
    """Key values that occur more than once (NULL keys ignored)."""
    return (lookup.select(key.alias("key")).where(F.col("key").isNotNull())
            .groupBy("key").count().where(F.col("count") > 1))


def assert_unique_key(lookup: DataFrame, key: Column, what: str = "lookup") -> DataFrame:
    """Fail when a lookup key repeats, which would fan rows out."""
    dup = duplicate_keys(lookup, key)
    shown = [r["key"] for r in dup.orderBy("key").limit(5).collect()]
    if shown:
        more = dup.count() - len(shown)
        raise ValueError(f"{what}: duplicate keys {shown}" + (f" and {more} more" if more else ""))
    return lookup


def unmatched_keys(df: DataFrame, mapping: DataFrame, key: str, old: str) -> DataFrame:
    """Distinct data keys with no mapping row (a report for near-miss labels)."""
    keys = df.select(qcol(key).alias("key")).where(F.col("key").isNotNull()).distinct()
    return keys.join(mapping.select(qcol(old).alias("key")), "key", "left_anti")
