"""The dimension kept up edition by edition (C7, W2): only what an arrival touches is read and written.

Rows lie in ``buckets`` folders by a hash of the edition keys, so a group of editions lies
in one bucket. An arrival re-ranks the groups that it brings rows for, or takes rows
from, inside the buckets that hold them; all other buckets stay as they are. The new
buckets are written under names of their own, and the version log (see
``versions``) is told in one step which folder counts for each bucket.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from greenledger.operators.dimension import EDITION_KEYS, flag_current
from greenledger.sources.versions import LEASE_S, commit, expire, file_system, newest
from greenledger.tables import free_name, written

BUCKETS = 64


class Conflict(RuntimeError):
    """Another run has changed a bucket that this one has read."""


def bucket_of(keys: tuple[str, ...], n: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(n)).cast("int")


def _same(left: str, right: str, keys) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys])


def merge_editions(dim: DataFrame, arriving: DataFrame, keys: tuple[str, ...] = EDITION_KEYS,
                   edition: tuple[str, ...] | None = ("source", "source_year"), tiebreak: tuple[str, ...] = ("id",),
                   out: str = "is_current") -> DataFrame:
    """``dim`` (flagged rows) with ``arriving`` (the same columns without the flag)
    merged in: what flagging all rows together would give.

    An arriving edition replaces the rows of ``dim`` with its ``edition`` columns
    (None: rows are only added). Only groups with an arriving or a replaced row are flagged
    anew; of the others every row keeps its flag. Keys may be null; equal rows stay as often as they come.
    """
    columns = [c for c in dim.columns if c != out]
    new = arriving.select(*columns)
    if edition:
        brought = new.select(*edition).distinct().withColumn("_brought", F.lit(True)).alias("b")
        tagged = dim.alias("d").join(brought, _same("d", "b", edition), "left").select("d.*", F.col("_brought").isNotNull().alias("_gone"))
    else:
        tagged = dim.withColumn("_gone", F.lit(False))
    touched = new.select(*keys).unionByName(tagged.filter("_gone").select(*keys)).distinct().withColumn("_touched", F.lit(True)).alias("t")
    rest = tagged.filter("NOT _gone").alias("r").join(touched, _same("r", "t", keys), "left").select(
        "r.*", F.col("_touched").isNotNull().alias("_again"))
    again = flag_current(rest.filter("_again").select(*columns).unionByName(new), keys, tiebreak, out)
    return rest.filter("NOT _again").select(*columns, out).unionByName(again.select(*columns, out))


def read_dimension(spark: SparkSession, target: str, buckets: list[int] | None = None) -> DataFrame | None:
    """The rows of the newest version (of some buckets only); None if there is none yet."""
    state = newest(spark, target)
    return state and _read(spark, target, state, buckets)


def _read(spark: SparkSession, target: str, state: dict, buckets: list[int] | None = None) -> DataFrame:
    from pyspark.sql import types as T

    paths = [f"{target}/{folder}" for b, folder in sorted(state["buckets"].items()) if buckets is None or int(b) in buckets]
    schema = T.StructType.fromJson(state["schema"])
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def merge_into(arriving: DataFrame, target: str, keys: tuple[str, ...] = EDITION_KEYS,
               edition: tuple[str, ...] | None = ("source", "source_year"), tiebreak: tuple[str, ...] = ("id",),
               out: str = "is_current", n_buckets: int = BUCKETS, tries: int = 5, lease_s: float = LEASE_S) -> list[int]:
    """Merge ``arriving`` into the dimension under ``target`` in one step; the buckets that were
    written. The first call makes the dimension, with ``n_buckets`` buckets.

    ``arriving`` is written once at the beginning. If another run changes one of the buckets
    that were read, the merge is done again on its result.
    """
    spark = arriving.sparkSession
    new = written(arriving, "arriving")
    for _ in range(tries):
        try:
            return _merge_once(spark, new, target, keys, edition, tiebreak, out, n_buckets, lease_s)
        except Conflict:
            continue
    raise Conflict(f"{target}: other runs were faster {tries} times")


def _merge_once(spark, new, target, keys, edition, tiebreak, out, n_buckets, lease_s) -> list[int]:
    state, run = newest(spark, target), uuid.uuid4().hex
    n = state["n"] if state else n_buckets
    mine = new.select(bucket_of(keys, n).alias("b")).distinct()
    if state is None:
        merged = flag_current(new, keys, tiebreak, out)
    else:
        if edition:  # buckets that hold rows of the editions that are replaced: a scan of their columns only
            held = _read(spark, target, state).select(*edition, bucket_of(keys, n).alias("b")).distinct().alias("h")
            mine = mine.union(held.join(new.select(*edition).distinct().alias("e"), _same("h", "e", edition), "left_semi").select("b"))
        touched = sorted({r["b"] for r in mine.collect()})  # n at most
        merged = merge_editions(_read(spark, target, state, touched), new, keys, edition, tiebreak, out)
    name = free_name(merged.columns, "bucket")
    staged = f"{target}/_staging-{run}"
    # AQE splits a bucket that holds a hot group; files follow the bytes.
    merged.withColumn(name, bucket_of(keys, n)).hint("rebalance", name).write.partitionBy(name).parquet(staged)
    fs, folder = file_system(spark, staged)
    jpath, written_to = spark._jvm.org.apache.hadoop.fs.Path, {}
    for status in fs.listStatus(folder):
        part = status.getPath().getName()
        if part.startswith(f"{name}="):
            b = part.split("=", 1)[1]
            fs.mkdirs(jpath(f"{target}/b{b}"))
            if not fs.rename(status.getPath(), jpath(f"{target}/b{b}/run-{run}")):
                raise OSError(f"cannot move {part} into {target}")
            written_to[b] = f"b{b}/run-{run}"
    fs.delete(folder, True)
    seen = state["buckets"] if state else {}
    gone = {str(b) for b in touched} - set(written_to) if state else set()

    def change(now):
        there = now["buckets"] if now else {}
        if (now is None) != (state is None) or any(there.get(b) != seen.get(b) for b in {*written_to, *gone}):
            raise Conflict(target)
        return {"n": n, "schema": merged.schema.jsonValue(), "buckets": {b: f for b, f in {**there, **written_to}.items() if b not in gone}}
    commit(spark, target, change)
    fs, base = file_system(spark, target)
    there = {f"{b.getPath().getName()}/{r.getPath().getName()}" for b in fs.listStatus(base)
             if b.getPath().getName().startswith("b") for r in fs.listStatus(b.getPath())}
    expire(spark, target, lambda s: set(s["buckets"].values()), there, lease_s)
    return sorted(int(b) for b in {*written_to, *gone})
