"""Materialise, publish and reconcile the dimension.

Publishing is a full refresh with the same end state on every re-run. Each run
writes a version folder of its own, in order of validity, and a table of its files' least
and largest validity dates; then it commits the version to the log (see
``versions``), the one step that readers see. A run that fails while
writing changes nothing for them, nor do two runs at once. Readers that ask for a day open only the files that
may hold rows valid then.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from greenledger.contracts import GOLD_SCHEMA, PUBLISH_COLUMNS, PUBLISH_MAX_LENGTHS
from greenledger.operators.usage import usable_on
from greenledger.sources.versions import LEASE_S, commit, expire, file_system, newest


def check_schema(df: DataFrame, schema: T.StructType = GOLD_SCHEMA) -> None:
    """Every declared column present with the declared type.

    NOT NULL and key constraints are data checks (see operators.checks).
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in schema.fields:
        if f.name not in have:
            problems.append(f"missing {f.name}")
        elif have[f.name] != f.dataType:
            problems.append(f"{f.name}: {have[f.name].simpleString()} != {f.dataType.simpleString()}")
    if problems:
        raise ValueError("schema mismatch: " + "; ".join(problems))


def materialise(df: DataFrame, path: str) -> str:
    """Table materialisation of a model as parquet."""
    df.write.mode("overwrite").parquet(path)
    return path


#: Order of the published rows: days first, so that a file holds few of them;
#: the id closes it, so that runs of equal keys can be split.
PUBLISH_ORDER = ("valid_from", "valid_to", "source", "country_code", "factor_name", "source_year", "ef_id")
#: Columns whose least and largest values are kept per file.
FILE_RANGES = ("valid_from", "valid_to")


def publish_snapshot(df: DataFrame, target: str, columns: tuple[str, ...] = PUBLISH_COLUMNS,
                     order: tuple[str, ...] = PUBLISH_ORDER, ranges: tuple[str, ...] = FILE_RANGES,
                     lease_s: float = LEASE_S) -> int:
    """Full-refresh ``target`` with ``df`` using an explicit column list.

    Returns the number of rows written (observed during the write). Rows are dealt
    by range of ``order`` and sorted in each file (O1); with AQE the files' sizes
    follow the bytes. The version published before stays until the next run,
    for readers that still use it; older ones are removed, and what a dead run
    has left after ``lease_s`` seconds.
    """
    spark = df.sparkSession
    run = uuid.uuid4().hex
    obs = Observation(f"publish_{run}")
    rows = df.select(*columns)
    keys = [F.col(c).asc_nulls_last() for c in order if c in rows.columns]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys) if keys else rows
    # Counted behind the exchange: its bounds are sampled in a pass of their own.
    dealt.observe(obs, F.count(F.lit(1)).alias("rows")).write.parquet(f"{target}/version-{run}")
    count = int(obs.get["rows"])
    kept = [c for c in ranges if c in rows.columns]
    (spark.read.schema(rows.schema).parquet(f"{target}/version-{run}").groupBy(F.col("_metadata.file_name").alias("file"))
     .agg(F.count(F.lit(1)).alias("rows"), *[f(c).alias(f"{name}_{c}") for c in kept for name, f in (("min", F.min), ("max", F.max))])
     .write.parquet(f"{target}/files-{run}"))
    state = {"version": f"version-{run}", "files": f"files-{run}", "rows": count, "ranges": kept}
    commit(spark, target, lambda _: state)
    fs, folder = file_system(spark, target)
    there = {s.getPath().getName() for s in fs.listStatus(folder)}
    expire(spark, target, lambda s: {s["version"], s["files"]},
           {n for n in there if n.startswith(("version-", "files-"))}, lease_s)
    return count


def current_version(spark: SparkSession, target: str) -> str | None:
    """Name of the published version folder; None if nothing is published."""
    state = newest(spark, target)
    return state and state["version"]


def _published(spark: SparkSession, target: str) -> dict:
    state = newest(spark, target)
    if state is None:
        raise FileNotFoundError(f"nothing is published under {target}")
    return state


def read_snapshot(spark: SparkSession, target: str) -> DataFrame:
    """The published rows, from the newest version."""
    return spark.read.parquet(f"{target}/{_published(spark, target)['version']}")


def files_valid_on(spark: SparkSession, target: str, day: dt.date | str) -> tuple[list[str], int]:
    """(paths of the published files that may hold rows valid on ``day``, number of all files)."""
    state = _published(spark, target)
    if not set(FILE_RANGES) <= set(state["ranges"]):
        raise ValueError(f"{target}: no ranges of {FILE_RANGES} were kept")
    files = spark.read.parquet(f"{target}/{state['files']}")
    d = F.lit(day).cast("date")
    held = files.where((F.col("min_valid_from") <= d) & (F.col("max_valid_to") >= d))
    # One name per file to open: what a scan of the folder would list, or fewer.
    return [f"{target}/{state['version']}/{r['file']}" for r in held.select("file").collect()], files.count()


def read_valid_on(spark: SparkSession, target: str, day: dt.date | str) -> DataFrame:
    """Published rows valid on ``day`` (E1): files are left out by their ranges, then
    row groups and rows by the pushed predicates."""
    whole = read_snapshot(spark, target)
    paths, _ = files_valid_on(spark, target, day)
    return usable_on(spark.read.schema(whole.schema).parquet(*paths) if paths else whole.limit(0), day)


def discard(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def publish_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str],
                 columns: tuple[str, ...] = PUBLISH_COLUMNS) -> None:
    """Full refresh of a database table through JDBC: truncate + insert of an
    explicit column list, text lengths as declared.

    Not verified against a database. An open end is written as the date
    9999-12-31, not as the database's ``infinity``, and truncate and insert are
    two transactions: readers may see an empty table in between. Where that
    matters, use ``serving.refresh_table``.
    """
    types = ", ".join(f"{c} VARCHAR({n})" for c, n in PUBLISH_MAX_LENGTHS.items())
    props = {"truncate": "true", "createTableColumnTypes": types, **properties}
    df.select(*columns).write.jdbc(url, table, mode="overwrite", properties=props)


def reconcile_counts(src: DataFrame, dst: DataFrame) -> DataFrame:
    """One row: src_rows, dst_rows, matched.

    Both counts come from one aggregate over the tagged union of the two
    inputs (no join between them).
    """
    tagged = (src.select(F.lit(1).alias("__s"), F.lit(0).alias("__d"))
                 .unionByName(dst.select(F.lit(0).alias("__s"), F.lit(1).alias("__d"))))
    counts = tagged.agg(F.coalesce(F.sum("__s"), F.lit(0)).cast("bigint").alias("src_rows"),
                        F.coalesce(F.sum("__d"), F.lit(0)).cast("bigint").alias("dst_rows"))
    return counts.withColumn("matched", F.col("src_rows") == F.col("dst_rows"))


def reconcile_written(spark: SparkSession, written: int, dst: DataFrame) -> DataFrame:
    """Like :func:`reconcile_counts`, with the source count observed while
    writing (no second evaluation of the source)."""
    return (dst.agg(F.count(F.lit(1)).alias("dst_rows"))
               .select(F.lit(written).cast("bigint").alias("src_rows"), "dst_rows")
               .withColumn("matched", F.col("src_rows") == F.col("dst_rows")))


def assert_reconciled(src: DataFrame, dst: DataFrame) -> int:
    row = reconcile_counts(src, dst).collect()[0]
    if not row["matched"]:
        raise RuntimeError(f"verification failed: source={row['src_rows']} rows, "
                           f"target={row['dst_rows']} rows")
    return row["dst_rows"]
