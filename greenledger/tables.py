"""Written intermediate tables in the shared folder, and global positions over them."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from greenledger.session import work_dir


_MADE: dict[str, list[str]] = {}
_NAMED: dict[str, list[str]] = {}


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new folder under the cluster's shared folder (``spark.checkpoint.dir``)."""
    path = work_dir(spark, f"{label}-{uuid.uuid4().hex}")
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def named_table(spark: SparkSession, name: str) -> str:
    """``name``, remembered as a catalog table over an intermediate folder of this application."""
    _NAMED.setdefault(spark.sparkContext.applicationId, []).append(name)
    return name


def clean_up(spark: SparkSession) -> int:
    """Delete the intermediate tables that this application has written, in the
    catalog too; how many folders.

    For the end of a job, once its results are written: frames that still read
    an intermediate table stop working.
    """
    for name in _NAMED.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    paths = _MADE.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return len(paths)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage, survives
    lost executors, and fixes values that a second evaluation might change."""
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(columns: list[str], wanted: str) -> str:
    """``wanted`` with underscores in front until no column has that name."""
    taken = {c.lower() for c in columns}
    name = f"_{wanted}"
    while name in taken:
        name = f"_{name}"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, row: str) -> DataFrame:
    """``df`` with a row number; fixed only once the result is written."""
    return df.withColumn(row, F.monotonically_increasing_id())


def with_positions(df: DataFrame, order: list[str | Column], label: str,
                   sums: dict[str, str] | None = None, partitions: int | None = None) -> DataFrame:
    """``df`` with ``pos`` (0-based place in the global order) and, for each
    ``{name: column}`` of ``sums``, the running total of ``column`` up to and
    including the row.

    Rows are dealt by range of ``order`` into many partitions (a hot key is
    split when ``order`` ends in a unique column), written with their partition
    number, counted per partition, and numbered inside each. Only one row per
    partition meets in one place, so nothing grows with the data there.
    """
    sums = sums or {}
    spark = df.sparkSession
    n = partitions or shuffle_partitions(spark)
    dealt = written(
        df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id()), label)
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy("_pid").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_s_{k}") for k, c in sums.items()])
    # One row per partition: at most n rows, hence the broadcast is bounded.
    offsets = parts.select(
        "_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        *[F.coalesce(F.sum(f"_s_{k}").over(before), F.lit(0)).alias(f"_s0_{k}") for k in sums])
    inside = Window.partitionBy("_pid").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = dealt.select(
        *dealt.columns, (F.row_number().over(inside) - 1).cast("long").alias("_k"),
        *[F.sum(c).over(upto).alias(f"_c_{k}") for k, c in sums.items()])
    return out.join(F.broadcast(offsets), "_pid").select(
        *df.columns, (F.col("_k") + F.col("_n0")).alias("pos"),
        *[(F.col(f"_c_{k}") + F.col(f"_s0_{k}")).alias(k) for k in sums])
