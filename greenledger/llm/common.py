"""Helpers of the training-data operators, beside those of ``greenledger.tables``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from greenledger.tables import fresh_path, free_name, named_table, numbered, shuffle_partitions, with_positions, written

__all__ = ["SPACES", "bucketed", "discard", "free_name", "fresh_path", "numbered", "shuffle_partitions", "with_positions", "written"]

#: Words of the query contracts: runs of anything but these six ASCII spaces.
SPACES = r"[\x20\x09-\x0D]+"


def bucketed(df: DataFrame, row: str, label: str) -> DataFrame:
    """``df`` as a written table bucketed by ``row``, so that later joins of
    narrow rows on ``row`` move the narrow side only, never the texts."""
    spark = df.sparkSession
    n = shuffle_partitions(spark)
    table = named_table(spark, f"gl_{label}_{uuid.uuid4().hex}")
    (df.repartition(n, row).write.option("compression", "zstd")
     .option("path", fresh_path(spark, label)).bucketBy(n, row).saveAsTable(table))
    return spark.table(table)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder made with ``fresh_path`` whose rows a later table holds."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
