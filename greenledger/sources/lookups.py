"""Loading user-supplied lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def load_lookup(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with a declared schema; empty cells are NULL.

    The declared schema overrides per-column types (e.g. a code read as text).
    """
    return (spark.read.schema(schema)
                 .option("header", "true").option("escape", '"')
                 .option("encoding", "UTF-8")
                 .csv(path))
