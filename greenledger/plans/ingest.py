"""Ingestion runner: validate and land each requested source, isolated.

A failure in one source (contract violation, unreadable input, unknown name)
becomes a report row and the other sources still run. Executors do the
reading, validation and writing; only one status row per source reaches the
driver.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from greenledger.contracts import Contract
from greenledger.operators.validate import (
    INVALID,
    STATUS,
    ContractError,
    Validated,
    enforce,
    validate,
)
from greenledger.sources.bronze import replace_years

REPORT_SCHEMA = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("reason", T.StringType(), True),
    T.StructField("duration_s", T.DoubleType(), True),
])


@dataclass(frozen=True)
class SourceSpec:
    name: str
    read: Callable[[SparkSession], DataFrame]   # raw bronze rows (text columns + year)
    contract: Contract
    fixed_year: int | None = None               # edition key of a source without a year column


def ingest_source(spark: SparkSession, spec: SourceSpec, bronze_root: str) -> str:
    """Validate under the contract's policy and land the valid rows per year.

    The years that the valid rows bring are replaced in one step. Strict sources are read
    ONCE: the valid rows are written to a staging folder while the status
    counts are observed in the same job, and are refused there if any row is
    invalid, so a failed batch lands nothing.
    """
    checked = validate(spec.read(spark), spec.contract)

    def with_year(df: DataFrame) -> DataFrame:
        if "year" in df.columns:
            return df
        return df.withColumn("year", F.lit(spec.fixed_year).cast("int"))

    if spec.contract.on_error != "fail":
        return replace_years(with_year(checked.valid_raw), bronze_root, spec.name)

    obs = Observation(f"ingest_{spec.name}_{uuid.uuid4().hex}")
    s = F.col(STATUS)
    observed = checked.annotated.observe(
        obs, F.count(F.lit(1)).alias("total"), F.count_if(s == INVALID).alias("invalid"))
    valid = Validated(observed, checked.contract, checked.raw_columns).valid_raw

    def accept() -> None:
        try:
            counts = obs.get
            total, invalid = counts["total"], counts["invalid"]
        except Exception:  # metrics dropped when the optimizer folds the input away
            row = checked.summary().first()
            total, invalid = row["total"], row["invalid"]
        if total == 0 or invalid:
            enforce(checked)  # failure path only: re-reads to build the message sample
            raise ContractError(f"{spec.name}: input is empty, no rows to validate")

    return replace_years(with_year(valid), bronze_root, spec.name, accept=accept)


def _run_one(spark: SparkSession, registry: dict[str, SourceSpec], bronze_root: str, name: str):
    spec = registry.get(name)
    if spec is None:
        return (name, "error", "unknown_source", None)
    start = time.perf_counter()
    try:
        ingest_source(spark, spec, bronze_root)
        return (name, "ok", None, round(time.perf_counter() - start, 2))
    except Exception as exc:  # one source's failure must not stop the others
        reason = str(exc) or type(exc).__name__
        return (name, "error", reason, round(time.perf_counter() - start, 2))


def run_sources(spark: SparkSession, registry: dict[str, SourceSpec], bronze_root: str,
                names: list[str] | None = None, max_parallel: int = 1) -> DataFrame:
    """Run ``names`` (default: all registered) and report one row per source.

    ``max_parallel > 1`` submits the independent sources' Spark jobs from
    that many driver threads, so small sources do not leave a large cluster
    idle while a big one runs; the report keeps the requested order.
    """
    names = list(registry) if names is None else list(names)
    if max_parallel > 1:
        with ThreadPoolExecutor(max_workers=max_parallel) as pool:
            rows = list(pool.map(lambda n: _run_one(spark, registry, bronze_root, n), names))
    else:
        rows = [_run_one(spark, registry, bronze_root, n) for n in names]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def all_ok(report: DataFrame) -> DataFrame:
    """One row: ok = every source succeeded (A5)."""
    return report.agg(F.coalesce(F.every(F.col("status") == "ok"), F.lit(True)).alias("ok"))
