"""Incremental landing of newly arrived publisher files (Structured Streaming).

The batch runner (``plans.ingest``) re-reads a whole source. When publisher
files arrive over time, the same validate-and-land step runs as a file
stream with ``trigger(availableNow=True)``: each run processes only files
not yet seen (tracked in the checkpoint), survives executor loss through the
checkpoint and the sinks' commit logs, and stops when caught up.

Every file batch is read and validated once. Its rows are written by batch
number, so a batch that is retried after a failure overwrites what it wrote
before: valid rows under ``year=/batch=``, rejected ones under ``batch=`` in a
quarantine folder, both from one checkpoint. The numbers of valid, invalid and skipped
rows are observed while the rejected ones are written, and stored under the batch number too,
last of all: a replayed batch counts once. Strict contracts decide per batch:
one with any invalid row fails the stream before anything is written, and the
same files are retried on the next run.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from greenledger.contracts import Contract, text_schema
from greenledger.operators.validate import INVALID, SKIPPED, STATUS, VALID, VIOLATIONS, Validated, enforce, validate
from greenledger.sources.bronze import CSV_OPTIONS, bronze_path

COUNTED = (VALID, INVALID, SKIPPED)
COUNTERS = f"source string, total long, {', '.join(f'{k} long' for k in COUNTED)}, batch long"


def arrivals(spark: SparkSession, incoming: str, columns: list[str],
             max_files_per_trigger: int | None = None) -> DataFrame:
    """Text rows of every CSV file arriving under ``incoming`` (any depth).

    Columns are bound by header name: the first file present gives the order
    (``columns`` itself if none is there yet). A file with another header fails
    the stream instead of being misread, and so does a missing column.
    """
    nested = {"recursiveFileLookup": "true"}
    try:
        header = spark.read.options(**CSV_OPTIONS, **nested).csv(incoming).columns
    except AnalysisException:  # no file yet
        header = []
    header = header or columns
    missing = [c for c in columns if c not in header]
    if missing:
        raise ValueError(f"{incoming}: no column {missing} in header {header}")
    reader = (spark.readStream.schema(text_schema(header)).options(**CSV_OPTIONS, **nested)
              .option("enforceSchema", "false"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(incoming).select(*[F.col(f"`{c}`") for c in columns])


def land_arrivals(spark: SparkSession, incoming: str, contract: Contract, bronze_root: str,
                  source: str, checkpoint: str | None = None,
                  fixed_year: int | None = None, max_files_per_trigger: int | None = None) -> list[StreamingQuery]:
    """Start the landing stream for one source; returns the running queries."""
    cols = contract.names + list(contract.keep)
    if "year" not in cols and fixed_year is None:
        raise ValueError("a source without a year column needs fixed_year")
    # A checkpoint belongs to its sink: by default it lives next to the bronze.
    checkpoint = checkpoint or f"{bronze_root.rstrip('/')}/_checkpoints/{source}"

    def batch(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            one = validate(df, contract)
            enforce(one)  # strict contracts raise: the batch is not committed and is retried
            valid = one.valid_raw
            if "year" not in valid.columns:
                valid = valid.withColumn("year", F.lit(fixed_year).cast("int"))
            number = F.lit(batch_id).cast("long")
            seen = Observation(f"landing_{source}_{batch_id}_{uuid.uuid4().hex}")
            status = F.col(STATUS)
            observed = Validated(one.annotated.observe(seen, F.count(F.lit(1)).alias("total"), *[
                F.count_if(status == kind).alias(kind) for kind in COUNTED]), contract, one.raw_columns)
            rejected = observed.rejected.withColumn(VIOLATIONS, F.array_join(VIOLATIONS, "; "))
            for rows, fmt, path, by in ((valid, "csv", bronze_path(bronze_root, source), ["year", "batch"]),
                                        (rejected, "parquet", bronze_path(bronze_root, f"_rejected/{source}"), ["batch"])):
                (rows.withColumn("batch", number).write.format(fmt).options(**CSV_OPTIONS if fmt == "csv" else {})
                 .mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).save(path))
            try:
                counts = seen.get
            except Exception:  # metrics dropped when the optimizer folds the input away
                counts = one.summary().first().asDict()
            (spark.createDataFrame([(source, counts["total"], *[counts[k] for k in COUNTED], batch_id)], COUNTERS).coalesce(1)
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(
                 counters_path(bronze_root, source)))
        finally:
            df.unpersist()

    rows = arrivals(spark, incoming, cols, max_files_per_trigger)
    return [rows.writeStream.foreachBatch(batch)
            .option("checkpointLocation", f"{checkpoint}/landing")
            .trigger(availableNow=True).start()]


def counters_path(bronze_root: str, source: str) -> str:
    return bronze_path(bronze_root, f"_counters/{source}")


def landing_summary(spark: SparkSession, bronze_root: str, source: str) -> DataFrame:
    """One row: source, total, valid, invalid, skipped over all batches that the
    stream has landed (V13), as the batch ``summary()`` of the same rows counts them."""
    counters = spark.read.schema(COUNTERS).parquet(counters_path(bronze_root, source))
    return counters.groupBy("source").agg(*[F.sum(c).alias(c) for c in ("total", *COUNTED)])


def run_until_caught_up(queries: list[StreamingQuery], timeout_s: float | None = None) -> None:
    """Wait for availableNow queries to finish; re-raise a stream failure.

    With ``timeout_s`` a query that still runs then is stopped and reported as
    an error: a part of the input is never taken for the whole.
    """
    for q in queries:
        if timeout_s is None:
            q.awaitTermination()
        elif not q.awaitTermination(timeout_s):
            q.stop()
            raise TimeoutError(f"stream {q.id} was not done after {timeout_s} s")
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
