"""Bronze CSV files: scan, land, sheet normalisation.

Layout: ``{root}/{source}/year=YYYY/part-*.csv`` (one folder per edition
year, written with dynamic partition overwrite so a re-run replaces only the
years it brings), or, where years are replaced in one step (``replace_years``),
``year=YYYY/run=*/part-*.csv`` with a log that names the run that counts for
each year. The publisher layout ``{root}/{source}/{YYYY}/factors.csv``
is read too; each file's columns are bound by its own header names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from greenledger.contracts import text_schema
from greenledger.sources.versions import LEASE_S, commit, expire, file_system, newest

# White space is data: the writer would strip it by default.
CSV_OPTIONS = {"header": "true", "escape": '"', "multiLine": "true", "encoding": "UTF-8",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def bronze_path(root: str, source: str) -> str:
    return f"{root.rstrip('/')}/{source}"


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Header names of a CSV file, or of the first file of a folder."""
    return [c for c in spark.read.options(**CSV_OPTIONS).option("inferSchema", "false").csv(path).columns]


def scan_by_name(spark: SparkSession, path: str | list[str], columns: list[str], paths: dict | None = None,
                 base: str | None = None) -> DataFrame:
    """Text ``columns`` of CSV files, bound by header name whatever their order.

    The header of the first file gives the order; files with another header
    fail the read (``enforceSchema`` off) instead of being misread. A missing
    column is an error. Partition columns of the path (below ``base``) come along.
    """
    header = csv_header(spark, path if isinstance(path, str) else path[0])
    names = {c.strip(): c for c in header}
    missing = [c for c in columns if c not in names]
    if missing:
        raise ValueError(f"{path}: no column {missing} in header {header}")
    reader = spark.read.options(**CSV_OPTIONS).option("enforceSchema", "false")
    if base:
        reader = reader.option("basePath", base)
    df = reader.schema(text_schema([c for c in header if c not in (paths or {})])).csv(path)
    return df.withColumnsRenamed({names[c]: c for c in columns if names[c] != c})


def publisher_files(spark: SparkSession, root: str, source: str) -> dict[str, str]:
    """{year folder: path} of ``{root}/{source}/{YYYY}/factors.csv``: one per edition."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{bronze_path(root, source)}/*/factors.csv")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return {s.getPath().getParent().getName(): s.getPath().toString() for s in found or ()}


def scan_bronze(spark: SparkSession, root: str, source: str, columns: list[str],
                layout: str = "partitioned") -> DataFrame:
    """All editions of one source as text columns plus an int ``year``.

    ``partitioned``: ``year=`` folders, partition pruning applies to ``year``.
    ``publisher``: one ``{year}/factors.csv`` per edition, each with its own
    header; a ``year`` column inside the file wins, else the folder names it.
    Never infers a schema: every data column is read as text, by header name.
    """
    data_cols = [c for c in columns if c != "year"]
    base = bronze_path(root, source)
    if layout == "partitioned":
        state = newest(spark, base)
        at = base if state is None else [f"{base}/{folder}" for _, folder in sorted(state["years"].items())]
        if not at:
            raise ValueError(f"{base}: no year has landed")
        df = scan_by_name(spark, at, data_cols, {"year": 1, "batch": 1, "run": 1}, base)
        return df.select(*[F.col(f"`{c}`") for c in data_cols], F.col("year").cast("int").alias("year"))
    editions = []
    for folder, path in sorted(publisher_files(spark, root, source).items()):
        own = any(c.strip() == "year" for c in csv_header(spark, path))
        df = scan_by_name(spark, path, data_cols + ["year"] * own)
        year = F.col("year") if own else F.lit(folder)
        editions.append(df.select(*[F.col(f"`{c}`") for c in data_cols], year.try_cast("int").alias("year")))
    if not editions:
        raise ValueError(f"{base}: no {{year}}/factors.csv")
    return reduce(lambda x, y: x.unionByName(y), editions)


def land_bronze(df: DataFrame, root: str, source: str, year_col: str = "year",
                files_per_year: int | None = None) -> str:
    """Write one folder per year; a re-run overwrites only its own years.

    With AQE on (the library's setting) rows are REBALANCEd by year: AQE
    splits a year holding a third of all rows into advisory-sized partitions
    and merges small ones, so file sizes follow the data, not a constant.
    Without AQE, rows are spread over (year, content-hash bucket), with
    ``files_per_year`` buckets (default: the shuffle partition count); the
    bucket is deterministic, so a retried task rewrites the same rows.
    """
    path = bronze_path(root, source)
    spark = df.sparkSession
    if spark.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true":
        spread = df.hint("rebalance", year_col)
    else:
        n = files_per_year or int(spark.conf.get("spark.sql.shuffle.partitions"))
        bucket = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(n))
        spread = df.repartition(F.col(year_col), bucket)
    (spread.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .options(**CSV_OPTIONS)
       .partitionBy(year_col)
       .csv(path))
    return path


def replace_years(df: DataFrame, root: str, source: str, year_col: str = "year",
                  accept: Callable[[], None] | None = None, lease_s: float = LEASE_S) -> str:
    """Land ``df`` and replace the years it brings in one step (S6); the source's folder.

    Rows are written to a staging folder, their year folders are moved to names
    that no reader knows (``year=YYYY/run=<run>``), and the log is told that these
    count now. ``accept`` is called once the rows are written and may raise to refuse them. A run
    that dies anywhere leaves the state before it; a year is never absent, and
    of two runs that bring different years both are kept. The runs replaced last stay for readers that still use them.
    """
    spark, run = df.sparkSession, uuid.uuid4().hex
    base = bronze_path(root, source)
    staged_root = f"{root.rstrip('/')}/_staging-{run}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    try:
        staged = land_bronze(df, staged_root, source, year_col)
        if accept:
            accept()
        fs, folder = file_system(spark, staged)
        brought = {}
        for status in fs.listStatus(folder):
            name = status.getPath().getName()
            if not name.startswith(f"{year_col}="):
                continue
            fs.mkdirs(jpath(f"{base}/{name}"))
            if not fs.rename(status.getPath(), jpath(f"{base}/{name}/run={run}")):
                raise OSError(f"cannot move {name} into {base}")
            brought[name.split("=", 1)[1]] = f"{name}/run={run}"
    finally:
        staging, path = file_system(spark, staged_root)
        staging.delete(path, True)
    commit(spark, base, lambda state: {"years": {**(state["years"] if state else {}), **brought}})
    fs, _ = file_system(spark, base)
    there = {f"{y.getPath().getName()}/{r.getPath().getName()}" for y in fs.listStatus(jpath(base))
             if y.getPath().getName().startswith(f"{year_col}=") for r in fs.listStatus(y.getPath())
             if r.getPath().getName().startswith("run=")}
    expire(spark, base, lambda s: set(s["years"].values()), there, lease_s)
    return base


def read_publisher_csv(spark: SparkSession, path: str) -> DataFrame:
    """A publisher's CSV as delivered: header names kept, every column text,
    a UTF-8 byte-order mark stripped; a file without columns is an error (S2)."""
    df = spark.read.options(**CSV_OPTIONS).option("inferSchema", "false").csv(path)
    if not df.columns:
        raise ValueError(f"{path}: CSV has no columns")
    return df


def resolve_prefixed_column(df: DataFrame, prefix: str, canonical: str,
                            on_missing: str = "empty") -> DataFrame:
    """Rename the first header starting with ``prefix`` to ``canonical``.

    A missing column yields an empty frame (``on_missing="empty"``, the
    catalog's policy) or an error (``"fail"``), never a wrong column.
    """
    found = find_column_prefix(df.columns, prefix)
    if found is None:
        if on_missing == "fail":
            raise ValueError(f"no column starting with {prefix!r} in {df.columns}")
        return df.limit(0).withColumn(canonical, F.lit(None).cast("string"))
    return df.withColumnRenamed(found, canonical)


def year_slice(df: DataFrame, year: int, year_col: str = "year") -> DataFrame:
    """Rows of one edition (P11); on the ``year=`` layout only that folder is read."""
    return df.where(F.col(year_col) == F.lit(year))


def normalise_sheet(df: DataFrame) -> DataFrame:
    """Drop wholly empty rows and trim header names (S3)."""
    return df.na.drop(how="all").toDF(*[c.strip() for c in df.columns])


def find_column(columns: list[str], target: str) -> str | None:
    """Header match ignoring case and surrounding blanks."""
    t = target.strip().lower()
    return next((c for c in columns if str(c).strip().lower() == t), None)


def find_column_prefix(columns: list[str], prefix: str) -> str | None:
    """First header starting with ``prefix``."""
    return next((c for c in columns if str(c).startswith(prefix)), None)


def sheet_tag(sheet: Column, patterns: tuple[tuple[str, str], ...]) -> Column:
    """Tag of a sheet name: the first pattern it contains (case-insensitive)."""
    name = F.lower(sheet)
    expr = None
    for needle, tag in patterns:
        cond = name.contains(needle.lower())
        expr = F.when(cond, F.lit(tag)) if expr is None else expr.when(cond, F.lit(tag))
    return expr


def union_tagged_sheets(df: DataFrame, sheet_col: str, patterns: tuple[tuple[str, str], ...],
                        headers: dict[str, str], tag_col: str = "factor_type") -> DataFrame:
    """Rows of all sheets with a tag derived from the sheet name.

    ``df`` holds every sheet's rows with the sheet name in ``sheet_col`` (for
    files: ``_metadata.file_name``). Sheets matching no pattern are skipped;
    ``headers`` maps output names to header names, found case-insensitively.
    """
    cols = {}
    for out, header in headers.items():
        found = find_column(df.columns, header)
        if found is None:
            raise ValueError(f"column {header!r} not found in {df.columns}")
        cols[out] = F.col(f"`{found}`")
    tagged = df.select(*[c.alias(o) for o, c in cols.items()],
                       sheet_tag(F.col(sheet_col), patterns).alias(tag_col))
    return tagged.where(F.col(tag_col).isNotNull())


def distinct_years(df: DataFrame, year_col: str = "year") -> DataFrame:
    """Sorted distinct years (A2, O2)."""
    return df.select(year_col).distinct().orderBy(year_col)


def rows_per_year(df: DataFrame, year_col: str = "year") -> DataFrame:
    """Row count of each year (A3)."""
    return df.groupBy(year_col).agg(F.count(F.lit(1)).alias("rows")).orderBy(year_col)
