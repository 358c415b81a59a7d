"""Full refresh of a serving database's table in one transaction.

A Spark data source whose tasks write to a staging table and whose driver swaps it in:

1. the driver makes a staging table that belongs to this run;
2. every task inserts its rows there in one transaction, tagged with an id of its
   own, and reports id and row count; an attempt that fails rolls back, and rows
   of an attempt that nobody counts (a lost or doubled one) are never read;
3. the driver, in ONE transaction, checks what was staged against the reports,
   deletes the target's rows, inserts those of the counted attempts, compares the
   target's count, enters the run in a ledger, and commits.

Readers see the old rows until then and the new ones after. If anything
fails, the transaction rolls back and the staging table is dropped: nothing changed.
A run named again after its commit (a driver lost while waiting for the
answer) finds itself in the ledger and changes nothing.

The database is reached through a DB-API connection that ``connect`` makes on the
driver and in each task; what differs between databases is in a ``Dialect``.
"""

from __future__ import annotations

import datetime as dt
import pickle
import re
import sys
import uuid
from collections.abc import Callable
from contextlib import closing
from dataclasses import dataclass, field
from itertools import islice

from pyspark.cloudpickle import dumps, register_pickle_by_value
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from greenledger.contracts import GOLD_SCHEMA, PUBLISH_COLUMNS, PUBLISH_MAX_LENGTHS

# Tasks get this module's code along: the library need not be installed there.
register_pickle_by_value(sys.modules[__name__])

#: End of a validity that is still open, here and in the database's own words.
OPEN_END = dt.date(9999, 12, 31)
LEDGER = "serving_loads"
ATTEMPT = "load_attempt"


@dataclass(frozen=True)
class Dialect:
    """What a database's SQL needs to know: parameter mark, column types by Spark
    type, and what the open end of a validity is written as."""

    mark: str
    types: dict[str, str]
    open_end: object
    text: str = "VARCHAR({n})"
    #: Statement that starts a transaction, where the connection doesn't by itself.
    begin: str | None = None

    def column(self, f: T.StructField, lengths: dict[str, int]) -> str:
        kind = f.dataType.simpleString()
        sql = self.text.format(n=lengths[f.name]) if kind == "string" and f.name in lengths else self.types[kind]
        return f"{f.name} {sql}{'' if f.nullable else ' NOT NULL'}"


POSTGRES = Dialect("%s", {"string": "TEXT", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE PRECISION",
                          "date": "DATE", "boolean": "BOOLEAN", "timestamp": "TIMESTAMPTZ"}, "infinity")


@dataclass(frozen=True)
class Target:
    """A table of a database, and how to reach it."""

    connect: Callable[[], object]
    table: str
    dialect: Dialect = POSTGRES
    schema: T.StructType = field(default_factory=lambda: T.StructType([GOLD_SCHEMA[c] for c in PUBLISH_COLUMNS]))
    lengths: dict[str, int] = field(default_factory=lambda: dict(PUBLISH_MAX_LENGTHS))
    #: Columns in which ``OPEN_END`` stands for an open end.
    open_columns: tuple[str, ...] = ("valid_to",)
    batch: int = 1000

    def __post_init__(self):
        for name in (self.table, *self.schema.names):
            if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?", name):
                raise ValueError(f"not a plain identifier: {name!r}")

    def staging(self, run: str) -> str:
        return f"{self.table}__load_{run}"

    def columns(self) -> str:
        return ", ".join(self.schema.names)

    def make_table(self, name: str, *more: str) -> str:
        return f"CREATE TABLE IF NOT EXISTS {name} ({', '.join([*(self.dialect.column(f, self.lengths) for f in self.schema), *more])})"

    def values(self, row) -> tuple:
        """A row's values in column order, the open end in the database's words."""
        return tuple(self.dialect.open_end if c in self.open_columns and v == OPEN_END else v
                     for c, v in ((c, row[c]) for c in self.schema.names))

    def transaction(self, work: Callable[[object], object]):
        """``work(cursor)`` in one transaction: committed, or rolled back with the error passed on."""
        with closing(self.connect()) as con:
            cur = con.cursor()
            try:
                if self.dialect.begin:
                    cur.execute(self.dialect.begin)
                out = work(cur)
                con.commit()
                return out
            except BaseException:
                con.rollback()
                raise


@dataclass
class Staged(WriterCommitMessage):
    attempt: str
    rows: int


class StagedWriter(DataSourceWriter):
    """Writes to the staging table of one run and swaps it in; see the module text."""

    def __init__(self, target: Target, run: str):
        self.target, self.run = target, run

    def write(self, rows) -> Staged:
        t, attempt, n = self.target, uuid.uuid4().hex, 0
        marks = ", ".join([t.dialect.mark] * (len(t.schema) + 1))
        sql = f"INSERT INTO {t.staging(self.run)} ({t.columns()}, {ATTEMPT}) VALUES ({marks})"

        def insert(cur):
            nonlocal n
            # One batch is in memory at a time; the first is read before the transaction begins.
            batch = first
            while batch:
                cur.executemany(sql, [(*t.values(r), attempt) for r in batch])
                n += len(batch)
                batch = list(islice(rows, t.batch))

        first = list(islice(rows, t.batch))
        if first:
            t.transaction(insert)
        return Staged(attempt, n)

    def commit(self, messages: list[Staged | None]) -> None:
        t, staging = self.target, self.target.staging(self.run)
        done = [(m.attempt, m.rows) for m in messages if m is not None and m.rows]
        total = sum(n for _, n in done)
        mark = t.dialect.mark

        def swap(cur):
            # The counted attempts go to a table: a list of them may be longer than a statement.
            cur.execute(f"CREATE TABLE {staging}_ok ({ATTEMPT} VARCHAR(32), n BIGINT)")
            if done:
                cur.executemany(f"INSERT INTO {staging}_ok VALUES ({mark}, {mark})", done)
            cur.execute(f"SELECT count(*) FROM (SELECT ok.n, count(s.{ATTEMPT}) AS found FROM {staging}_ok ok LEFT JOIN {staging} s "
                        f"ON s.{ATTEMPT} = ok.{ATTEMPT} GROUP BY ok.{ATTEMPT}, ok.n) x WHERE n <> found")
            if cur.fetchone()[0]:
                raise RuntimeError("staged rows don't match what the tasks reported")
            cur.execute(t.make_table(t.table))
            cur.execute(f"DELETE FROM {t.table}")
            cur.execute(f"INSERT INTO {t.table} ({t.columns()}) SELECT {t.columns()} FROM {staging} "
                        f"WHERE {ATTEMPT} IN (SELECT {ATTEMPT} FROM {staging}_ok)")
            cur.execute(f"SELECT count(*) FROM {t.table}")
            there = cur.fetchone()[0]
            if there != total:
                raise RuntimeError(f"verification failed: source={total} rows, target={there} rows")
            cur.execute(f"INSERT INTO {LEDGER} (run, target, n) VALUES ({mark}, {mark}, {mark})", (self.run, t.table, total))
            cur.execute(f"DROP TABLE {staging}_ok")
            cur.execute(f"DROP TABLE {staging}")

        t.transaction(swap)

    def abort(self, messages: list[Staged | None]) -> None:
        t, staging = self.target, self.target.staging(self.run)

        def drop(cur):
            cur.execute(f"DROP TABLE IF EXISTS {staging}_ok")
            cur.execute(f"DROP TABLE IF EXISTS {staging}")
        t.transaction(drop)


class ServingTable(DataSource):
    """``df.write.format("serving_table")``; used through :func:`refresh_table`."""

    @classmethod
    def name(cls) -> str:
        return "serving_table"

    def writer(self, schema: T.StructType, overwrite: bool) -> StagedWriter:
        return StagedWriter(pickle.loads(bytes.fromhex(self.options["target"])), self.options["run"])


def loaded(target: Target, run: str) -> int | None:
    """Rows that ``run`` has committed to ``target``; None if it hasn't."""
    mark = target.dialect.mark

    def look(cur):
        cur.execute(f"CREATE TABLE IF NOT EXISTS {LEDGER} (run VARCHAR(64), target VARCHAR(200), n BIGINT)")
        cur.execute(f"SELECT n FROM {LEDGER} WHERE run = {mark} AND target = {mark}", (run, target.table))
        return cur.fetchone()
    row = target.transaction(look)
    return None if row is None else row[0]


def refresh_table(df: DataFrame, target: Target, run: str | None = None) -> int:
    """Replace all rows of ``target`` by those of ``df`` in one transaction; the number of rows.

    Columns are taken by name and must have the declared types (ValueError); others
    are left out. Text longer than its column, or a null in a NOT NULL column, is the database's error: the refresh
    fails as a whole. An empty ``df`` empties the table. ``run`` names the refresh: one that is in the ledger already
    is not repeated. Staging rows of a run whose driver was lost stay until
    ``run`` is named again or its staging table is dropped by hand.
    """
    from greenledger.sources.publish import check_schema

    run = run or uuid.uuid4().hex
    if not re.fullmatch(r"[A-Za-z0-9_]{1,64}", run):
        raise ValueError("a run is named by letters, digits and underscores")
    have = df.select(*target.schema.names)
    check_schema(have, target.schema)
    before = loaded(target, run)
    if before is not None:
        return before
    staging = target.staging(run)

    def prepare(cur):
        for name in (f"{staging}_ok", staging):  # left by a lost driver
            cur.execute(f"DROP TABLE IF EXISTS {name}")
        cur.execute(target.make_table(staging, f"{ATTEMPT} VARCHAR(32)"))
    target.transaction(prepare)
    df.sparkSession.dataSource.register(ServingTable)
    (have.write.format("serving_table").mode("append")
     .option("target", dumps(target).hex()).option("run", run).save())
    return loaded(target, run)


def read_back(target: Target, day: dt.date) -> list[tuple]:
    """Rows of ``target`` valid on ``day``, as a serving client asks for them."""
    mark = target.dialect.mark

    def look(cur):
        cur.execute(f"SELECT {target.columns()} FROM {target.table} WHERE valid_from <= {mark} AND valid_to >= {mark}", (day, day))
        return cur.fetchall()
    return target.transaction(look)
