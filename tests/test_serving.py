"""The transactional refresh against a file-backed stand-in for the serving database."""

import datetime as dt
import os
import sqlite3
import sys
import threading

import pytest
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from greenledger.contracts import GOLD_SCHEMA, PUBLISH_COLUMNS
from greenledger.sources import serving
from greenledger.sources.serving import LEDGER, OPEN_END, POSTGRES, Dialect, StagedWriter, Target, loaded, read_back, refresh_table

register_pickle_by_value(sys.modules[__name__])  # tasks don't have the tests' folder

# 'infinity' sorts after every date here as text, as it does in the database as a date.
FILE_DB = Dialect("?", {"string": "TEXT", "int": "INTEGER", "bigint": "INTEGER", "double": "REAL", "date": "TEXT", "boolean": "INTEGER"},
                  "infinity", begin="BEGIN IMMEDIATE")


class Faulty:
    """A connection that fails at a statement while the file ``fault`` names it."""

    def __init__(self, con, fault):
        self.con, self.fault = con, fault

    def cursor(self):
        cur, fault = self.con.cursor(), self.fault

        class Cursor:
            def execute(self, sql, *args):
                if os.path.exists(fault):
                    with open(fault) as f:
                        if f.read() in sql:
                            raise OSError("connection lost")
                return cur.execute(sql, *args)

            def __getattr__(self, name):
                return getattr(cur, name)
        return Cursor()

    def __getattr__(self, name):
        return getattr(self.con, name)


def file_target(folder, **more):
    path, fault = os.path.join(folder, "serving.db"), os.path.join(folder, "fault")

    def connect():
        sqlite3.register_adapter(dt.date, lambda d: d.isoformat())
        return Faulty(sqlite3.connect(path, timeout=60, isolation_level=None), fault)
    return Target(connect, "dim_factors", FILE_DB, **more)


def gold(spark, n, tag="a", parts=4):
    one = {"string": F.lit(tag), "int": F.lit(2024), "double": F.col("id") / 4, "date": F.lit(dt.date(2024, 1, 1)), "boolean": F.lit(True)}
    df = spark.range(n, numPartitions=parts).select("id", *[
        one[f.dataType.simpleString()].alias(f.name) for f in GOLD_SCHEMA if f.name not in ("ef_id", "valid_to")],
        F.concat(F.lit(tag), F.col("id").cast("string")).alias("ef_id"),
        F.when(F.col("id") % 2 == 0, F.lit(OPEN_END)).otherwise(F.lit(dt.date(2024, 12, 31))).alias("valid_to"))
    return df.withColumn("extra", F.lit("not published"))


def query(target, sql):
    return target.transaction(lambda cur: cur.execute(sql).fetchall())


def tables(target):
    return {r[0] for r in query(target, "SELECT name FROM sqlite_master WHERE type = 'table'")}


@pytest.fixture
def target(tmp_dir):
    return file_target(tmp_dir)


def fault(target_dir, sql):
    with open(os.path.join(target_dir, "fault"), "w") as f:
        f.write(sql)


def test_refresh_replaces_all_rows_and_leaves_no_staging(spark, target):
    assert refresh_table(gold(spark, 2500), target, "one") == 2500
    assert refresh_table(gold(spark, 700, "b", parts=7), target) == 700
    assert query(target, "SELECT count(*), count(DISTINCT ef_id), min(substr(ef_id, 1, 1)), sum(gCO2e_per_unit) FROM dim_factors") == [
        (700, 700, "b", sum(range(700)) / 4)]
    assert tables(target) == {"dim_factors", LEDGER}


def test_open_end_is_the_databases_infinity(spark, target):
    refresh_table(gold(spark, 10), target)
    assert query(target, "SELECT valid_to, count(*) FROM dim_factors GROUP BY 1 ORDER BY 1") == [("2024-12-31", 5), ("infinity", 5)]
    assert len(read_back(target, dt.date(2030, 1, 1))) == 5 and len(read_back(target, dt.date(2024, 6, 1))) == 10
    row = {c: None for c in PUBLISH_COLUMNS} | {"valid_to": OPEN_END, "valid_from": OPEN_END}
    values = dict(zip(PUBLISH_COLUMNS, Target(None, "t").values(row)))
    assert values["valid_to"] == "infinity" and values["valid_from"] == OPEN_END  # only the declared column
    ddl = Target(None, "gold.dim_factors", POSTGRES).make_table("x")
    assert "valid_to DATE NOT NULL" in ddl and "ef_id VARCHAR(32) NOT NULL" in ddl and "gCO2e_per_unit DOUBLE PRECISION" in ddl


def test_empty_frame_empties_the_table(spark, target):
    refresh_table(gold(spark, 5), target)
    assert refresh_table(gold(spark, 0), target) == 0
    assert query(target, "SELECT count(*) FROM dim_factors") == [(0,)]


def test_a_failing_task_aborts_and_changes_nothing(spark, target):
    refresh_table(gold(spark, 50), target)
    bad = gold(spark, 90, "b").withColumn("source_year", F.when(F.col("id") == 77, F.raise_error(F.lit("bad row")).cast("int")).otherwise(1))
    with pytest.raises(Exception, match="bad row|aborted"):
        refresh_table(bad, target, "bad")
    assert query(target, "SELECT count(*), min(substr(ef_id, 1, 1)) FROM dim_factors") == [(50, "a")]
    assert tables(target) == {"dim_factors", LEDGER} and loaded(target, "bad") is None
    assert refresh_table(gold(spark, 90, "b"), target, "bad") == 90  # and the same run can be repeated


@pytest.mark.parametrize("at", ["DELETE FROM dim_factors", "INSERT INTO dim_factors ", f"INSERT INTO {LEDGER}", "DROP TABLE dim_factors__load"])
def test_a_failing_commit_rolls_back_at_every_step(spark, tmp_dir, target, at):
    refresh_table(gold(spark, 50), target)
    fault(tmp_dir, at)
    with pytest.raises(Exception):
        refresh_table(gold(spark, 90, "b"), target, "lost")
    os.remove(os.path.join(tmp_dir, "fault"))
    assert query(target, "SELECT count(*), min(substr(ef_id, 1, 1)) FROM dim_factors") == [(50, "a")]
    assert loaded(target, "lost") is None
    assert refresh_table(gold(spark, 90, "b"), target, "lost") == 90
    assert tables(target) == {"dim_factors", LEDGER}


def test_null_in_a_declared_column_fails_as_a_whole(spark, target):
    refresh_table(gold(spark, 50), target)
    with pytest.raises(Exception, match="NOT NULL|aborted"):
        refresh_table(gold(spark, 50, "b").withColumn("unit", F.when(F.col("id") != 3, F.lit("kg"))), target)
    assert query(target, "SELECT count(*), min(substr(ef_id, 1, 1)) FROM dim_factors") == [(50, "a")]


def test_types_are_checked_before_anything_is_written(spark, target):
    with pytest.raises(ValueError, match="source_year"):
        refresh_table(gold(spark, 5).withColumn("source_year", F.lit("2024")), target)
    with pytest.raises(Exception):
        refresh_table(gold(spark, 5).drop("unit"), target)
    assert not os.path.exists(target.connect.__closure__[1].cell_contents) or tables(target) <= {LEDGER}


def small(path_target, run):
    """A target of two columns with its staging table, and a writer to it."""
    w = StagedWriter(path_target, run)
    path_target.transaction(lambda cur: cur.execute(path_target.make_table(path_target.staging(run), "load_attempt TEXT")))
    loaded(path_target, run)
    return w


TWO = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])


def two(n, tag):
    return iter([Row(k=i, v=tag) for i in range(n)])


def test_rows_of_attempts_that_nobody_counts_are_not_swapped_in(tmp_dir):
    t = file_target(tmp_dir, schema=TWO, lengths={}, open_columns=(), batch=3)
    w = small(t, "r")
    w.write(two(10, "lost"))                       # its message never arrived
    first, second = w.write(two(10, "x")), w.write(two(0, "none"))
    w.commit([first, None, second])
    assert query(t, "SELECT v, count(*) FROM dim_factors GROUP BY 1") == [("x", 10)] and loaded(t, "r") == 10


def test_missing_staged_rows_are_an_error(tmp_dir):
    t = file_target(tmp_dir, schema=TWO, lengths={}, open_columns=())
    w = small(t, "r")
    m = w.write(two(10, "x"))
    query(t, "DELETE FROM dim_factors__load_r WHERE k = 4")
    with pytest.raises(RuntimeError, match="reported"):
        w.commit([m])
    w.abort([m])
    assert tables(t) == {LEDGER}


def test_interleaved_refreshes_end_with_one_of_them(tmp_dir):
    t = file_target(tmp_dir, schema=TWO, lengths={}, open_columns=())
    a, b = small(t, "a"), small(t, "b")
    ma, mb = [a.write(two(5, "a"))], [b.write(two(7, "b"))]
    mb.append(b.write(two(7, "b")))
    b.commit(mb)
    a.commit(ma)
    assert query(t, "SELECT v, count(*) FROM dim_factors GROUP BY 1") == [("a", 5)]
    assert (loaded(t, "a"), loaded(t, "b")) == (5, 14) and tables(t) == {"dim_factors", LEDGER}


def test_a_run_in_the_ledger_is_not_repeated(spark, target):
    assert refresh_table(gold(spark, 20), target, "once") == 20
    assert refresh_table(gold(spark, 99, "b"), target, "once") == 20
    assert query(target, "SELECT count(*) FROM dim_factors") == [(20,)]


def test_readers_never_see_an_empty_or_mixed_table(spark, target):
    refresh_table(gold(spark, 400, "a"), target)
    seen, stop = set(), threading.Event()

    def read():
        while not stop.is_set():
            seen.add(tuple(query(target, "SELECT substr(ef_id, 1, 1), count(*) FROM dim_factors GROUP BY 1")))
    reader = threading.Thread(target=read)
    reader.start()
    for tag, n in (("b", 300), ("c", 500)):
        refresh_table(gold(spark, n, tag), target)
    stop.set()
    reader.join()
    assert seen <= {(("a", 400),), (("b", 300),), (("c", 500),)} and len(seen) >= 2


def test_names_are_checked():
    with pytest.raises(ValueError):
        Target(None, "t; DROP TABLE x")
    with pytest.raises(ValueError):
        refresh_table(None, Target(None, "t"), "a b")
    assert serving.OPEN_END.year == 9999
