"""The version log, publishing and replacing years on top of it: crashes, races, readers."""

import datetime as dt
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from greenledger.contracts import GOLD_SCHEMA
from greenledger.sources import bronze, publish
from greenledger.sources.bronze import replace_years, scan_bronze
from greenledger.sources.publish import current_version, files_valid_on, publish_snapshot, read_snapshot, read_valid_on
from greenledger.sources.versions import LOG, commit, newest, versions
from tests.conftest import rows

CSV = "year string, v string"


def add(name):
    return lambda state: {"names": [*(state["names"] if state else []), name]}


def test_versions_are_numbered_and_the_newest_complete_one_wins(spark, tmp_dir):
    assert newest(spark, tmp_dir) is None and versions(spark, tmp_dir) == []
    assert commit(spark, tmp_dir, add("a"))["number"] == 1
    commit(spark, tmp_dir, add("b"))
    with open(f"{tmp_dir}/{LOG}/v000000003.json", "w") as f:
        f.write('{"names": ["a", "b", "half')  # a run died while its file was copied
    with open(f"{tmp_dir}/{LOG}/v000000004.json", "w"):
        pass
    assert newest(spark, tmp_dir)["names"] == ["a", "b"]
    state = commit(spark, tmp_dir, add("c"))
    assert (state["number"], newest(spark, tmp_dir)["names"]) == (5, ["a", "b", "c"])
    assert not [n for n in os.listdir(f"{tmp_dir}/{LOG}") if n.startswith(".") and not n.endswith(".crc")]


def test_a_change_is_applied_again_to_what_came_in_between(spark, tmp_dir):
    commit(spark, tmp_dir, add("a"))
    asked = []

    def slow(state):
        if not asked:
            commit(spark, tmp_dir, add("fast"))
        asked.append(state["names"])
        return add("slow")(state)
    assert commit(spark, tmp_dir, slow)["names"] == ["a", "fast", "slow"]
    assert asked == [["a"], ["a", "fast"]]


def gold(spark, days, tag="a"):
    """Editions of one factor: one a day, valid for ten days."""
    one = {"string": F.lit(tag), "int": F.lit(2024), "double": F.lit(1.0), "boolean": F.lit(True)}
    start = F.date_add(F.lit(dt.date(2020, 1, 1)), F.col("id").cast("int"))
    return spark.range(days).select(*[
        {"valid_from": start, "valid_to": F.date_add(start, 9), "ef_id": F.concat(F.lit(tag), F.col("id").cast("string"))}.get(
            f.name, one.get(f.dataType.simpleString())).alias(f.name) for f in GOLD_SCHEMA])


def test_a_day_is_read_from_few_files_with_pushed_ranges(spark, tmp_dir):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        publish_snapshot(gold(spark, 1200).orderBy(F.rand(1)), tmp_dir)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    day = dt.date(2021, 3, 3)
    held, total = files_valid_on(spark, tmp_dir, day)
    assert total >= 10 and 1 <= len(held) <= 2
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    df = read_valid_on(spark, tmp_dir, day)
    got = rows(df, "valid_from")
    assert got == sorted(((day - dt.timedelta(days=k),) for k in range(10)), key=str)
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "LessThanOrEqual(valid_from" in pushed and "GreaterThanOrEqual(valid_to" in pushed
    assert set(df.inputFiles()) == {f"file://{p}" for p in held}
    whole = read_snapshot(spark, tmp_dir)
    in_file = whole.select(F.col("_metadata.file_name").alias("f"), F.monotonically_increasing_id().alias("i"), "valid_from")
    for part in in_file.groupBy("f").agg(F.sort_array(F.collect_list(F.struct("i", "valid_from"))).alias("r")).collect():
        days = [r["valid_from"] for r in part["r"]]
        assert days == sorted(days)  # each file in order of validity
    for empty in (dt.date(1990, 1, 1), "2030-01-01"):
        none = read_valid_on(spark, tmp_dir, empty)
        assert none.count() == 0 and none.columns == whole.columns


def test_open_ends_are_found_after_any_time(spark, tmp_dir):
    open_end = gold(spark, 30).withColumn("valid_to", F.when(F.col("ef_id") == "a3", F.lit(dt.date(9999, 12, 31))).otherwise(F.col("valid_to")))
    publish_snapshot(open_end, tmp_dir)
    assert rows(read_valid_on(spark, tmp_dir, dt.date(2500, 1, 1)), "ef_id") == [("a3",)]


def data_folders(folder):
    return sorted(p for p in os.listdir(folder) if p.startswith(("version-", "files-")))


@pytest.mark.parametrize("step", ["write", "ranges", "commit"])
def test_a_publisher_that_dies_leaves_the_state_before(spark, tmp_dir, monkeypatch, step):
    publish_snapshot(gold(spark, 5), tmp_dir)
    before = current_version(spark, tmp_dir)
    bad = gold(spark, 7, "b")
    if step == "write":
        bad = bad.withColumn("unit", F.raise_error(F.lit("boom")).cast("string"))
    elif step == "commit":
        monkeypatch.setattr(publish, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    else:
        monkeypatch.setattr(F, "max", lambda c: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(Exception):
        publish_snapshot(bad, tmp_dir)
    monkeypatch.undo()
    assert current_version(spark, tmp_dir) == before and read_snapshot(spark, tmp_dir).count() == 5
    publish_snapshot(gold(spark, 7, "b"), tmp_dir)
    assert read_snapshot(spark, tmp_dir).count() == 7
    publish_snapshot(gold(spark, 8, "c"), tmp_dir, lease_s=0)  # and what the dead run left goes with its lease
    assert len(data_folders(tmp_dir)) == 4


def test_another_runs_unfinished_folder_stays(spark, tmp_dir):
    publish_snapshot(gold(spark, 5), tmp_dir)
    os.makedirs(f"{tmp_dir}/version-unfinished")
    for n in (6, 7, 8):
        publish_snapshot(gold(spark, n), tmp_dir)
    assert os.path.isdir(f"{tmp_dir}/version-unfinished") and len(data_folders(tmp_dir)) == 5


def test_interleaved_publishers_and_readers(spark, tmp_dir):
    publish_snapshot(gold(spark, 5), tmp_dir)
    failed, seen, stop = [], set(), threading.Event()

    def read():
        while not stop.is_set():
            if current_version(spark, tmp_dir) is None:
                failed.append("no version")
            time.sleep(0.01)

    def run(tag):
        try:
            for n in (10, 11):
                seen.add(publish_snapshot(gold(spark, n, tag), tmp_dir))
        except Exception as exc:  # noqa: BLE001
            failed.append(exc)
    threads = [threading.Thread(target=run, args=(t,)) for t in "bc"]
    reader = threading.Thread(target=read)
    for t in (reader, *threads):
        t.start()
    for t in threads:
        t.join()
    stop.set()
    reader.join()
    assert not failed and seen == {10, 11}
    last = read_snapshot(spark, tmp_dir)
    assert last.count() == 11 and last.select(F.substring("ef_id", 1, 1)).distinct().count() == 1
    assert [n for n, _ in versions(spark, tmp_dir)] == [5, 4, 3, 2, 1]


def years(spark, root):
    return rows(scan_bronze(spark, root, "s", ["v", "year"]), "year", "v")


def test_years_are_replaced_in_one_step(spark, tmp_dir, monkeypatch):
    df = lambda *r: spark.createDataFrame(list(r), CSV)
    replace_years(df(("2023", "a"), ("2024", "b")), tmp_dir, "s")
    assert years(spark, tmp_dir) == [(2023, "a"), (2024, "b")]
    held = scan_bronze(spark, tmp_dir, "s", ["v", "year"])
    # The rows are written and moved, but the run dies before the log is told.
    monkeypatch.setattr(bronze, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        replace_years(df(("2024", "x"), ("2025", "y")), tmp_dir, "s")
    monkeypatch.undo()
    assert years(spark, tmp_dir) == [(2023, "a"), (2024, "b")]
    # Or between two moves: one year's folder is there under its new name, the other isn't.
    plain, moves = bronze.file_system, []

    class Dying:
        def __init__(self, fs):
            self.fs = fs

        def rename(self, a, b):
            moves.append(a)
            return len(moves) < 2 and self.fs.rename(a, b)

        def __getattr__(self, name):
            return getattr(self.fs, name)
    monkeypatch.setattr(bronze, "file_system", lambda s, p: (Dying(plain(s, p)[0]), plain(s, p)[1]))
    with pytest.raises(OSError, match="cannot move"):
        replace_years(df(("2024", "x"), ("2025", "y")), tmp_dir, "s")
    monkeypatch.undo()
    assert years(spark, tmp_dir) == [(2023, "a"), (2024, "b")]
    replace_years(df(("2024", "c"), ("2025", "d")), tmp_dir, "s", lease_s=0)
    assert years(spark, tmp_dir) == [(2023, "a"), (2024, "c"), (2025, "d")]
    assert rows(held, "year", "v") == [(2023, "a"), (2024, "b")]  # a reader of the old state goes on
    runs = [r for y in os.listdir(f"{tmp_dir}/s") if y.startswith("year=") for r in os.listdir(f"{tmp_dir}/s/{y}")]
    assert len(runs) == 4  # 2024 twice; what the dead runs left is gone
    assert not [p for p in os.listdir(tmp_dir) if p.startswith("_staging")]


def test_two_runs_with_different_years_lose_nothing(spark, tmp_dir):
    replace_years(spark.createDataFrame([("2020", "0")], CSV), tmp_dir, "s")
    failed = []

    def run(y):
        try:
            replace_years(spark.createDataFrame([(str(y), str(y))], CSV), tmp_dir, "s")
        except Exception as exc:  # noqa: BLE001
            failed.append(exc)
    threads = [threading.Thread(target=run, args=(y,)) for y in range(2021, 2026)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    assert years(spark, tmp_dir) == [(2020, "0"), *[(y, str(y)) for y in range(2021, 2026)]]


def test_refused_rows_change_nothing(spark, tmp_dir):
    replace_years(spark.createDataFrame([("2020", "0")], CSV), tmp_dir, "s")

    def refuse():
        raise ValueError("no")
    with pytest.raises(ValueError):
        replace_years(spark.createDataFrame([("2020", "1")], CSV), tmp_dir, "s", accept=refuse)
    assert years(spark, tmp_dir) == [(2020, "0")]


def test_a_year_filter_reads_that_years_folder(spark, tmp_dir):
    replace_years(spark.createDataFrame([(str(2020 + i % 5), str(i)) for i in range(50)], CSV), tmp_dir, "s")
    plan = scan_bronze(spark, tmp_dir, "s", ["v", "year"]).where("year = 2022")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2022" in plan.split("PartitionFilters")[1]
