"""Incremental maintenance of the dimension equals flagging all rows together."""

import datetime as dt
import os
import random

import pytest

from greenledger.operators.dimension import flag_current
from greenledger.sources import dimension_store
from greenledger.sources.dimension_store import merge_editions, merge_into, read_dimension
from greenledger.sources.versions import newest

SCHEMA = "id string, source string, factor_name string, unit string, source_year int, valid_from date, valid_to date, v int"


def made(seed, n=120):
    """Rows of some sources and years; one group holds a third, keys may be null, dates may tie."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        year = rng.randint(2018, 2024)
        name = "hot" if rng.random() < 0.33 else rng.choice(["a", "b", "c", "d", None])
        start = None if rng.random() < 0.05 else dt.date(year, 1, 1)
        out.append((f"id{i:04d}", rng.choice(["defra", "nve"]), name, rng.choice(["kg", "m"]), year, start, dt.date(year, 12, 31), i))
    return out + [out[0]]


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def same(df, rows, spark):
    """Equal rows up to which of two equal ones is current."""
    return bag(df) == bag(flag_current(spark.createDataFrame(rows, SCHEMA)))


@pytest.mark.parametrize("seed", range(3))
def test_any_split_equals_a_full_rebuild(spark, tmp_dir, seed):
    rows = made(seed)
    random.Random(seed).shuffle(rows)
    cuts = sorted(random.Random(seed + 9).sample(range(1, len(rows)), 2))
    parts = [rows[:cuts[0]], rows[cuts[0]:cuts[1]], rows[cuts[1]:]]
    for part in parts:
        merge_into(spark.createDataFrame(part, SCHEMA).repartition(3), tmp_dir, edition=None, n_buckets=8)
    assert same(read_dimension(spark, tmp_dir), rows, spark)


def test_a_year_that_comes_again_replaces_its_rows(spark, tmp_dir):
    rows = made(5)
    merge_into(spark.createDataFrame(rows, SCHEMA), tmp_dir, n_buckets=8)
    again = [("new1", "nve", "hot", "kg", 2024, dt.date(2024, 1, 1), dt.date(2024, 12, 31), -1),
             ("new2", "nve", "fresh", "kg", 2024, dt.date(2024, 1, 1), dt.date(2024, 12, 31), -2)]
    merge_into(spark.createDataFrame(again, SCHEMA), tmp_dir)
    left = [r for r in rows if (r[1], r[4]) != ("nve", 2024)] + again
    assert len(left) < len(rows) and same(read_dimension(spark, tmp_dir), left, spark)
    last = [("z", "defra", "only", "m", 2030, dt.date(2030, 1, 1), dt.date(2030, 12, 31), 0)]
    merge_into(spark.createDataFrame(last, SCHEMA), tmp_dir)
    merge_into(spark.createDataFrame([(*last[0][:2], "other", *last[0][3:])], SCHEMA), tmp_dir)  # the group "only" is gone
    assert same(read_dimension(spark, tmp_dir), [*left, (*last[0][:2], "other", *last[0][3:])], spark)


def test_only_touched_groups_are_flagged_and_only_their_buckets_written(spark, tmp_dir, monkeypatch):
    rows = made(7)
    merge_into(spark.createDataFrame(rows, SCHEMA), tmp_dir, edition=None, n_buckets=32)
    before = newest(spark, tmp_dir)["buckets"]
    seen = []
    plain = dimension_store.flag_current

    def spy(df, *a):
        seen.extend(r["factor_name"] for r in df.select("factor_name").distinct().collect())
        return plain(df, *a)
    monkeypatch.setattr(dimension_store, "flag_current", spy)
    one = [("n1", "nve", "a", "kg", 2025, dt.date(2025, 1, 1), dt.date(2025, 12, 31), 0)]
    touched = merge_into(spark.createDataFrame(one, SCHEMA), tmp_dir, edition=None)
    after = newest(spark, tmp_dir)["buckets"]
    assert len(touched) == 1 and seen == ["a"]
    assert {b for b in after if after[b] != before.get(b)} == {str(touched[0])}
    assert same(read_dimension(spark, tmp_dir), rows + one, spark)


def test_a_run_that_dies_changes_nothing_and_a_faster_one_is_merged(spark, tmp_dir, monkeypatch):
    rows = made(8)
    merge_into(spark.createDataFrame(rows, SCHEMA), tmp_dir, edition=None, n_buckets=4)
    first = bag(read_dimension(spark, tmp_dir))
    one = [("n1", "nve", "hot", "kg", 2025, dt.date(2025, 1, 1), dt.date(2025, 12, 31), 0)]
    two = [("n2", "nve", "hot", "kg", 2026, dt.date(2026, 1, 1), dt.date(2026, 12, 31), 0)]
    monkeypatch.setattr(dimension_store, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        merge_into(spark.createDataFrame(one, SCHEMA), tmp_dir, edition=None)
    monkeypatch.undo()
    assert bag(read_dimension(spark, tmp_dir)) == first
    plain, asked = dimension_store.merge_editions, []

    def slow(*a):
        out = plain(*a)
        if not asked:
            asked.append(1)
            merge_into(spark.createDataFrame(two, SCHEMA), tmp_dir, edition=None)  # another run comes in between
        return out
    monkeypatch.setattr(dimension_store, "merge_editions", slow)
    merge_into(spark.createDataFrame(one, SCHEMA), tmp_dir, edition=None, lease_s=0)
    assert same(read_dimension(spark, tmp_dir), rows + one + two, spark)
    assert not [p for p in os.listdir(tmp_dir) if p.startswith("_staging")]


def test_empty_arrivals_and_empty_dimension(spark, tmp_dir):
    none = spark.createDataFrame([], SCHEMA)
    assert read_dimension(spark, tmp_dir) is None
    assert merge_into(none, tmp_dir) == [] and read_dimension(spark, tmp_dir).count() == 0
    rows = made(1, 10)
    merge_into(spark.createDataFrame(rows, SCHEMA), tmp_dir)
    assert merge_into(none, tmp_dir) == []
    assert same(read_dimension(spark, tmp_dir), rows, spark)
    assert merge_editions(read_dimension(spark, tmp_dir), none).count() == len(rows)
