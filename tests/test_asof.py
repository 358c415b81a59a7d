"""As-of joins over overlapping and nested intervals, against a plain search."""

import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from greenledger.operators import asof
from greenledger.operators.asof import asof_fallback, asof_join, expire, sweep

DAY0 = dt.date(2020, 1, 1)
FOREVER = dt.date(9999, 12, 31)


def day(n):
    return None if n is None else FOREVER if n >= 1000 else DAY0 + dt.timedelta(days=n)


def newest(factors, key, d):
    """(value) of the newest valid interval by plain search."""
    if d is None or any(k is None for k in key):
        return None
    ok = [(f[1], f[2], f[3]) for f in factors if f[0] == key and f[1] is not None and f[2] is not None and f[1] <= d <= f[2]]
    return max(ok)[2] if ok else None


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 40)), max_size=14), st.integers(1, 14))
def test_sweep_in_blocks_equals_search(spans, cut):
    rows = sorted({(a, a + n) for a, n in spans})
    rows = [(day(a), day(b), i) for i, (a, b) in enumerate(rows)]
    points, stack = [], []

    def emit(d, pos):
        points.append((d, pos))
    for lo in range(0, len(rows), cut):
        stack = sweep(rows[lo:lo + cut], stack, emit)
    expire(stack, None, emit)
    assert [d for d, _ in points] == sorted(d for d, _ in points)
    for n in range(-2, 75):
        want = [p for a, b, p in rows if a <= day(n) <= b]
        got = [p for d, p in points if d <= day(n)]
        assert (max(want) if want else None) == (got[-1] if got else None)


FACTORS = "name string, unit string, valid_from date, valid_to date, ef_id string, grams double"
ACTIVITY = "row long, name string, unit string, d date, value string, k0 int, day string"


def made(seed, n_factors, n_rows, hot=0.5):
    rng = random.Random(seed)
    pick = lambda: ("hot", "kg") if rng.random() < hot else (rng.choice("abc"), rng.choice(["kg", "m"]))
    factors = []
    for i in range(n_factors):
        a = rng.randint(0, 200)
        factors.append((*pick(), day(a), day(a + rng.choice([0, 1, 5, 30, 90, 2000])), f"ef{i:04d}", i / 2))
    factors += [factors[0], ("hot", None, day(1), day(9), "null-key", 1.0), ("hot", "kg", None, day(9), "no-start", 1.0),
                ("hot", "kg", day(9), day(3), "backwards", 1.0), ("hot", "kg", day(300), day(300), "one-day", 1.0)]
    rows = [(i, *pick(), day(rng.randint(-5, 310)), "v", 1, "x") for i in range(n_rows)]
    rows += [(-1, None, "kg", day(3), None, None, None), (-2, "hot", "kg", None, None, None, None), rows[0], (-3, "zz", "kg", day(3), "", 1, "")]
    return factors, rows


@pytest.mark.parametrize("block,n_factors", [(500_000, 120), (7, 120), (1, 25), (7, 0)])
def test_join_equals_search(spark, monkeypatch, block, n_factors):
    monkeypatch.setattr(asof, "BLOCK_ROWS", block)
    factors, rows = made(block, n_factors or 1, 400)
    factors = factors if n_factors else []
    got = asof_join(spark.createDataFrame(rows, ACTIVITY).repartition(5), spark.createDataFrame(factors, FACTORS).repartition(3),
                    ["name", "unit"], "d", ["ef_id", "grams"])
    assert got.columns == ["row", "name", "unit", "d", "value", "k0", "day", "ef_id", "grams"]
    plain = [((n, u), a, b, (e, g)) for n, u, a, b, e, g in factors]
    want = [(*r, *(newest(plain, r[1:3], r[3]) or (None, None))) for r in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_empty_activity_and_clashing_columns(spark):
    factors, rows = made(1, 5, 5)
    f, a = spark.createDataFrame(factors, FACTORS), spark.createDataFrame(rows, ACTIVITY)
    assert asof_join(a.limit(0), f, ["name", "unit"], "d", ["ef_id"]).collect() == []
    with pytest.raises(ValueError, match="both sides"):
        asof_join(a.withColumnRenamed("value", "EF_ID"), f, ["name", "unit"], "d", ["ef_id"])


def test_a_hot_key_is_dealt_to_many_partitions(spark):
    """All rows have one key: no partition of the dealt order holds most of them."""
    rows = spark.range(4000).selectExpr("id AS row", "'hot' AS name", "date_add(DATE '2020-01-01', CAST(id % 300 AS INT)) AS d")
    factors = spark.range(300).selectExpr("'hot' AS name", "date_add(DATE '2020-01-01', CAST(id AS INT)) AS valid_from",
                                          "date_add(DATE '2020-01-01', CAST(id + 40 * (id % 5) AS INT)) AS valid_to", "id AS ef")
    seen = []
    kept = asof.written

    def spy(df, label):
        out = kept(df, label)
        if label == "asof":
            seen.extend(r["count"] for r in out.groupBy("pid").count().collect())
        return out
    asof.written = spy
    try:
        got = asof_join(rows, factors, ["name"], "d", ["ef"]).selectExpr("count(*) n", "count(DISTINCT row) u", "count(ef) f").first()
    finally:
        asof.written = kept
    assert tuple(got) == (4000, 4000, 4000) and len(seen) == 4 and max(seen) < 0.5 * sum(seen)


def test_fallback_by_place_key_and_day(spark):
    rng = random.Random(8)
    place = {"n": ["NO", "SE", "FR"], "r": ["NORTH", "SOUTH"]}
    factors = []
    for i in range(60):
        a = rng.randint(0, 100)
        where = rng.choice([*place["n"], *place["n"], *place["r"], "GLOBAL"])
        factors.append((rng.choice("ab"), where, day(a), day(a + rng.choice([3, 20, 2000 if where == "NO" else 30])), f"e{i:03d}", None if i % 9 == 0 else i / 4))
    rows = [(i, rng.choice("ab"), rng.choice([*place["n"], None, "DK"]), day(rng.randint(0, 140)), rng.choice([*place["r"], None]), 1, "") for i in range(300)]
    f = spark.createDataFrame(factors, FACTORS.replace("unit", "country_code"))
    a = spark.createDataFrame(rows, "row long, name string, nation string, d date, region string, k0 int, day string")
    got = asof_fallback(a, f, [("nation", "nation"), ("region", "region"), (None, "global", "GLOBAL")], ["name"], "d", ["ef_id", "grams"])
    plain = [((n, c), s, e, (i, g)) for n, c, s, e, i, g in factors]

    def want(r):
        for where, level in ((r[2], "nation"), (r[4], "region"), ("GLOBAL", "global")):
            hit = newest([(k, s, e, v[0]) for k, s, e, v in plain], (r[1], where), r[3])
            if hit:
                return (*r, *next(v for *_, v in plain if v[0] == hit), level)
        return (*r, None, None, None)
    expected = [want(r) for r in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
    assert {r[-1] for r in expected} == {"nation", "region", "global", None}
