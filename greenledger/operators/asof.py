"""As-of lookups over intervals that may overlap and nest.

The newest interval that is valid on a row's day wins, once per row. Intervals of
one key are first turned into change points, the days from which another interval
(or none) is the newest valid one. Then change points and rows lie in one order
(key, day), and each row takes the last change point before it.

Nothing meets in one place by key, so a key may hold any share of either side:

* intervals are numbered in order and swept in blocks of ``BLOCK_ROWS``, with a stack
  of those that may come back when a newer one ends; a block starts
  with the stacks of the blocks before it;
* rows and change points are dealt by range, and the last change point of each
  partition is carried over its border (one row per partition).
"""

from __future__ import annotations

import datetime as _dt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greenledger.tables import free_name, numbered, shuffle_partitions, with_positions, written

#: Intervals that one task sweeps.
BLOCK_ROWS = 500_000
_DAY = _dt.timedelta(days=1)
_LAST = _dt.date.max


def sweep(rows, stack: list[tuple], emit=None) -> list[tuple]:
    """Sweep the intervals (start, end, pos) of one key in their order; returns the
    stack, oldest and longest first, that goes on to the key's next block.

    A newer interval hides an older one; where it ends first, the older one comes
    back. ``emit(day, pos)``: from ``day`` on, ``pos`` (None: nothing) is valid.
    """
    stack = list(stack)
    for start, end, pos in rows:
        expire(stack, start, emit)
        while stack and stack[-1][0] <= end:  # over before the newer one: never back
            stack.pop()
        stack.append((end, pos))
        if emit:
            emit(start, pos)
    return stack


def expire(stack: list[tuple], upto, emit) -> None:
    """Take off what ends before ``upto`` (None: everything), and say what is valid then."""
    while stack and (upto is None or stack[-1][0] < upto):
        end, _ = stack.pop()
        if emit and end < _LAST and (upto is None or end + _DAY < upto):
            emit(end + _DAY, stack[-1][1] if stack else None)


def _runs(pdf: pd.DataFrame, keys: list[str]):
    """[(start, end, pos)] of each run of equal keys, in order."""
    pdf = pdf.sort_values("pos", ignore_index=True)
    new = np.zeros(len(pdf), bool)
    new[:1] = True
    for k in keys:
        values = pdf[k].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    cuts = [*new.nonzero()[0], len(pdf)]
    for lo, hi in zip(cuts, cuts[1:]):
        yield list(zip(pdf["start"][lo:hi], pdf["end"][lo:hi], pdf["pos"][lo:hi]))


def _border(keys: list[str]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """The block's first and last run: where it ends, and what is on the stack there."""
        runs = list(_runs(pdf, keys))
        first, last = runs[0], runs[-1]
        stack = sweep(last, [])
        n = len(stack)
        return pd.DataFrame({"block": [pdf["block"].iloc[0]] * n, "runs": [len(runs)] * n, "first": [first[0][2]] * n,
                             "last": [last[-1][2]] * n, "end": [e for e, _ in stack], "pos": [p for _, p in stack]})
    return run


def _points(keys: list[str], before: dict[int, list], open_after: set[int]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        block, days, order, winners = int(pdf["block"].iloc[0]), [], [], []
        runs = list(_runs(pdf, keys))
        for i, rows in enumerate(runs):
            at = rows[0][2]

            def emit(day, pos):
                if days and days[-1] == day and order[-1][0] == i:  # a newer one from the same day on
                    days.pop(), order.pop(), winners.pop()
                days.append(day)
                order.append((i, at))
                winners.append(pos)
            stack = sweep(rows, before.get(block, []) if i == 0 else [], emit)
            if i < len(runs) - 1 or block not in open_after:
                expire(stack, None, emit)
        return pd.DataFrame({"like": [a for _, a in order], "day": days, "winner": pd.array(winners, dtype="Int64")})
    return run


def change_points(intervals: DataFrame, keys: list[str], start: str, end: str, take: list[str],
                  prefer: list[Column] | None = None) -> DataFrame:
    """(k0, k1, ... for ``keys``; day, winner, value): from ``day`` on the key's newest
    valid interval has the columns ``value``, a struct of ``found`` and
    ``take`` (false and nulls where no interval is valid).

    Newest is the latest ``start``, then the latest ``end``, then the last by
    ``prefer`` (by ``take`` if not given). Intervals are days, closed at both ends;
    those with a null key, start or end, or that end before they start, are
    never valid. Repeated intervals count once. The driver holds, per block
    of intervals, those that nest at its end.
    """
    names = [f"k{i}" for i in range(len(keys))]
    prefer = prefer if prefer is not None else [F.col(c) for c in take]
    ties = [f"p{i}" for i in range(len(prefer))]
    rows = intervals.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(start).cast("date").alias("start"),
                            F.col(end).cast("date").alias("end"), *[c.alias(t) for c, t in zip(prefer, ties)],
                            F.struct(F.lit(True).alias("found"), *take).alias("value"))
    sound = F.col("start") <= F.col("end")
    for k in names:
        sound = sound & F.col(k).isNotNull()
    placed = with_positions(rows.filter(sound).distinct(), [*names, "start", "end", *ties, "value"], "intervals")
    placed = written(placed.withColumn("block", F.expr(f"pos div {BLOCK_ROWS}")), "placed")
    blocks = placed.select(*names, "start", "end", "pos", "block").groupBy("block")
    before, open_after = _carried(placed, names, blocks.applyInPandas(
        _border(names), "block long, runs int, first long, last long, end date, pos long").collect())
    points = blocks.applyInPandas(_points(names, before, open_after), "like long, day date, winner long")
    at = placed.select(F.col("pos").alias("like"), *names)
    values = placed.select(F.col("pos").alias("winner"), "value")
    gap = F.struct(F.lit(False).alias("found"), *[F.lit(None).cast(intervals.schema[c].dataType).alias(c) for c in take])
    return points.join(at, "like").join(values, "winner", "left").select(
        *names, "day", F.coalesce("winner", F.lit(-1)).alias("winner"), F.coalesce("value", gap).alias("value"))


def _carried(placed: DataFrame, names: list[str], found: list) -> tuple[dict[int, list], set[int]]:
    """({block: stack that its first run starts with}, blocks whose last key goes on)."""
    borders: dict[int, list] = {}
    for r in sorted(found, key=lambda r: (r["block"], r["pos"])):
        borders.setdefault(r["block"], []).append(r)
    ends = sorted({p for rs in borders.values() for p in (rs[0]["first"], rs[0]["last"])})
    key_at = {r["pos"]: tuple(r[k] for k in names)
              for r in placed.filter(F.col("pos").isin(ends)).select("pos", *names).collect()}
    before, open_after, stack, previous = {}, set(), [], None
    for block in sorted(borders):
        rs = borders[block]
        if previous is not None and key_at[rs[0]["first"]] == key_at[borders[previous][0]["last"]]:
            open_after.add(previous)
            before[block] = stack
        else:
            stack = []
        # A block of one run: what lay on the stack stays under it, unless it is over first.
        longest = max(r["end"] for r in rs)
        under = [s for s in stack if s[0] > longest] if rs[0]["runs"] == 1 else []
        stack = under + [(r["end"], r["pos"]) for r in rs]
        previous = block
    return before, open_after


def last_before(rows: DataFrame, points: DataFrame, row_keys: list[Column], day: Column, out: str) -> DataFrame:
    """``rows`` with ``out``: the value of the last change point of the row's key up to
    its day; null where there is none, and for a null key or day."""
    n = shuffle_partitions(rows.sparkSession)
    names = [f"k{i}" for i in range(len(row_keys))]
    whole = F.struct(*rows.columns)
    there = day.isNotNull()
    for k in row_keys:
        there = there & k.isNotNull()
    kind = points.schema["value"].dataType
    mine = rows.filter(there).select(*[c.alias(k) for c, k in zip(row_keys, names)], day.cast("date").alias("day"), F.lit(1).alias("kind"),
                                     F.lit(None).cast("long").alias("winner"), F.lit(None).cast(kind).alias("value"), whole.alias("row"))
    marks = points.select(*names, "day", F.lit(0).alias("kind"), "winner", "value",
                          F.lit(None).cast(mine.schema["row"].dataType).alias("row"))
    both = marks.union(mine).withColumn("salt", F.xxhash64("row"))
    # Rows of one key and day are told apart by their content: a hot day is split, and a repeated task deals alike.
    order = [*names, "day", "kind", "winner", "salt"]
    dealt = written(both.repartitionByRange(n, *order).withColumn("pid", F.spark_partition_id()), "asof")
    tail = dealt.groupBy("pid").agg(F.max_by(
        F.when(F.col("kind") == 0, F.struct(*names, "value")), F.when(F.col("kind") == 0, F.struct(*order[:-1]))).alias("tail"))
    # One row per partition, n at most: sorted in one place, and broadcast.
    carried = tail.select("pid", F.last("tail", ignorenulls=True).over(
        Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)).alias("tail"))
    upto = Window.partitionBy("pid", *names).orderBy("day", "kind", "winner").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = dealt.withColumn("seen", F.last("value", ignorenulls=True).over(upto)).filter("kind = 1")
    same = F.lit(True)
    for k in names:
        same = same & (F.col(k) == F.col(f"tail.{k}"))
    joined = inside.join(F.broadcast(carried), "pid").select(
        "row.*", F.coalesce("seen", F.when(same, F.col("tail.value"))).alias(out))
    return joined.unionByName(rows.filter(~F.coalesce(there, F.lit(False))).withColumn(out, F.lit(None).cast(kind)))


def asof_join(activity: DataFrame, factors: DataFrame, keys: list[str], date_col: str, take: list[str],
              prefer: list[Column] | None = None, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """LEFT as-of join: every row of ``activity`` once, with the columns ``take`` of
    the newest interval of ``factors`` that has its ``keys`` and holds its day.

    ``prefer``: see :func:`change_points`. Rows without a valid interval, or with a null
    key or day, get nulls. A column of ``activity`` named like one of ``take``
    is an error.
    """
    _no_clash(activity, take)
    points = written(change_points(factors, keys, valid_from, valid_to, take, prefer), "points")
    out = free_name(activity.columns, "value")
    found = last_before(activity, points, [F.col(k) for k in keys], F.col(date_col), out)
    return found.select(*activity.columns, *[F.col(f"{out}.{c}").alias(c) for c in take])


def _no_clash(activity: DataFrame, added: list[str]) -> None:
    clash = {c.lower() for c in activity.columns} & {c.lower() for c in added}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")


def asof_fallback(activity: DataFrame, factors: DataFrame, levels: list[tuple], keys: list[str], date_col: str,
                  take: list[str], place_col: str = "country_code", out_level: str = "geo_level",
                  prefer: list[Column] | None = None, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """The most specific place that has a factor for the row's ``keys`` on its day.

    ``levels``, most specific first: ``(activity column, level name)`` for a place
    in each row, or ``(None, level name, place)`` for one that all rows share.
    Each level is an as-of lookup of the rows that the levels before left open;
    where none has a valid factor, ``take`` and ``out_level`` are null. The
    factors' change points are computed once for all levels.
    """
    _no_clash(activity, [*take, out_level])
    points = written(change_points(factors, [place_col, *keys], valid_from, valid_to, take, prefer), "points")
    out = free_name(activity.columns, "value")
    open_rows, done = activity, None
    for i, level in enumerate(levels):
        place = F.col(level[0]) if level[0] is not None else F.lit(level[2])
        found = written(last_before(open_rows, points, [place, *[F.col(k) for k in keys]], F.col(date_col), out), f"level-{i}")
        hit = F.coalesce(F.col(f"{out}.found"), F.lit(False))
        settled = (found if i == len(levels) - 1 else found.filter(hit)).select(
            *activity.columns, *[F.col(f"{out}.{c}").alias(c) for c in take], F.when(hit, F.lit(level[1])).alias(out_level))
        done = settled if done is None else done.unionByName(settled)
        open_rows = found.filter(~hit).select(*activity.columns)
    return done
