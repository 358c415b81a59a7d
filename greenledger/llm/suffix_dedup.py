"""Removal of long repeated byte strings by distributed ranking of suffix positions.

A byte goes if it lies in a ``length``-byte string (a window) that also starts
at any other place of the corpus. Suffix positions are ranked by strings that
grow around them: each round, Spark sorts pairs (rank so far, key of the longer
string), positions that are unique drop out, and the others get a new rank and
go on to the next length, until they are unique or the whole window is matched.

Ranking every byte position would move some 24 bytes per byte of text and
round. Instead each window is ranked through one position that its content
alone picks: the place inside it whose ``SEED`` bytes hash lowest (the last of
equal ones). Equal windows pick the same place, so nothing is missed, and a
text has one such position in about ``length`` / 2 bytes.

Round 0 ranks the seeds of all positions. A position with a seed that occurs
twice goes on with the windows it stands for, in cells of neighbouring windows.
Cells lie on a grid relative to the position, the same for equal windows:

* the bytes common to all windows of a cell are unique: no window is repeated;
* all bytes of the cell's windows occur twice, cut off alike by the text's
  ends: every window is repeated;
* else the cell is split, and the next round ranks its parts, down to single
  windows.

Splits happen only where a repeat begins or ends. The common bytes of a cell
grow from round to round: 32, 273, 385, 400 for the default sizes. Keys are
64-bit hashes of byte ranges, compared within one rank only. Rows of a round are narrow; texts are written once, bucketed by
row, and read again in each round without moving.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenledger.llm.common import bucketed, free_name, numbered, written
from greenledger.llm.rolling import Ranges, mix

LENGTH = 400
SEED = 32
#: Windows per cell, round by round.
CELLS = (128, 16, 1)
LOW = np.uint64(0xFFFFFFFF)


def positions(data: np.ndarray, length: int = LENGTH, seed: int = SEED):
    """(position, first window, last window, seed hash) arrays of one text: the
    windows start at first..last, all of them pick that position."""
    n = len(data)
    if n < length:
        return None
    ranges = Ranges(data)
    m = n - seed + 1
    hashes = mix((ranges.sums[seed:] - ranges.sums[:-seed]) * ranges.down[:m])
    order = (hashes & ~LOW) | (LOW - np.arange(m, dtype=np.uint64))
    span = length - seed + 1
    # Minimum of each window: of the tail of its block and the head of the next.
    padded = np.full(-(-m // span) * span, np.iinfo(np.uint64).max, np.uint64)
    padded[:m] = order
    grid = padded.reshape(-1, span)
    head = np.minimum.accumulate(grid, 1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    low = np.minimum(tail[:n - length + 1], head[span - 1:n - length + span])
    picked = (LOW - (low & LOW)).astype(np.int64)
    cut = np.flatnonzero(picked[1:] != picked[:-1]) + 1
    first = np.concatenate([[0], cut])
    last = np.concatenate([cut - 1, [n - length]])
    at = picked[first]
    return at, first, last, hashes[at].view(np.int64)


def _batch(columns: dict[str, list[np.ndarray]], kinds: dict):
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([*v, np.empty(0, np.int64)]), kinds.get(k, pa.int64())) for k, v in columns.items()],
        list(columns))


def _seed_rows(length: int):
    names = ["row", "at", "first", "last", "seed"]

    def run(batches):
        for batch in batches:
            out = {k: [] for k in names}
            for row, data in zip(batch.column("row").to_pylist(), batch.column("data").to_pylist()):
                found = positions(np.frombuffer(data, np.uint8), length)
                if found:
                    for k, v in zip(names, (np.full(len(found[0]), row), *found)):
                        out[k].append(v)
            yield _batch(out, {})
    return run


def cell_keys(data: np.ndarray, at, cell, size: int, length: int):
    """Keys (of the common bytes, of all bytes) of cells: the windows that start
    cell * size .. cell * size + size - 1 bytes before ``at``."""
    lo, hi = at - cell * size - size + 1, at - cell * size
    start, end = np.maximum(lo, 0), np.minimum(hi + length, len(data))
    # What the text's ends cut off. The cell's place on the grid is part of a key:
    # cells of two positions may hold the same windows, which are no repeat.
    place = cell.astype(np.uint64)
    off = ((start - lo) << 40 | (hi + length - end) << 20).astype(np.uint64) | place
    ranges = Ranges(data)
    return (mix(ranges.hash(hi, lo + length) + place).view(np.int64),
            mix(ranges.hash(start, end) + off).view(np.int64))


def _cell_rows(size: int, length: int):
    names = ["row", "at", "first", "last", "cell", "rank", "common", "whole"]

    def run(batches):
        for batch in batches:
            out = {k: [] for k in names}
            columns = [batch.column(k).to_pylist() for k in ("row", "data")]
            lists = batch.column("cells")
            for k, (row, data) in enumerate(zip(*columns)):
                # As flat arrays, not as one object for each cell.
                cells = lists[k].values
                at, first, last, cell, rank = (cells.field(f).to_numpy(zero_copy_only=False)
                                               for f in ("at", "first", "last", "cell", "rank"))
                keys = cell_keys(np.frombuffer(data, np.uint8), at, cell, size, length)
                for name, v in zip(names, (np.full(len(at), row), at, first, last, cell, rank, *keys)):
                    out[name].append(v)
            yield _batch(out, {})
    return run


def _split(df: DataFrame, size: int) -> DataFrame:
    """Rows of cells of ``size`` windows that hold some window first..last."""
    return df.withColumn("cell", F.explode(F.sequence(
        F.expr(f"greatest(at - last, _least) div {size}"), F.expr(f"least(at - first, _most) div {size}"))))


def repeated_windows(base: DataFrame, row: str, length: int = LENGTH) -> DataFrame:
    """(row, first, last): runs of window starts that are repeated, of ``base`` (row, data)."""
    data = base.select(F.col(row).alias("row"), "data")
    seeds = written(data.mapInArrow(_seed_rows(length), "row long, at long, first long, last long, seed long"), "seeds")
    twice = written(seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("seed"), "twice")
    live = seeds.join(twice, "seed").select(
        "row", "at", "first", "last", F.col("seed").alias("rank"),
        F.lit(0).cast("long").alias("_least"), F.lit(length).cast("long").alias("_most"))
    done = None
    for size in CELLS:
        cells = _split(live, size).groupBy("row").agg(F.collect_list(F.struct("at", "first", "last", "cell", "rank")).alias("cells"))
        ranked = written(data.join(cells, "row").mapInArrow(
            _cell_rows(size, length), "row long, at long, first long, last long, cell long, rank long, common long, whole long"),
            "ranked")
        ranked = ranked.withColumn("_least", F.col("cell") * size).withColumn(
            "_most", F.col("_least") + size - 1).withColumn("me", F.xxhash64("row", "at"))
        full = written(ranked.groupBy("rank", "whole").agg(F.count(F.lit(1)).alias("n"), F.min("me").alias("witness"))
                       .filter("n > 1").select("rank", "whole", "witness"), "full")
        ranked = written(ranked.join(full, ["rank", "whole"], "left").select(
            "row", "at", "first", "last", "_least", "_most", "me", "rank", "common", F.col("witness").isNotNull().alias("settled"),
            (F.col("witness") == F.col("me")).alias("witness")), "judged")
        runs = ranked.filter("settled").select(
            "row", F.greatest("first", F.col("at") - F.col("_most")).alias("first"),
            F.least("last", F.col("at") - F.col("_least")).alias("last"))
        done = runs if done is None else done.union(runs)
        if size == CELLS[-1]:
            return done
        # Of settled cells with equal bytes one goes on, as a witness for open cells
        # with the same common bytes: a part of it may be their match.
        ranked = ranked.filter("NOT settled OR witness")
        core = written(ranked.groupBy("rank", "common").agg(
            F.count(F.lit(1)).alias("n"), F.min("settled").alias("all_settled"), F.min("me").alias("next"))
            .filter("n > 1 AND NOT all_settled").select("rank", "common", "next"), "core")
        live = ranked.join(core, ["rank", "common"]).select(
            "row", "at", "first", "last", F.col("next").alias("rank"), "_least", "_most")


def _remove(length: int):
    def run(batches):
        for batch in batches:
            removed, spans, kept, cuts = [], [], [], []
            lists = batch.column("runs")
            for k, data in enumerate(batch.column("data").to_pylist()):
                if not lists[k].is_valid:
                    removed.append(0), spans.append(0), kept.append(data), cuts.append([])
                    continue
                runs = lists[k].values
                first, last = (runs.field(f).to_numpy(zero_copy_only=False) for f in ("first", "last"))
                order = np.argsort(first, kind="stable")
                start, end = first[order], np.maximum.accumulate(last[order] + length)
                new = np.concatenate([[True], start[1:] > end[:-1]])
                at = np.flatnonzero(new)
                start, end = start[at], end[np.concatenate([at[1:] - 1, [len(end) - 1]])]
                edges = [0, *np.stack([start, end], 1).ravel().tolist(), len(data)]
                kept.append(b"".join([data[a:b] for a, b in zip(edges[::2], edges[1::2])]))
                removed.append(len(data) - len(kept[-1]))
                spans.append(len(start))
                cuts.append([{"start": s, "end": e} for s, e in zip(start.tolist(), end.tolist())])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(k) + r for k, r in zip(kept, removed)], pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary()), pa.array(cuts, kind)],
                ["id", "n_bytes", "n_removed", "n_spans", "kept", "spans"])
    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, ``n_bytes``, ``n_removed``, ``n_spans``
    (maximal removed runs), ``kept`` (remaining bytes), ``spans`` (start, end of each).

    Null and empty texts, and texts shorter than ``length`` bytes, lose nothing.
    Windows never cross texts. Repeated rows are repeats of each other, so both
    lose all. Null ids come through. Other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    row = free_name(["id", "data"], "row")
    base = bucketed(numbered(docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data")), row), row, "suffix")
    runs = written(repeated_windows(base, row, length), "runs").groupBy("row").agg(
        F.collect_list(F.struct("first", "last")).alias("runs")).withColumnRenamed("row", row)
    return base.join(runs, row, "left").select("id", "data", "runs").mapInArrow(
        _remove(length), f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, "
                         "spans array<struct<start: long, end: long>>").withColumnRenamed("id", id_col)
