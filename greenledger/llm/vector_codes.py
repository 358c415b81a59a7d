"""Vector codes: one codebook per part of the vector, assigned with adaptive bounds.

Every part of a vector keeps its ``b`` closest codebook entries, the assigned one
first, with a lower bound on the distance to each of the others, ordered, and one
outer bound for all entries beyond them. When the entries move, each bound drops
by its entry's drift, the outer one by the largest drift. The distance
to the assigned entry is measured anew in integers. Then

* every bound above it: the assignment stays, nothing else is measured;
* some of the kept entries' bounds not above it: those entries are measured in
  integers, and the list is put in order again;
* the outer bound not above it: all entries are measured, and the list is made anew.

Bounds are rounded down and the distance up, so only integers decide, ties
included. ``b`` adapts: it shrinks to the rank that ``ENOUGH`` of the parts needed
in the round before; a dropped entry's bound joins the outer one.

The lists are columns of a written table beside the integer vectors, as 16-bit
floats; each round reads that table, writes the next one and then deletes it. Rows
never move; only sums per entry do.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenledger.llm.common import discard, fresh_path, written
from greenledger.llm.vectors import as_integers, integer_rows, squared, usable

#: Entries that a part keeps at first and at least; share of parts that a smaller list has to serve.
KEPT, LEAST, ENOUGH = 6, 2, 0.95
#: Rows that are compared together: bounds the memory of a task.
STEP = 8192
_UP, _DOWN, _MOST = 1 + 1e-9, 1 - 1e-9, 65504.0


def _half(x: np.ndarray) -> np.ndarray:
    """``x`` as 16-bit floats, never above it (infinity stays)."""
    x = np.where(np.isinf(x), x, np.clip(x, 0, _MOST))
    h = x.astype(np.float16)
    return np.where(h.astype(np.float64) > x, np.nextafter(h, np.float16(0)), h)


class Codebook:
    """Entries of one part position: ``entries`` (k, width) integers, ``drift`` (k,)
    how far each has moved since the lists were written."""

    def __init__(self, entries: np.ndarray, drift: np.ndarray | None = None):
        self.entries = entries
        self.drift = np.zeros(len(entries)) if drift is None else drift

    def measured(self, x: np.ndarray, b: int):
        """All entries measured: (near (n, b), low (n, b) where low[:, -1] is the
        outer bound, squared distance of the nearest)."""
        far = squared(x[:, None], self.entries[None])
        k = len(self.entries)
        order = np.argsort(far, axis=1, kind="stable")[:, :b + 1]
        dist = np.take_along_axis(far, order, 1)
        low = np.full((len(x), b), np.inf)
        low[:, :min(b, k - 1)] = np.sqrt(dist[:, 1:b + 1]) * _DOWN
        near = np.zeros((len(x), b), np.int64)  # lists longer than the codebook repeat entry 0 behind an infinite bound
        near[:, :min(b, k)] = order[:, :b]
        return near, low, dist[:, 0]

    def updated(self, x: np.ndarray, near: np.ndarray, low: np.ndarray, keep: int):
        """Lists of ``keep`` entries after the entries moved, from lists (near, low);
        also the distances, and the rank that each row needed (b: all entries)."""
        n, b = near.shape
        at = squared(x, self.entries[near[:, 0]])
        up = np.sqrt(at) * _UP
        low = low.copy()
        low[:, :-1] -= self.drift[near[:, 1:]]
        low[:, -1] -= self.drift.max()
        low = np.where(low > 0, low * _DOWN, 0)
        open_ = low <= up[:, None]
        beyond = open_[:, -1]
        need = np.zeros(n, np.int64)
        for j in range(b - 1):
            need[open_[:, j]] = j + 1
        need[beyond] = b
        dist = np.full((n, b), np.iinfo(np.int64).max)
        dist[:, 0] = at
        rows, places = np.nonzero(open_[:, :-1] & ~beyond[:, None])
        dist[rows, places + 1] = squared(x[rows], self.entries[near[rows, places + 1]])
        some = np.unique(rows)
        if len(some):
            d, e = dist[some], near[some]
            known = d < np.iinfo(np.int64).max
            bound = np.concatenate([np.zeros((len(some), 1)), low[some, :-1]], 1)
            bound = np.where(known, np.sqrt(np.where(known, d, 0)) * _DOWN, bound)
            best = np.lexsort((e, d), axis=1)[:, 0]
            key = bound.copy()
            key[np.arange(len(some)), best] = -1
            order = np.argsort(key, axis=1, kind="stable")
            near, dist = near.copy(), dist.copy()
            near[some] = np.take_along_axis(e, order, 1)
            dist[some, 0] = d[np.arange(len(some)), best]
            low[some, :-1] = np.take_along_axis(bound, order, 1)[:, 1:]
        out = dist[:, 0]
        if keep < b:
            low = np.concatenate([low[:, :keep - 1], low[:, keep - 1:].min(1, keepdims=True)], 1)
            near = near[:, :keep]
        if beyond.any():
            all_near, all_low, all_out = self.measured(x[beyond], keep)
            near, low = near.copy(), low.copy()
            near[beyond], low[beyond], out[beyond] = all_near, all_low, all_out
        return near, low, out, need


def _binary(x: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(x)], pa.binary())


def _unpacked(column: pa.Array, kind, shape) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, *shape)


def _step(books, dims: int, parts: int, scale: int, b: int, keep: int, lists: bool):
    """Batches of (id, label, vector[, near, low]) to (id, label, vector, near, low, error, needed)."""
    def run(batches):
        for batch in batches:
            if lists:
                ids, labels = batch.column(0), batch.column(1)
                x = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)
            else:
                kept, x = integer_rows(batch.column(2), dims, scale)
                ids, labels = (batch.column(i).filter(pa.array(kept)) for i in (0, 1))
            x = x.reshape(len(x), parts, -1)
            for lo in range(0, len(x), STEP):
                part = x[lo:lo + STEP]
                n = len(part)
                if lists:
                    old = _unpacked(batch.column(3).slice(lo, n), np.uint8, (parts, b)).astype(np.int64)
                    bounds = _unpacked(batch.column(4).slice(lo, n), np.float16, (parts, b)).astype(np.float64)
                near = np.zeros((n, parts, keep), np.uint8)
                low = np.zeros((n, parts, keep), np.float16)
                error, needed = np.zeros(n, np.int64), np.zeros((n, parts), np.uint8)
                for p, book in enumerate(books):
                    if lists:
                        a, l, d, needed[:, p] = book.updated(part[:, p], old[:, p], bounds[:, p], keep)
                    else:
                        a, l, d = book.measured(part[:, p], keep)
                    near[:, p], low[:, p] = a, _half(l)
                    error += d
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, n), labels.slice(lo, n),
                     pa.ListArray.from_arrays(np.arange(0, n * dims + 1, dims, dtype=np.int32), pa.array(part.ravel().astype(np.int32))),
                     _binary(near), _binary(low), pa.array(error, pa.int64()), _binary(needed)],
                    ["id", "label", "vector", "near", "low", "error", "needed"])
    return run


def _sums(k: int, dims: int, parts: int, b: int, old_b: int):
    """Batches of (vector, near, needed) to (part, entry, n, sums) per task; how many
    parts needed each rank comes as part -1."""
    def run(batches):
        width = dims // parts
        total, count = np.zeros((parts, k, width), np.int64), np.zeros((parts, k), np.int64)
        ranks = np.zeros(old_b + 1, np.int64)
        for batch in batches:
            n = batch.num_rows
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, parts, width)
            first = _unpacked(batch.column(1), np.uint8, (parts, b))[:, :, 0]
            ranks += np.bincount(_unpacked(batch.column(2), np.uint8, (parts,)).ravel(), minlength=old_b + 1)
            for p in range(parts):
                np.add.at(total[p], first[:, p], x[:, p])
                count[p] += np.bincount(first[:, p], minlength=k)
        part, entry = np.nonzero(count)
        m = len(ranks)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([part, np.full(m, -1)]), pa.int32()), pa.array(np.concatenate([entry, np.arange(m)]), pa.int32()),
             pa.array(np.concatenate([count[part, entry], ranks]), pa.int64()),
             pa.array([*total[part, entry], *np.zeros((m, width), np.int64)], pa.list_(pa.int64()))],
            ["part", "entry", "n", "sums"])
    return run


def encode_vectors(df: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256,
                   id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``id_col``, code, error, label_error and codebooks_sha256 of every usable vector.

    Components become floor(scale * x). The codebooks start as the parts of the
    ``entries`` (256 at most) smallest kept ids; equal ids are ordered by their
    components, null ids come last. After ``rounds`` rounds of assigning and moving
    entries to the floor of their parts' mean, all parts are assigned again.

    Left out are rows whose vector is null, empty or holds a null or non-finite
    component, and rows of another length than the kept vector with the smallest id,
    which must be a multiple of ``parts`` (else an error). Ids may be null or
    repeated; null labels form one group. Fewer kept vectors than ``entries`` give
    smaller codebooks. No kept vector gives an empty result. Other columns are
    ignored, whatever their names.
    """
    if not 0 < entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries: codes have one byte per part")
    spark = df.sparkSession
    rows = df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    kinds = [rows.schema[c].dataType.simpleString() for c in ("id", "label")]
    kept = rows.filter(usable("vector")).select("id", "vector")
    order = [F.asc_nulls_last("id"), F.col("vector")]
    first = kept.orderBy(*order).limit(1).collect()
    if not first:
        return spark.createDataFrame([], f"`{id_col}` {kinds[0]}, code string, error long, label_error long, codebooks_sha256 string")
    dims = len(first[0]["vector"])
    if dims % parts:
        raise ValueError(f"vectors of {dims} components can't be cut into {parts} equal parts")
    start = kept.filter(F.size("vector") == dims).orderBy(*order).limit(entries).collect()
    books = as_integers([r["vector"] for r in start], scale).reshape(-1, parts, dims // parts).swapaxes(0, 1)
    k = books.shape[1]
    drift = np.zeros((parts, k))
    b = keep = KEPT
    schema = (f"id {kinds[0]}, label {kinds[1]}, vector array<int>, near binary, low binary, error long, needed binary")
    state = path = None
    for turn in range(rounds + 1):
        step = _step([Codebook(c, d) for c, d in zip(books, drift)], dims, parts, scale, b, keep, state is not None)
        source = rows if state is None else state.select("id", "label", "vector", "near", "low")
        assigned = source.mapInArrow(step, schema)
        if turn == rounds:
            break
        last, path = path, fresh_path(spark, "codes")
        assigned.write.option("compression", "zstd").parquet(path)
        state = spark.read.schema(assigned.schema).parquet(path)
        if last:  # superseded by the table just written
            discard(spark, last)
        # parts * entries * width numbers and some ranks reach the driver, whatever the data.
        sums = state.select("vector", "near", "needed").mapInArrow(
            _sums(k, dims, parts, keep, b), "part int, entry int, n long, sums array<long>")
        new, ranks = books.copy(), np.zeros(b + 1, np.int64)
        for r in sums.select("part", "entry", "n", F.posexplode("sums").alias("place", "s")).groupBy(
                "part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect():
            if r["part"] < 0:
                ranks[r["entry"]] = r["n"]
            else:
                new[r["part"], r["entry"], r["place"]] = r["s"] // r["n"]
        drift = np.sqrt(squared(new, books)) * _UP
        books, b = new, keep
        if turn:  # the first round has no lists yet, hence no ranks
            served = np.cumsum(ranks[:-1]) >= ENOUGH * ranks.sum()
            keep = max(LEAST, min(keep, int(served.argmax()) + 1 if served.any() else keep))
    found = written(assigned.select(
        "id", "label", F.expr(f"array_join(transform(sequence(0, {parts - 1}), p -> lower(hex(substring(near, p * {keep} + 1, 1)))), '')")
        .alias("code"), "error"), "codes")
    if path:
        discard(spark, path)
    # One row per label; a label with many vectors is split by the join.
    sums = found.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, books.ravel())).encode()).hexdigest()
    return found.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
