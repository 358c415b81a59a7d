"""Sharding by minimax contiguous partition of ordered atomic groups.

Rows with equal texts form a group that no cut may part. Groups stand in the
order of their first ``doc_id``; contiguous runs of groups become shards. The
smallest capacity that ``shards`` contiguous shards need is found by binary
search with a greedy check, and the groups are cut within that capacity.

The running totals at the group ends (the places where a cut may fall) stay
distributed. The driver sees a summary of at most ``CELLS`` cells (first and
last cut place of each), checks capacities greedily with a lower and an upper
estimate of every cut, and asks Spark for finer cells only where the two
estimates differ, until the capacity is exact. Each refinement is one
aggregation; the summary does not grow with the data.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenledger.llm.common import free_name, with_positions, written

SHARDS = 16
CELLS = 16384


class Places:
    """Cut places known through cells (first, last, count), sorted and disjoint."""

    def __init__(self, cells: list[tuple[int, int, int]]):
        self.cells = sorted(cells)
        self.firsts = [c[0] for c in self.cells]
        self.known = sorted({p for c in self.cells for p in c[:2]})

    def cell(self, x: int) -> tuple[int, int, int] | None:
        k = bisect_right(self.firsts, x) - 1
        return self.cells[k] if k >= 0 else None

    def below(self, x: int, optimist: bool, at: int) -> int:
        """An estimate of the largest cut place up to ``x`` (``at`` if none):
        a place known to exist, or the most it could be."""
        c = self.cell(x)
        if c is None:
            return at
        if x >= c[1]:
            return max(at, c[1])
        return max(at, x if optimist and c[2] > 2 else c[0])

    def cuts(self, capacity: int, total: int, optimist: bool, at: int = 0) -> list[int] | None:
        """Greedy cuts from ``at`` to ``total``; None if a group does not fit."""
        out = []
        while at < total:
            to = self.below(at + capacity, optimist, at)
            if to <= at:
                return None
            out.append(to)
            at = to
        return out

    def fits(self, capacity: int, total: int, shards: int, optimist: bool, at: int = 0) -> bool:
        while at < total and shards > 0:
            to = self.below(at + capacity, optimist, at)
            if to <= at:
                return False
            at, shards = to, shards - 1
        return at >= total


def _smallest(lo: int, hi: int, ok) -> int:
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if ok(mid) else (mid + 1, hi)
    return lo


def _cells(ends: DataFrame, ranges: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """First, last and number of cut places in equal cells of the given ranges (lo, hi]."""
    each = max(1, CELLS // len(ranges))
    cell = F.lit(None).cast("string")
    for k, (lo, hi) in enumerate(ranges):
        width = -(-(hi - lo) // each)
        cell = F.when((F.col("end") > lo) & (F.col("end") <= hi), F.concat(
            F.lit(f"{k}:"), F.expr(f"(end - {lo + 1}) div {width}").cast("string"))).otherwise(cell)
    got = (ends.withColumn("cell", cell).filter("cell IS NOT NULL").groupBy("cell")
           .agg(F.min("end"), F.max("end"), F.count(F.lit(1))).collect())
    return [(r[1], r[2], r[3]) for r in got]


def minimax_cuts(ends: DataFrame, total: int, largest: int, shards: int) -> list[int]:
    """``shards`` - 1 cut places (running totals in ``ends.end``) so that the
    largest shard is as small as whole groups allow, and the others near equal."""
    if not total:
        return [0] * (shards - 1)
    places = Places(_cells(ends, [(0, total)]))
    least = max(largest, -(-total // shards))
    while True:
        sure = _smallest(least, total, lambda c: places.fits(c, total, shards, False))
        hope = _smallest(least, sure, lambda c: places.fits(c, total, shards, True))
        if sure == hope:
            break
        # Only where the true cuts may lie, between the estimates of both ends.
        low = places.cuts(hope, total, False) or []
        high = places.cuts(sure, total, True) or []
        ranges = []
        for j in range(min(shards - 1, len(high))):
            a, b = low[j] if j < len(low) else high[j], high[j]
            first, last = places.cell(min(a, b)), places.cell(max(a, b) + 1)
            ranges.append((first[0] - 1, max(last[1], b)))
        merged = []
        for lo, hi in sorted(ranges):
            if merged and lo <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
            else:
                merged.append((lo, hi))
        outside = [c for c in places.cells if not any(lo < c[0] and c[1] <= hi for lo, hi in merged)]
        places = Places(outside + _cells(ends, merged))
        least = hope
    # Within that capacity, each cut goes to the known place nearest to an equal
    # share of the rest, if the rest still fits behind it.
    cuts, at = [], 0
    for left in range(shards - 1, 0, -1):
        share = at + (total - at) / (left + 1)
        reach = bisect_right(places.known, at + sure)
        choice = places.known[bisect_right(places.known, at):reach]
        fit = _smallest(0, max(len(choice) - 1, 0), lambda k: places.fits(
            sure, total, left, False, choice[k])) if choice else 0
        at = min(choice[fit:], key=lambda p: abs(p - share)) if choice else at
        cuts.append(at)
    return cuts


def assign_shards(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, ``size`` (UTF-8 bytes + 1), ``text_crc32``,
    ``law`` ('bytes'), ``shard``, ``slot`` (gapless from 0 in the shard),
    ``grown_shard`` (null: cuts depend on all sizes, not on a key).

    Null and empty texts are one group of size-1 rows. Groups are ordered by
    their smallest id (null ids last), rows inside by id; repeated rows stay
    apart. Fewer groups than shards leave shards empty. Other columns are not
    read; the digest that names a group is SHA-256 of the text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    row = free_name([id_col], "row")
    rows = written(docs.select(
        F.col(id_col).alias("_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.sha2(text, 256).alias("_sha"),
        F.monotonically_increasing_id().alias(row)), "sizes")
    # Written, so that the join can split a hot group's rows over tasks.
    firsts = written(rows.groupBy("_sha").agg(F.min("_id").alias("_first")), "firsts")
    rows = rows.join(firsts, "_sha").select(
        F.col("_first").isNull().alias("_late"), "_first", "_sha",
        F.col("_id").isNull().alias("_no_id"), "_id", row, "size", "text_crc32")
    placed = written(with_positions(
        rows, ["_late", "_first", "_sha", "_no_id", "_id", row], "order",
        {"_total": "size"}), "placed")
    ends = written(placed.groupBy("_late", "_first", "_sha").agg(
        F.max("_total").alias("end"), F.sum("size").alias("bytes")).select("end", "bytes"), "ends")
    got = ends.agg(F.max("end"), F.max("bytes")).first()
    cuts = minimax_cuts(ends, got[0] or 0, got[1] or 0, shards)
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("_total") > cut).cast("int")
    placed = placed.withColumn("shard", shard)
    # One row per shard, so the broadcast is bounded by the shard count.
    starts = placed.groupBy("shard").agg(F.min("pos").alias("_start"))
    return placed.join(F.broadcast(starts), "shard").select(
        F.col("_id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("pos") - F.col("_start")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
