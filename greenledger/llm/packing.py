"""Hierarchical multi-length packing into sequences of at most 1024 tokens.

A document is cut at every 1024 tokens; its full windows are sequences of their
own and its rest is one more piece. Pieces are routed to tiers by length (up to
128, 256, 512, 1024 tokens). Each tier is packed into windows of its own length
from the longest piece down, and the gaps of its windows are filled with the
longest pieces that fit, from the same tier or shorter ones. A piece that fills
its tier exactly needs no padding and stays alone. Where no piece fits a gap,
pieces of the most frequent length are cut, so one window at most has padding.

The plan needs only how many pieces there are of each length: at most 1024
numbers, whatever the data. It is a list of patterns (lengths side by side,
repeated n times), so a piece finds its sequence from its length and its rank
among the pieces of that length. A task that encodes a text emits the text's
pieces, and what is ranked and joined afterwards is narrow; only pieces of the
lengths that the plan cuts are met with their ids again.

Sequences are numbered from the fullest down and dealt to steps in turn, so the
steps of a training run hold near equal numbers of tokens.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenledger.llm.common import free_name, with_positions, written

WINDOW = 1024
TIERS = (1024, 512, 256, 128)
END_ID = 0
STEP_SEQUENCES = 64

#: Texts with other letters go to the reference library itself, whose tables of
#: letters may be of another Unicode version than the fast encoder's.
PLAIN = f"[^\\x00-{chr(0x52F)}{chr(0x2000)}-{chr(0x206F)}{chr(0x20AC)}]|<\\|endoftext\\|>"


def encoder(tokenizer_path: str, ranks_path: str, pattern: str):
    """A function from a text to its ids, equal to the tokenizer file's.

    ``ranks_path`` holds the same vocabulary as merge ranks, for a faster
    library; texts that the two might treat differently use the file.
    """
    import base64
    import re

    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    exact = Tokenizer.from_file(tokenizer_path)
    exact.no_truncation()
    exact.no_padding()
    other = re.compile(PLAIN).search

    def encode(text: str) -> list[int]:
        if not other(text):
            try:
                return fast.encode_ordinary(text)
            except BaseException as exc:  # its matcher gives up on very long runs of one kind
                if isinstance(exc, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
        return exact.encode(text, add_special_tokens=False).ids
    return encode


def _pieces(tokenizer_path: str, ranks_path: str, pattern: str):
    def run(batches):
        encode = encoder(tokenizer_path, ranks_path, pattern)
        for batch in batches:
            rows, starts, lengths, sums, totals, kept = [], [], [], [], [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                ids = np.array([*encode(text), END_ID], "<u4")
                for at in range(0, len(ids), WINDOW):
                    part = ids[at:at + WINDOW]
                    rows.append(k)
                    starts.append(at)
                    lengths.append(len(part))
                    sums.append(zlib.crc32(part.tobytes()))
                    totals.append(len(ids))
                    # What fills a tier is never cut.
                    kept.append(None if len(part) in TIERS else part.tobytes())
            taken = batch.select(["_row", "_id"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, *[pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals)],
                 pa.array(kept, pa.binary())],
                ["_row", "_id", "start", "length", "ids_crc32", "doc_tokens", "_ids"])
    return run


def tier(length: int) -> int:
    """The shortest tier that holds ``length`` tokens."""
    return min(t for t in TIERS if t >= length)


def _side_by_side(left: dict[int, int], window: int) -> list[int]:
    """Lengths for one window: from the longest down, what fits into its gap."""
    pattern, gap = [], window
    for n in sorted(left, reverse=True):
        fit = min(gap // n, left[n])
        pattern += [n] * fit
        gap -= fit * n
    return pattern


def _repeat(left: dict[int, int], uses: Counter[int]) -> int:
    """Takes ``uses`` out of ``left`` as often as it can be, and says how often."""
    times = min(left[n] // k for n, k in uses.items())
    for n, k in uses.items():
        left[n] -= k * times
        if not left[n]:
            del left[n]
    return times


def plan(counts: dict[int, int]) -> list[tuple[list[int], int]]:
    """Patterns (lengths, repeats) that use up ``counts`` pieces of each length.

    Each tier is packed in turn, from the longest down, into windows of its own
    length. A window stays if its pieces fill it; the pieces of the others share
    windows of 1024 tokens.
    """
    left = {n: c for n, c in counts.items() if c}
    out = [([n], left.pop(n)) for n in TIERS if n in left]
    loose: Counter[int] = Counter()
    while left:
        window = tier(max(left))
        pattern = _side_by_side(left, window)
        uses = Counter(pattern)
        times = _repeat(left, uses)
        if sum(pattern) == window:
            out.append((pattern, times))
        else:
            loose.update({n: k * times for n, k in uses.items()})
    while loose:
        pattern = _side_by_side(loose, WINDOW)
        out.append((pattern, _repeat(loose, Counter(pattern))))
    return out


def fill(patterns: list[tuple[list[int], int]]) -> list[tuple[list[tuple[int, int]], int]]:
    """``patterns`` of pairs (length, tokens used of it), with the gaps filled.

    The pieces of windows that are not full are dealt anew, tier by tier; where no
    piece fits a gap, pieces of the most frequent length are cut, and their rests
    are pieces like others. Every cut fills a window, so at most one stays open.
    """
    out = [([(n, n) for n in p], times) for p, times in patterns if sum(p) in TIERS]
    left: Counter[int] = Counter()
    for pattern, times in patterns:
        if sum(pattern) not in TIERS:
            left.update({n: k * times for n, k in Counter(pattern).items()})
    while left:
        window = tier(max(left))
        pattern = _side_by_side(left, window)
        uses, gap, cut = Counter(pattern), window - sum(pattern), []
        more = [n for n in left if left[n] > uses[n]]  # all longer than the gap
        if gap and more:
            n = max(more, key=lambda n: (left[n] - uses[n], n))
            uses[n] += 1
            cut = [(n, gap)]
        times = _repeat(left, uses)
        for n, used in cut:
            left[n - used] += times
        out.append(([(n, n) for n in pattern] + cut, times))
    return out


def _placements(counts: dict[int, int], patterns: list[tuple[list[tuple[int, int]], int]]):
    """Rows (length, first rank, end rank, place in the piece, tokens, first sequence,
    offset, window) of the filled plan, and the number of sequences."""
    def total(pattern):
        return sum(used for _, used in pattern)

    # Ranges (length, first rank, place in the piece, number) of pieces, and of rests, by tokens left.
    pools = {n: [(n, 0, 0, c)] for n, c in counts.items()}
    firsts, sequences = [0] * len(patterns), 0
    for k in sorted(range(len(patterns)), key=lambda k: -total(patterns[k][0])):
        firsts[k], sequences = sequences, sequences + patterns[k][1]
    rows = []
    for first, (pattern, times) in zip(firsts, patterns):
        whole, offset = total(pattern), 0
        window = whole if whole & (whole - 1) == 0 else WINDOW
        rests = []
        for n, used in pattern:
            sequence = first
            while sequence < first + times:
                length, rank, at, number = pools[n].pop()
                taken = min(number, first + times - sequence)
                if taken < number:
                    pools[n].append((length, rank + taken, at, number - taken))
                if used < n:
                    rests.append((n - used, (length, rank, at + used, taken)))
                rows.append((length, rank, rank + taken, at, used, sequence, offset, window))
                sequence += taken
            offset += used
        for n, rest in rests:
            pools.setdefault(n, []).append(rest)
    return rows, sequences


def pack(docs: DataFrame, tokenizer_path: str, ranks_path: str, pattern: str,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece or part of a cut piece: ``id_col``, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset``, ``window`` (padded length of the
    sequence), ``step``.

    A document is its text's ids and the end id, so null and empty texts are one
    token long. Repeated rows and null ids are packed as often as they occur.
    Pieces of one length are ranked by id (nulls last), row and start. Other
    columns are not read.
    """
    spark = docs.sparkSession
    row = free_name([id_col], "row")
    kind = docs.schema[id_col].dataType.simpleString()
    pieces = written(docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(
        _pieces(tokenizer_path, ranks_path, pattern),
        f"_row long, _id {kind}, start long, length long, ids_crc32 long, doc_tokens long, _ids binary"), "pieces")
    # At most WINDOW rows meet on the driver.
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    patterns = fill(plan(counts))
    placements, sequences = _placements(counts, patterns)
    before, ahead = {}, 0
    for n in sorted(counts):
        before[n], ahead = ahead, ahead + counts[n]
    table = spark.createDataFrame(
        [(n, before[n] + a, before[n] + b, at, used, s, offset, w) for n, a, b, at, used, s, offset, w in placements],
        "_n long, _from long, _to long, _at long, _used long, _seq long, offset long, window long")
    placed = with_positions(pieces.drop("_ids").withColumn("_late", F.col("_id").isNull()),
                            ["length", "_late", "_id", "_row", "start"], "ranked")
    # The plan has a bounded number of rows (lengths, not documents).
    out = placed.join(F.broadcast(table), (F.col("length") == F.col("_n"))
                      & (F.col("pos") >= F.col("_from")) & (F.col("pos") < F.col("_to")))
    donors = sorted({n for n, _, _, _, used, *_ in placements if used < n})
    if donors:
        # Only pieces of lengths that are cut are met with their ids again.
        parted = F.col("_used") < F.col("length")
        ids = pieces.filter(F.col("length").isin(donors)).select("_row", "start", "_ids")
        part = F.substring(F.col("_ids"), (4 * F.col("_at") + 1).cast("int"), (4 * F.col("_used")).cast("int"))
        parts = out.filter(parted).join(ids, ["_row", "start"]).withColumn("ids_crc32", F.crc32(part))
        out = out.filter(~parted).unionByName(parts.select(*out.columns))
    steps = max(1, -(-sequences // STEP_SEQUENCES))
    sequence = F.col("_seq") + F.col("pos") - F.col("_from")
    return out.select(F.col("_id").alias(id_col), (F.col("start") + F.col("_at")).alias("start"),
                      F.col("_used").alias("length"), "ids_crc32", "doc_tokens",
                      sequence.alias("sequence_id"), "offset", "window", (sequence % steps).alias("step"))
