"""Exact dedup by distributed MSD radix partitioning.

Documents are split into groups by successive runs of bytes, most significant
first: all rows of a group share every byte read so far. A pass reads the next
digit (the next run of bytes of every text still undecided), splits each group
by (digit, text ended here?) and goes on with groups that have at least two
rows and bytes left. A group is named by the row number of its first row, so
equality is decided by the bytes alone; no digest takes part.

Digits widen by ``GROWTH`` from pass to pass, so the passes grow with the
logarithm of the longest text that has a twin. Every pass is one aggregate
(pre-combined in the map tasks: a group with a third of all rows sends one row
per task) and one equi-join that adaptive execution splits when a group is hot.
Only rows in undecided groups move, with the digit of that pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenledger.llm.common import SPACES, bucketed, free_name, numbered, written

FIRST_DIGIT = 64
GROWTH = 16


def normalised(text) -> F.Column:
    """Null as empty; every run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _classes(base: DataFrame, row: str, text: F.Column) -> tuple[DataFrame, DataFrame]:
    """(row, first, keep_id, group_size) of every row of ``base`` (row, _id and
    what ``text`` reads); ``first`` is the row that stays. Also (row, _id, _sha)."""
    norm = F.encode(normalised(text), "UTF-8")
    state, done, at, width = None, [], 0, FIRST_DIGIT
    while True:
        digit = [F.substring(norm, at + 1, width).alias("_digit"), (F.length(norm) <= at + width).alias("_ended")]
        if state is None:
            rows = every = written(base.select(
                row, "_id", F.lit(0).cast("long").alias("_group"), *digit, F.sha2(norm, 256).alias("_sha")), "digits")
        else:  # only rows still undecided are normalised again
            rows = written(base.join(state, row).select(row, "_id", "_group", *digit), "digits")
        keys = ["_group", "_digit", "_ended"]
        # Written, so that both sides of the join are shuffled for it alone: a hot
        # group's rows can then be split over tasks.
        groups = written(rows.groupBy(*keys).agg(
            F.min(F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id").alias("id"),
                           F.col(row).alias("row"))).alias("_first"),
            F.count(F.lit(1)).alias("_n")), "groups")
        split = written(
            rows.join(groups, keys).select(
                row, F.col("_first.row").alias("_next"), F.col("_first.id").alias("keep_id"),
                "_n", "_ended"), "radix")
        settled = F.col("_ended") | (F.col("_n") == 1)
        done.append(split.filter(settled).select(
            row, F.col("_next").alias("first"), "keep_id", F.col("_n").alias("group_size")))
        state = split.filter(~settled).select(row, F.col("_next").alias("_group"))
        if state.isEmpty():
            break
        at, width = at + width, width * GROWTH
    return reduce(DataFrame.union, done), every.select(row, "_id", "_sha")


def exact_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, ``keep_id`` (id of the row of its group
    that stays), ``group_size``, ``kept``, ``text_sha256`` of the normalised text.

    Equal means byte-identical after ``normalised``. The smallest id of a group
    stays (null ids last); of rows that tie on the id exactly one stays. Null
    and empty texts are equal. Other columns are not read.
    """
    row = free_name(["_id", "_text"], "row")
    base = bucketed(numbered(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), row), row, "exact")
    classes, every = _classes(base, row, F.col("_text"))
    return classes.join(every, row).select(
        F.col("_id").alias(id_col), "keep_id", "group_size",
        (F.col(row) == F.col("first")).alias("kept"), F.col("_sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without later copies, all columns unchanged."""
    row = free_name(["_id", "_whole"], "row")
    base = bucketed(numbered(docs.select(F.col(id_col).alias("_id"), F.struct(*docs.columns).alias("_whole")), row), row, "exact")
    classes, _ = _classes(base, row, F.col("_whole")[text_col])
    kept = classes.filter(F.col(row) == F.col("first")).select(row)
    return base.select(row, "_whole").join(kept, row, "left_semi").select("_whole.*")
