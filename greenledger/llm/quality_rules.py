"""Host-level quality rules: document rules, failures per host, shrunk host verdicts.

Each document is measured once (one projection of built-in expressions). The
rule failures are counted per host, and each host's failure rate is shrunk
towards all hosts' with a beta prior fitted to the hosts (method of moments):
a host with few documents says little by itself. A host whose shrunk rate is
above ``max_rate`` takes its documents down with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenledger.llm.common import SPACES, written

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MAX_HOST_RATE = 0.5
SYMBOLS = "[#*$%&|<>]"
WORD = r"[^\x20\x09-\x0D]"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, inside one expression."""
    return F.transform(F.array(value), body)[0]


def _repeated(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in ``words``.

    Windows are compared by 64-bit hash. Documents without any repeated hash
    are done after a distinct count; else (hash, place) pairs are sorted, those
    next to an equal hash are marked, and the marked places' 3-word spans are
    united: linear but for the sorts, whatever repeats.
    """
    def three(i):
        return F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))

    def spread(pairs):
        near = F.filter(pairs, lambda x, i: x["h"].eqNullSafe(F.get(pairs, i - 1)["h"])
                        | x["h"].eqNullSafe(F.get(pairs, i + 1)["h"]))
        at = F.sort_array(F.transform(near, lambda x: x["p"]))
        return let(at, lambda ps: F.aggregate(
            F.transform(ps, lambda p, k: F.coalesce(F.least(F.lit(3), F.get(ps, k + 1) - p), F.lit(3))),
            F.lit(0), lambda a, b: a + b))

    def some(hashes):
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            let(pairs, spread))

    places = F.sequence(F.lit(0), F.size(words) - 3)
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(F.transform(places, three), some))


def measures(text: Column) -> Column:
    """A struct of the document measures of one whole text (null: no word)."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    return let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeated(w).cast("long").alias("n_repeat_words")))


def host_verdicts(rows: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(host, n, failed, host_kept) of rows (host, base_failed).

    The hosts' rates have mean m and variance v; sampling alone explains
    m(1-m)·avg(1/n) of v. What is left fits a beta prior of strength
    s = m(1-m)/left - 1, at least 0; nothing left shrinks every host to m.
    """
    hosts = written(rows.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed")), "hosts")
    rate = F.col("failed") / F.col("n")
    mean = F.avg(rate)
    spread = F.var_pop(rate) - mean * (1 - mean) * F.avg(1 / F.col("n"))
    # One row: scalar subqueries, not a join.
    prior = hosts.agg(mean.alias("m"), spread.alias("left"))
    hosts = hosts.withColumn("m", prior.select("m").scalar()).withColumn("left", prior.select("left").scalar())
    m, left = F.col("m"), F.col("left")
    s = F.greatest(m * (1 - m) / left - 1, F.lit(0.0))
    shrunk = F.when(left > 0, (F.col("failed") + s * m) / (F.col("n") + s)).otherwise(m)
    return hosts.select("host", "n", "failed", (shrunk <= max_rate).alias("host_kept"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          host_col: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per input row: ``id_col``, the measures, ``base_failed``, ``host_failed``, ``kept``.

    A null text has no word and fails the base rules. Rows without a host form
    one group of their own. Repeated rows count each. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(host_col).alias("host"),
                       measures(F.col(text_col)).alias("m")).select("_id", "host", "m.*")
    rows = written(rows.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                   | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))), "measured")
    hosts = host_verdicts(rows, max_rate).select(F.col("host").alias("_host"), "host_kept")
    # A hot host's rows are split by adaptive execution; its verdict is one row.
    return rows.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).select(
        F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("host_kept")).alias("host_failed"),
        (~F.col("base_failed") & F.col("host_kept")).alias("kept"))
