"""Similarity join on word n-grams with Bayesian candidate pruning.

Two documents are linked if the Jaccard similarity of their sets of five-word
shingles is at least 0.8.

1. Documents with the same words are one text: its copies are counted, not paired.
2. Each text gets ``BANDS`` keys of ``BAND_ROWS`` MinHash values. A pair at
   similarity s shares a key with probability 1 - (1 - s**5)**36: all but
   6 in 10 million at 0.8. Texts joined through shared keys form candidate
   components (star edges to the smallest member of a key, never all pairs).
3. The pairs compared are those that share a key, at every size. A component is
   laid out as a whole. One of many blocks whose keys are small beside it
   (loosely chained texts, say around one boilerplate) is laid out key by
   key instead, each pair at its first shared key only.
   The members of these units are laid out in one order and cut into blocks of
   bounded bytes. Every pair of blocks of a unit is one task's work, so a huge
   unit is spread over many tasks; small ones share a block.
4. In a block pair, pairs are compared by further MinHash values, ``STEP`` at a
   time. After n values with m matches, the posterior probability (uniform
   prior) that the similarity reaches the threshold is that of at most m
   successes in n + 1 trials at the threshold; a pair below ``TOLERANCE`` is
   dropped. The rest are verified on their exact shingle sets, as bit rows over
   the shingles that a block pair shares. All steps work on arrays of pairs.
5. A task emits one row per document: its links there and a spanning star of
   the linked ones. Links are summed, stars are united to classes.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenledger.llm.common import bucketed, free_name, numbered, with_positions, written
from greenledger.llm.components import components
from greenledger.llm.rolling import Ranges, mix

N_WORDS = 5
THRESHOLD = 0.8
BANDS, BAND_ROWS = 36, 5
STEP, STEPS = 16, 8
TOLERANCE = 1e-8
BLOCK_BYTES = 1 << 20
#: A component above so many blocks is compared by key if that makes SPARSE times fewer pairs.
SPREAD_BLOCKS, SPARSE = 8, 4
#: Shingles hashed at once, so that the product stays in cache.
CHUNK = 1024
#: Pairs that are compared at once, and words of bits: bounds the memory of a task.
PAIRS, WORDS = 1 << 18, 1 << 22

_rng = np.random.default_rng(20240229)
_N = BANDS * BAND_ROWS + STEP * STEPS
XOR = _rng.integers(0, 1 << 32, _N, np.uint32)
MUL = _rng.integers(0, 1 << 31, _N, np.uint32) * np.uint32(2) + np.uint32(1)
BAND_MUL = mix(_rng.integers(0, 1 << 63, BAND_ROWS).astype(np.uint64)) | np.uint64(1)
LSH = slice(0, BANDS * BAND_ROWS)
COMPARE = slice(BANDS * BAND_ROWS, _N)


def words_of(text: str) -> bytes:
    """The words of a text (split at ASCII white space) joined by one space."""
    return b" ".join(text.encode().split())


def shingles(words: bytes, n: int = N_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles; a text of fewer
    words has one shingle, of all of them; no word, none."""
    if not words:
        return np.empty(0, np.uint64)
    data = np.frombuffer(words, np.uint8)
    gaps = np.flatnonzero(data == 32)
    starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(data)]])
    if len(starts) > n:
        starts, ends = starts[:len(starts) - n + 1], ends[n - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    return np.unique(Ranges(data).hash(starts, ends))


def minhash(hashes: np.ndarray, part: slice) -> np.ndarray:
    """MinHash values of a set of shingles under the functions of ``part``."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)[:, None]
    xor, mul = XOR[part], MUL[part]
    best = np.full(len(xor), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), CHUNK):
        np.minimum(best, ((x[at:at + CHUNK] ^ xor) * mul).min(0), out=best)
    return best


def band_keys(hashes: np.ndarray) -> np.ndarray:
    values = minhash(hashes, LSH).astype(np.uint64).reshape(BANDS, BAND_ROWS)
    return mix((mix(values + np.uint64(1)) * BAND_MUL).sum(1) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """For n = STEP, 2 STEP, ...: the fewest matches that keep a pair."""
    out = []
    for n in range(STEP, STEP * STEPS + 1, STEP):
        below, m = 0.0, 0
        while True:  # P(Binomial(n + 1, threshold) <= m) is the posterior of reaching it
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold)**(n + 1 - m)
            if below >= tolerance:
                break
            m += 1
        out.append(m)
    return out


def _key_rows(batches):
    for batch in batches:
        digests, sizes, keys = [], [], []
        for text in batch.column("text").to_pylist():
            words = words_of(text)
            digests.append(hashlib.blake2b(words, digest_size=16).digest() if words else None)
            sizes.append(len(words))
            keys.append(band_keys(shingles(words)) if words else np.empty(0, np.int64))
        ends = np.cumsum([0, *map(len, keys)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("id"), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*keys, np.empty(0, np.int64)])))],
            ["row", "id", "digest", "n_bytes", "keys"])


def bits_of(sets: list[np.ndarray]) -> np.ndarray:
    """(set, word) bit rows over the hashes that at least two of the sets have:
    the others are in no intersection."""
    flat = np.concatenate([*sets, np.empty(0, np.uint64)])
    names, dense, times = np.unique(flat, return_inverse=True, return_counts=True)
    place = np.cumsum(times > 1) - 1
    shared = times[dense] > 1
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])[shared]
    at = place[dense[shared]]
    bits = np.zeros((len(sets), -(-int((times > 1).sum()) // 64) or 1), np.uint64)
    np.bitwise_or.at(bits, (owner, at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
    return bits


def compare(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray | None, band: int = -1,
            threshold: float = THRESHOLD):
    """Yields arrays (a, b) of linked pairs, a in ``left`` and b in ``right`` (None: later
    members of ``left``); indices into ``sets``. Pairs without a shared band key
    are left out; with a ``band``, all but those whose first shared key is that band's."""
    used = left if right is None else np.concatenate([left, right])
    mine = [sets[i] for i in used]
    sig = np.array([minhash(x, COMPARE) for x in mine])
    keys = np.array([band_keys(x) for x in mine])
    sizes = np.array([len(x) for x in mine])
    bits = bits_of(mine)
    others = np.arange(0 if right is None else len(left), len(used))
    need = least_matches(threshold)
    slab = max(1, PAIRS // max(1, len(others)))
    for lo in range(0, len(left), slab):
        a = np.arange(lo, min(lo + slab, len(left)))
        small, large = (f(sizes[a][:, None], sizes[others][None]) for f in (np.minimum, np.maximum))
        near = small >= threshold * large - 1e-9
        if right is None:
            near &= others[None] > a[:, None]
        i, j = np.nonzero(near)
        i, j = a[i], others[j]
        matches = np.zeros(len(i), np.int64)
        for s in range(STEPS):
            part = slice(s * STEP, (s + 1) * STEP)
            matches += (sig[i, part] == sig[j, part]).sum(1)
            alive = matches >= need[s]
            i, j, matches = i[alive], j[alive], matches[alive]
            if not len(i):
                break
        if not len(i):
            continue
        same = keys[i] == keys[j]
        alive = same.any(1) if band < 0 else same.any(1) & (same.argmax(1) == band)
        i, j = i[alive], j[alive]
        step = max(1, WORDS // bits.shape[1])
        for at in range(0, len(i), step):
            x, y = i[at:at + step], j[at:at + step]
            both = np.bitwise_count(bits[x] & bits[y]).sum(1, dtype=np.int64)
            linked = both >= threshold * (sizes[x] + sizes[y] - both) - 1e-9
            if linked.any():
                yield used[x[linked]], used[y[linked]]


def joined_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give all members that the pairs (a, b) connect the smallest root among them."""
    while True:
        low = np.minimum(root[a], root[b])
        old = root.copy()
        for end in (a, b):
            np.minimum.at(root, root[end], low)
            np.minimum.at(root, end, low)
        while (root[root] != root).any():
            root[:] = root[root]
        if (old == root).all():
            return


def _links(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row per document of a block pair that is linked there: links, root."""
    p, q = pdf["p"].iloc[0], pdf["q"].iloc[0]
    pdf = pdf.sort_values(["band", "unit", "row"], ignore_index=True)
    rows, copies, block, band, unit = (pdf[c].to_numpy() for c in ("row", "copies", "block", "band", "unit"))
    of_row: dict[int, np.ndarray] = {}  # a text may stand in several units
    sets = [of_row[r] if r in of_row else of_row.setdefault(r, shingles(words_of(t))) for r, t in zip(rows, pdf["text"])]
    root = np.arange(len(rows))
    links = np.zeros(len(rows), np.int64)
    cuts = [0, *(np.flatnonzero((unit[1:] != unit[:-1]) | (band[1:] != band[:-1])) + 1), len(unit)]
    for lo, hi in zip(cuts, cuts[1:]):
        members = np.arange(lo, hi)
        if p == q:
            pairs = compare(sets, members, None, band[lo])
        else:
            left, right = members[block[lo:hi] == p], members[block[lo:hi] == q]
            if not len(left) or not len(right):
                continue
            pairs = compare(sets, left, right, band[lo])
        for a, b in pairs:
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            joined_roots(root, a, b)
    there = np.flatnonzero(links)
    return pd.DataFrame({"row": rows[there], "links": links[there], "root": rows[root[there]]})


def similar_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``near_classes`` of documents: one row per input row, named by ``id_col``."""
    row = free_name(["id", "text"], "row")
    base = bucketed(numbered(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), row), row, "near")
    return near_classes(base, row, F.col("text")).select(
        F.col("id").alias(id_col), "class_id", "class_size", "n_links", "kept")


def near_classes(base: DataFrame, row: str, text: Column) -> DataFrame:
    """(row, id, class_id, class_size, n_links, kept) of every row of ``base``
    (row, id and what ``text`` reads).

    ``n_links``: rows linked to this one, copies included. A class is a set of
    rows connected by links; ``class_id`` is its smallest id (null ids last), and
    of that id's rows one is ``kept``. A text of one to four words has a single
    shingle; a text without a word (null, empty) is linked to nothing. Repeated
    rows are copies of each other.
    """
    kind = base.schema["id"].dataType.simpleString()
    text = F.coalesce(text, F.lit("")).alias("text")
    keyed = written(base.select(F.col(row).alias("row"), "id", text).mapInArrow(
        _key_rows, f"row long, id {kind}, digest binary, n_bytes long, keys array<bigint>"), "keys")
    texts = written(keyed.filter("digest IS NOT NULL").groupBy("digest").agg(
        F.min("row").alias("rep"), F.count(F.lit(1)).alias("copies")), "texts")
    keys = keyed.join(texts.select(F.col("rep").alias("row")), "row", "left_semi").select(
        "row", F.posexplode("keys").alias("band", "key"))
    shared = keys.groupBy("key").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    held = written(keys.join(shared, "key").select("row", "band", "key", "first", "n"), "held")
    found = components(held.select(F.col("row").alias("a"), F.col("first").alias("b")))
    members = found.union(found.select("root", "root").distinct()).toDF("row", "comp")
    members = written(members.join(keyed.select("row", "n_bytes", "digest"), "row").join(texts, "digest").select(
        "row", "comp", "copies", "n_bytes"), "members")
    units = _units(members, held)
    laid = with_positions(units, ["band", "unit", "row"], "laid", {"upto": "n_bytes"})
    laid = written(laid.withColumn("block", F.expr(f"upto div {BLOCK_BYTES}")), "blocks")
    spans = written(laid.groupBy("band", "unit").agg(F.min("block").alias("lo"), F.max("block").alias("hi")), "spans")
    work = laid.join(spans, ["band", "unit"]).withColumn("other", F.explode(F.sequence("lo", "hi"))).select(
        "row", "band", "unit", "copies", "block",
        F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"))
    work = base.select(F.col(row).alias("row"), text).join(work, "row")
    linked = written(work.groupBy("p", "q").applyInPandas(_links, "row long, links long, root long"), "links")
    classes = components(linked.select(F.col("row").alias("a"), F.col("root").alias("b")))
    per_text = linked.groupBy("row").agg(F.sum("links").alias("links"))
    # Every row: its text's representative, that text's links and class.
    rows = keyed.select("row", "id", "digest").join(texts, "digest", "left").withColumn(
        "rep", F.coalesce("rep", "row"))
    reps = texts.select("rep").join(per_text.withColumnRenamed("row", "rep"), "rep", "left").join(
        classes.withColumnRenamed("node", "rep"), "rep", "left").select(
        F.col("rep").alias("_rep"), F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "rep").alias("root"))
    rows = rows.join(reps, F.col("rep") == F.col("_rep"), "left").select(
        "row", "id", F.coalesce("root", "rep").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"))
    rows = written(rows, "classed")
    firsts = written(rows.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("row").alias("row"))).alias("first"),
        F.count(F.lit(1)).alias("class_size")), "firsts")
    return rows.join(firsts, "root").select(
        F.col("row").alias(row), "id", F.col("first.id").alias("class_id"), "class_size", "n_links",
        (F.col("row") == F.col("first.row")).alias("kept"))


def _units(members: DataFrame, held: DataFrame) -> DataFrame:
    """(row, band, unit, copies, n_bytes): what is compared together. Band -1: a
    whole component; else the texts that hold one key of that band."""
    comps = members.groupBy("comp").agg(F.count(F.lit(1)).alias("m"), F.sum("n_bytes").alias("bytes"))
    by_key = held.join(members.select("row", "comp"), "row").groupBy("comp").agg(F.sum(F.col("n").cast("double")).alias("pairs"))
    sparse = written(comps.filter(F.col("bytes") > SPREAD_BLOCKS * BLOCK_BYTES).join(by_key, "comp").filter(
        SPARSE * F.col("pairs") < F.col("m").cast("double") * F.col("m")).select("comp"), "sparse")
    whole = members.join(sparse, "comp", "left_anti").select(
        "row", F.lit(-1).alias("band"), F.col("comp").alias("unit"), "copies", "n_bytes")
    return whole.union(held.join(members.join(sparse, "comp", "left_semi"), "row").select(
        "row", "band", F.col("key").alias("unit"), "copies", "n_bytes"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each class, all columns unchanged."""
    row = free_name(["id", "whole"], "row")
    base = bucketed(numbered(docs.select(F.col(id_col).alias("id"), F.struct(*docs.columns).alias("whole")), row), row, "near")
    kept = near_classes(base, row, F.col("whole")[text_col]).filter("kept").select(row)
    return base.select(row, "whole").join(kept, row, "left_semi").select("whole.*")
