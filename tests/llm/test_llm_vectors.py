"""Centroid clustering and vector codes against plain searches over all distances."""

import hashlib
import math
import random

import numpy as np
import pytest

from greenledger.llm.centroids import Orchard, cluster_vectors
from greenledger.llm.vector_codes import Codebook, _half, encode_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, ID string"


def ints(v):
    return [math.floor(256 * x) for x in v]


def gap(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def sound(v, dims=None):
    return v and all(x is not None and math.isfinite(x) for x in v) and (dims is None or len(v) == dims)


def moved(centroids, rows, at):
    out = []
    for c, old in enumerate(centroids):
        mine = [v for v, a in zip(rows, at) if a == c]
        out.append([sum(col) // len(mine) for col in zip(*mine)] if mine else old)
    return out


def brute_clusters(table, k, rounds, dims):
    kept = [(i, ints(v)) for i, v in table if sound(v, dims)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    cents, rows = [v for _, v in order[:k]], [v for _, v in kept]
    for turn in range(rounds + 1):
        best = [min((gap(v, c), n) for n, c in enumerate(cents)) for v in rows]
        if turn < rounds:
            cents = moved(cents, rows, [n for _, n in best])
    each = {n: sum(d for d, m in best if m == n) for _, n in best}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, n, d, each[n], sum(each.values()), sha[n]) for (i, _), (d, n) in zip(kept, best)), key=str)


def brute_codes(table, parts, entries, rounds, dims):
    kept = [(i, l, ints(v)) for i, v, l in table if sound(v, dims)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    w = dims // parts
    code, err, books = [""] * len(kept), [0] * len(kept), []
    for p in range(parts):
        cut = [v[p * w:(p + 1) * w] for _, _, v in kept]
        book = [v[p * w:(p + 1) * w] for _, _, v in first]
        for turn in range(rounds + 1):
            best = [min((gap(v, c), n) for n, c in enumerate(book)) for v in cut]
            if turn < rounds:
                book = moved(book, cut, [n for _, n in best])
        books.append(book)
        for r, (d, n) in enumerate(best):
            code[r] += f"{n:02x}"
            err[r] += d
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted(((i, c, e, sum(f for (_, m, _), f in zip(kept, err) if m == l), sha)
                   for (i, l, _), c, e in zip(kept, code, err)), key=str)


def hard_table(dims, n=300, seed=3):
    """Coarse values (many ties), copies of one vector, and every kind of unusable row."""
    rng = random.Random(seed)
    vec = lambda step: [rng.randrange(-3, 4) * step for _ in range(dims)]
    table = [(i, vec(0.004 if i % 2 else 0.3), rng.choice([None, 1, 2])) for i in range(n)]
    hot = vec(0.3)
    table += [(1000 + i, hot, 7) for i in range(n // 2)]
    table += [(5, vec(0.3), 1), (5, table[5][1], None), (None, vec(0.3), 2), (None, None, 1), (-4, None, 1), (-3, [], 1), (-2, [0.5] * (dims - 1) + [None], 1),
              (-1, [0.1] * (dims - 1) + [float("nan")], 1), (-6, [float("inf")] * dims, 1), (2000, [0.25] * (2 * dims), 2)]
    return table


def frame(spark, table):
    return spark.createDataFrame([(i, v, l, "x", "y") for i, v, l in table], SCHEMA.replace("ID", "place")).repartition(5)


@pytest.mark.parametrize("k,rounds,dims", [(12, 3, 8), (1, 2, 4), (1000, 1, 4)])
def test_clusters_equal_brute_force(spark, k, rounds, dims):
    table = hard_table(dims)
    got = cluster_vectors(frame(spark, table), k, rounds, dims).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_clusters([(i, v) for i, v, _ in table], k, rounds, dims)


@pytest.mark.parametrize("parts,entries,rounds,dims", [(4, 16, 4, 8), (2, 3, 2, 8), (1, 1, 2, 4), (4, 256, 1, 8)])
def test_codes_equal_brute_force(spark, parts, entries, rounds, dims):
    table = hard_table(dims, seed=9)
    got = encode_vectors(frame(spark, table), parts, entries, rounds).collect()
    want = brute_codes(table, parts, entries, rounds, dims)
    assert sorted((tuple(r) for r in got), key=str) == want


def test_empty_tables_and_no_usable_vector(spark):
    for df in (spark.createDataFrame([], SCHEMA.replace("ID", "place")), frame(spark, [(1, None, 1), (2, [float("nan")], 2)])):
        got = cluster_vectors(df)
        assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and not got.count()
        got = encode_vectors(df)
        assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and not got.count()


def test_unequal_parts_and_huge_components_are_errors(spark):
    with pytest.raises(ValueError, match="equal parts"):
        encode_vectors(frame(spark, [(1, [0.1] * 9, 1)]), parts=4)
    with pytest.raises(ValueError, match="beyond"):
        cluster_vectors(frame(spark, [(1, [1e30] * 64, 1)]))


def test_orchard_is_exact_from_any_start_and_measures_less():
    rng = np.random.default_rng(1)
    centroids = rng.integers(-400, 400, (60, 6))
    centroids[30:] = centroids[:30] + rng.integers(-3, 4, (30, 6))  # near twins
    centroids[59] = centroids[2]  # and a tie everywhere
    x = np.concatenate([centroids[rng.integers(0, 60, 3000)] + rng.integers(-20, 21, (3000, 6)), centroids])
    want = ((x[:, None] - centroids[None]) ** 2).sum(2)
    for start in (None, np.zeros(len(x), np.int64), rng.integers(0, 60, len(x))):
        search = Orchard(centroids)
        at, far = search.nearest(x, start)
        assert (at == want.argmin(1)).all() and (far == want.min(1)).all()
        assert search.measured < 0.5 * want.size


def test_bounds_spare_most_entries_and_stay_exact():
    """Many small moves: the lists stay exact while few parts need all entries."""
    rng = np.random.default_rng(2)
    entries = rng.integers(-300, 300, (64, 4))
    x = entries[rng.integers(0, 64, 4000)] + rng.integers(-25, 26, (4000, 4))
    near, low, _ = Codebook(entries).measured(x, 6)
    low, keep = _half(low), 6
    for turn in range(6):
        new = entries + rng.integers(-3, 4, entries.shape)
        drift = np.sqrt(((new - entries) ** 2).sum(1)) * (1 + 1e-9)
        entries = new
        if turn == 3:
            keep = 3
        near, low, dist, need = Codebook(entries, drift).updated(x, near, low.astype(np.float64), keep)
        low = _half(low)
        far = ((x[:, None] - entries[None]) ** 2).sum(2)
        assert (near[:, 0] == far.argmin(1)).all() and (dist == far.min(1)).all()
        assert (low[:, :-1] <= np.sqrt(np.take_along_axis(far, near[:, 1:], 1))).all()
        rest = far.copy()
        np.put_along_axis(rest, near, np.iinfo(np.int64).max, 1)
        assert (low[:, -1] <= np.sqrt(rest.min(1))).all()  # the outer bound holds for all entries off the list
        assert (need == 0).mean() > 0.4
        if turn < 3:
            assert (need == 6).mean() < 0.2


def test_half_floats_round_down():
    x = np.array([0.0, 1e-9, 0.1, 1.0, 2049.7, 65504.0, 1e9, np.inf])
    h = _half(x)
    assert (h.astype(np.float64) <= x).all() and np.isinf(h[-1]) and h[-2] == 65504
