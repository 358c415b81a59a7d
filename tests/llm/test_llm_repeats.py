"""Removal of repeated byte strings against brute force."""

import collections
import hashlib
import random

import numpy as np

from greenledger.llm import queries as Q
from greenledger.llm.suffix_dedup import positions, remove_repeats

SF = "/root/testdata/sf0.001"


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, kept) of each text, by counting every window."""
    seen = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        cover = np.cumsum(gone)[:len(t)] > 0
        spans = int(cover[:1].sum() + (cover[1:] & ~cover[:-1]).sum()) if len(t) else 0
        out.append((len(t), int(cover.sum()), spans, bytes(b for b, c in zip(t, cover) if not c)))
    return out


def check(spark, docs, length):
    want = collections.Counter((i, *x) for (i, _), x in zip(docs, brute([(t or "").encode() for _, t in docs], length)))
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, at int, row string")
    rows = remove_repeats(df, length).collect()
    assert collections.Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in rows) == want
    for r in rows:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"] and len(r["spans"]) == r["n_spans"]
    return sum(x[2] for x in want)


def varied(rng, n, alphabet):
    word = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    passages = [word(rng.randint(380, 900)) for _ in range(6)]
    docs = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a = rng.randint(0, 30)
            parts += [word(rng.randint(0, 200)), p[a:len(p) - rng.randint(0, 30)]]
        docs.append((i, "".join(parts) + word(rng.randint(0, 100))))
    return docs


def test_passages(spark):
    rng = random.Random(1)
    docs = varied(rng, 40, "abcdefgh é")
    docs += [(100, docs[3][1]), (100, docs[3][1]), (None, docs[5][1]), (101, None), (102, ""), (103, "z" * 399), (104, "q" * 400)]
    assert check(spark, docs, 400) > 1000


def test_periodic_and_self_overlapping(spark):
    docs = [(1, "a" * 1500), (2, "ab" * 700), (3, "b" + "abc" * 200), (4, "a" * 401), (5, "xyz" * 133 + "x"), (6, "xyz" * 133)]
    docs += varied(random.Random(2), 15, "ab")
    check(spark, docs, 400)


def test_planted_passages_of_over_50_words(spark, tmp_dir):
    """Each passage stands in three documents among words of their own: from 400 bytes on
    it goes from all three, below that it stays. Documents without one are left alone."""
    rng = random.Random(4)
    words = lambda n, k: " ".join("".join(rng.choices("abcdefgh", k=k)) for _ in range(n))
    passages = {51 * (k + 1) - 1: words(51, k) for k in (5, 6, 7, 8)}
    passages |= {399: words(57, 6) + "i", 400: words(57, 6) + "ij"}
    # Another space character around it in each document, so that nothing but the passage is common.
    docs = [(10 * n + i, f"{words(40, 9)}{s}{p}{s}{words(40, 9)}", n) for n, p in passages.items() for i, s in enumerate(" \n\t")]
    docs += [(9000 + i, words(130, 7), 0) for i in range(10)]
    spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    got = {r["doc_id"]: r for r in Q.op5_suffix_dedup(spark, tmp_dir).collect()}
    assert sorted(passages) == [305, 356, 399, 400, 407, 458] and len(got) == len(docs)
    for i, text, n in docs:
        kept = text.replace(passages[n], "") if n >= 400 else text
        assert got[i]["n_bytes"] == len(text) and got[i]["n_removed"] == len(text) - len(kept)
        assert got[i]["repeats"] == (n >= 400) and got[i]["n_spans"] == (n >= 400)
        assert got[i]["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()


def test_query(spark):
    docs = [(r["doc_id"], (r["text"] or "").encode()) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = {(i, n, gone, spans, hashlib.sha256(kept).hexdigest())
            for (i, _), (n, gone, spans, kept) in zip(docs, brute([t for _, t in docs], 400))}
    got = Q.op5_suffix_dedup(spark, SF).collect()
    assert {tuple(r)[:5] for r in got} == want and all(r["repeats"] == (r["n_removed"] > 0) for r in got)


def test_empty(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert remove_repeats(spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")).count() == 2


def test_every_window_has_one_position():
    data = np.random.default_rng(0).integers(0, 4, 5000).astype(np.uint8)
    at, first, last, _ = positions(data)
    assert first[0] == 0 and last[-1] == 4600 and (first[1:] == last[:-1] + 1).all()
    assert (at >= last).all() and (at <= first + 400 - 32).all() and (np.diff(at) > 0).all()
