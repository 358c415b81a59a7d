"""Exact dedup, sharding and quality rules: brute force and edge cases; the pipeline end to end."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from greenledger.llm import queries as Q
from greenledger.llm import sharding as S
from greenledger.llm.common import written
from greenledger.llm.exact_dedup import drop_copies, exact_classes
from greenledger.llm.quality_rules import judge

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, kept string, _row int, shard string"


def norm(t):
    return re.sub("[\x20\x09-\x0D]+", " ", t or "")


def edge_docs(rng):
    long = "".join(rng.choice("ab \n") for _ in range(40000))
    docs = [(1, None), (2, ""), (3, " "), (4, "\n\t"), (9, long), (8, long), (8, long), (10, long + "x"), (11, long[:-1]),
            (None, long), (None, "only"), (None, "only"), (20, "é ü"), (21, "é\x0bü"), (22, "é ü"), (23, "a" * 64), (24, "a" * 65),
            (25, "a" * 64), (26, "a" * 1088), (27, "a" * 1088 + "b"), (27, "a" * 1088)]
    docs += [(100 + i, rng.choice(["x y", "x  y", "xy", "x\ny z"])) for i in range(30)]
    rng.shuffle(docs)
    return docs


def frame(spark, docs):
    return spark.createDataFrame([(i, t, f"h{k % 3}" if k % 7 else None, "c", k, "s") for k, (i, t) in enumerate(docs)], SCHEMA)


def test_exact_dedup(spark):
    docs = edge_docs(random.Random(1))
    groups = collections.defaultdict(list)
    for i, t in docs:
        groups[norm(t)].append(i)
    rows = exact_classes(frame(spark, docs)).collect()
    assert len(rows) == len(docs)
    want = collections.Counter()
    for t, ids in groups.items():
        first = min((i is None, i or 0) for i in ids)
        for i in ids:
            want[i, None if first[0] else first[1], len(ids), hashlib.sha256(t.encode()).hexdigest()] += 1
    assert collections.Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows) == want
    kept = [r for r in rows if r["kept"]]
    assert len(kept) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)
    left = drop_copies(frame(spark, docs))
    assert left.columns == frame(spark, docs).columns
    got = left.collect()
    assert sorted(norm(r["text"]) for r in got) == sorted(groups)
    everything = {tuple(r) for r in frame(spark, docs).collect()}
    assert {tuple(r) for r in got} <= everything
    assert exact_classes(frame(spark, docs).limit(0)).count() == 0 and drop_copies(frame(spark, docs).limit(0)).count() == 0


def least_capacity(sizes, shards):
    def ok(c):
        n, used = 1, 0
        for s in sizes:
            if s > c:
                return False
            if used + s > c:
                n, used = n + 1, 0
            used += s
        return n <= shards
    return next(c for c in range(max(sizes), sum(sizes) + 1) if ok(c))


def check_shards(rows, docs, shards):
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == collections.Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs)
    loads, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = collections.defaultdict(list)
    for i, t in docs:
        groups[t or ""].append(i)
    first = {t: min((i is None, i or 0) for i in ids) for t, ids in groups.items()}
    # Ties between first ids are broken by digest, as documented.
    order = sorted(groups, key=lambda t: (first[t], hashlib.sha256(t.encode()).hexdigest()))
    sizes = [len(groups[t]) * (len(t.encode()) + 1) for t in order]
    assert max(loads.values()) == least_capacity(sizes, shards)
    where = collections.defaultdict(set)
    for r in rows:
        where[r["size"], r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for s in where.values())


@pytest.mark.parametrize("cells", [64, 16384])
def test_sharding(spark, monkeypatch, cells):
    monkeypatch.setattr(S, "CELLS", cells)  # few cells: several refinements
    rng = random.Random(cells)
    docs = edge_docs(rng) + [(1000 + i, "w" * int(rng.paretovariate(0.9) * 40)) for i in range(400)]
    check_shards(S.assign_shards(frame(spark, docs)).collect(), docs, 16)
    check_shards(S.assign_shards(frame(spark, docs), shards=5).collect(), docs, 5)


def test_sharding_small(spark):
    check_shards(S.assign_shards(frame(spark, [(1, "a"), (2, None)])).collect(), [(1, "a"), (2, None)], 16)
    assert S.assign_shards(frame(spark, [(1, "a")]).limit(0)).count() == 0
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check_shards(Q.op4_sharding(spark, SF).collect(), docs, 16)


def measures(t):
    w = re.findall("[^\x20\x09-\x0D]+", t or "")
    three = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = collections.Counter(three)
    hit = {i + k for i, x in enumerate(three) if n[x] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if re.search("[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", t or "")), dup, len(hit)


def test_quality(spark):
    rng = random.Random(4)
    docs = edge_docs(rng) + [(5000 + i, " ".join(rng.choice("ab") * rng.randint(1, 2) for _ in range(rng.randint(1, 200)))) for i in range(60)]
    docs += [(7000, "a b c " * 5000), (7001, "#*$ %&|<>\n\nx\nx\n x\nx"), (7002, "a b a b a")]
    rows = judge(frame(spark, docs)).collect()
    got = collections.Counter(tuple(r)[:6] for r in rows)
    assert got == collections.Counter((i, *measures(t)) for i, t in docs)
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and not r["host_failed"])
    assert judge(frame(spark, docs).limit(0)).count() == 0


def test_bad_hosts_take_their_documents_down(spark):
    good = " ".join(f"w{i}" for i in range(80))
    docs = [(i, good, f"good{i % 10}") for i in range(300)] + [(1000 + i, "bad", "farm") for i in range(60)] + [
        (2000, good, "farm"), (2001, "bad", "single"), (2002, good, None)]
    rows = {r["doc_id"]: r for r in judge(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()}
    assert rows[2000]["host_failed"] and not rows[2000]["base_failed"] and not rows[2000]["kept"]
    assert rows[0]["kept"] and rows[2002]["kept"]


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_oracles(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    res = con.execute(Q.ORACLE_SQL[name])
    cols = [d[0] for d in res.description]
    want = collections.Counter(map(str, res.fetchall()))
    out = Q.QUERIES[name](spark, SF)
    assert sorted(out.columns) == sorted(cols)
    assert collections.Counter(str(tuple(r)) for r in out.select(cols).collect()) == want


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = written(stage(spark, kept, SF), name)
        assert kept.dtypes == docs.dtypes
        counts.append(kept.count())
    assert counts == sorted(counts, reverse=True) and counts[0] > counts[2] > counts[3] and counts[3] == counts[4]
    pieces = corpus_pipeline.run(spark, SF)
    assert {r[0] for r in pieces.select("doc_id").distinct().collect()} == {r[0] for r in kept.select("doc_id").collect()}
    assert not kept.filter(F.col("text").rlike(r"\d+@mail\d\.example\.com")).count()


def test_pipeline_keeps_nothing_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs_out = stage(spark, docs, SF)
        assert docs_out.count() == 0
