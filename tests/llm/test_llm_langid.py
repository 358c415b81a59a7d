"""Language identification: brute-force cross-parsing, held-out accuracy, edge cases."""

import math
import zlib

from greenledger.llm import queries as Q
from greenledger.llm.langid import BLOCK, Parser, identify, labelled_sample, letters_only

SF = "/root/testdata/sf0.001"


def brute(sample, text):
    """Greedy longest phrases by plain substring search."""
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    costs = []
    whole = letters_only(text)
    for lang, parts in sorted(sample.items()):
        known = letters_only(" ".join(parts))
        n = 0
        for at in range(0, len(whole), BLOCK):
            block, i = whole[at:at + BLOCK], 0
            while i < len(block):
                k = 1
                while i + k < len(block) and block[i:i + k + 1] in known:
                    k += 1
                i, n = i + k, n + 1
        costs.append((n * math.log2(len(known) + 1), lang))
    costs.sort()
    return costs[0][1], 1 - costs[0][0] / costs[1][0]


def test_cross_parsing_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sample = labelled_sample(docs)
    assert len(sample) == 4
    texts = [r["text"] for r in docs.select("text").collect()] + [
        None, "", " 12 !", "é", "ЖЖЖ abc", "x" * (BLOCK + 5), "the " * 3000, "Straße\nÉté  Ñ", "日本"]
    langs, scores = Parser(sample).predict(texts)
    for t, lang, score in zip(texts, langs, scores):
        want = brute(sample, t)
        assert lang == want[0] and abs(score - want[1]) < 1e-9, t


def test_held_out_accuracy(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = Q.op9_langid(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(docs)
    right = total = 0
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
        d = docs[r["doc_id"]]
        if r["held_out"] and d["lang"] and len(d["text"] or "") > 100:
            total += 1
            right += r["lang_pred"] == d["lang"]
    assert total > 100 and right / total > 0.97


def test_columns_nulls_and_empty(spark):
    rows = [(1, "le la les", "fr", "x", 1), (None, None, None, "y", 2), (1, "le la les", "fr", "x", 1), (7, "12", "en", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string, k int")
    out = identify(docs, {"fr": ["le la les"]})
    assert out.columns == ["doc_id", "text", "lang", "k", "lang_pred", "score"]
    assert sorted((str(r["doc_id"]), r["lang_pred"], r["score"]) for r in out.collect()) == [
        ("1", "fr", 1.0), ("1", "fr", 1.0), ("7", "und", 0.0), ("None", "und", 0.0)]
    assert labelled_sample(docs.limit(0)) == {} and identify(docs.limit(0), {}).count() == 0
    assert {r["lang_pred"] for r in identify(docs, {}).collect()} == {"und"}


def test_sample_of_a_label_made_of_copies(spark):
    """Copies count once, offsets vary, bounds are arguments, and prediction still works."""
    base = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
            if r["lang"] and len(r["text"] or "") > 600]
    head = "the same licence line stands at the top of every one of these texts " * 3
    one = next(t for _, t, l in base if l == "fr")
    rows = [(i, head + t, l) for i, t, l in base if l != "fr"] + [(10_000 + i, one, "fr") for i in range(3000)]
    rows += [(20_000 + i, t, "fr") for i, (_, t, l) in enumerate(base) if l == "fr"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = labelled_sample(docs, texts=20, chars=300)
    assert all(len(v) <= 20 and len(set(v)) == len(v) and max(map(len, v)) <= 300 for v in sample.values())
    assert len(sample["fr"]) == 20
    assert sum(t.startswith(head[:100]) for v in sample.values() for t in v) < 5
    got = identify(spark.createDataFrame(base, "doc_id long, text string, lang string"), sample).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) > 0.95 * len(got)
