"""The registered queries ``opN_<name>`` over the whole training-data tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from greenledger.llm.bpe import encode_decode
from greenledger.llm.centroids import cluster_vectors
from greenledger.llm.exact_dedup import exact_classes
from greenledger.llm.langid import held_out, identify, labelled_sample
from greenledger.llm.ngram_join import similar_classes
from greenledger.llm.packing import pack
from greenledger.llm.pii import replace_pii
from greenledger.llm.quality_rules import judge
from greenledger.llm.sharding import assign_shards
from greenledger.llm.suffix_dedup import remove_repeats
from greenledger.llm.token_counts import count_tokens
from greenledger.llm.vector_codes import encode_vectors
from greenledger.llm.vector_sql import centroids_sql, codes_sql
from greenledger.llm.warc import archived


def documents(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", *more)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir, "source"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Each run starts from an empty cache: results and figures never rest on an earlier run.
    return count_tokens(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_classes(documents(spark, sf_dir))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(documents(spark, sf_dir))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), (F.col("n_removed") > 0).alias("repeats"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_decode(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


#: Key of the surrogates; a production run passes its own secret.
PII_KEY = "change-me"


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_pii(documents(spark, sf_dir), PII_KEY, count_col="n_entities")


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "lang")
    found = identify(docs.select("doc_id", "text"), labelled_sample(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_classes(documents(spark, sf_dir))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_token_counts": op2_token_counts,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_sharding": op4_sharding,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_bpe": op6_bpe,
    "op7_packing": op7_packing,
    "op8_pii": op8_pii,
    "op9_langid": op9_langid,
    "op10_ngram_join": op10_ngram_join,
    "op11_centroids": op11_centroids,
    "op12_vector_codes": op12_vector_codes,
    "op13_warc": op13_warc,
}

ORACLE_SQL = {
    "op1_quality_rules": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
             w AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
             u AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM w),
             tri AS (SELECT r, i, w, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3 FROM u
                     WINDOW p AS (PARTITION BY r ORDER BY i)),
             twice AS (SELECT r, i FROM tri WHERE w3 IS NOT NULL
                       QUALIFY count(*) OVER (PARTITION BY r, w, w2, w3) >= 2),
             rep AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS o(k) GROUP BY r),
             line AS (SELECT r, count(*) - count(DISTINCT l) AS n
                      FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
                      WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
             m AS (SELECT doc_id, source, len(ws)::BIGINT AS n_words,
                          length(array_to_string(ws, ''))::BIGINT AS word_chars,
                          len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
                          coalesce(line.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
                   FROM d JOIN w USING (r) LEFT JOIN rep USING (r) LEFT JOIN line USING (r)),
             b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
             h AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS k FROM b GROUP BY source),
             p AS (SELECT avg(k / n) AS m, var_pop(k / n) - avg(k / n) * (1 - avg(k / n)) * avg(1 / n) AS v FROM h),
             s AS (SELECT source, CASE WHEN v > 0 THEN
                          (k + greatest(m * (1 - m) / v - 1, 0) * m) / (n + greatest(m * (1 - m) / v - 1, 0))
                          ELSE m END > 0.5 AS host_failed FROM h, p)
        SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_failed,
               NOT base_failed AND NOT host_failed AS kept
        FROM b JOIN s ON b.source IS NOT DISTINCT FROM s.source""",
    "op3_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
                   FROM documents),
             k AS (SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id,
                          count(*) OVER (PARTITION BY t) AS group_size,
                          row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept FROM n)
        SELECT doc_id, keep_id, group_size, kept, sha256(t) AS text_sha256 FROM k""",
    "op5_suffix_dedup": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
             w AS (SELECT r, i, md5_number(substr(h, 2 * i + 1, 800)) AS k
                   FROM (SELECT r, h, unnest(range(greatest(len(h) // 2 - 399, 0))) AS i FROM d)),
             twice AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
             hit AS (SELECT r, i FROM w SEMI JOIN twice USING (k)),
             run AS (SELECT r, i, i > coalesce(max(i) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1000) + 400 AS fresh
                     FROM hit),
             num AS (SELECT r, i, sum(fresh::INT) OVER (PARTITION BY r ORDER BY i) AS g FROM run),
             span AS (SELECT r, min(i) AS s, max(i) + 400 AS e FROM num GROUP BY r, g),
             cut AS (SELECT r, count(*) AS n_spans, sum(e - s) AS n_removed, list(s ORDER BY s) AS ss, list(e ORDER BY s) AS es FROM span GROUP BY r)
        SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
               sha256(unhex(CASE WHEN ss IS NULL THEN h ELSE array_to_string(list_transform(range(len(ss) + 1),
                   lambda k: substr(h, 2 * coalesce(es[k], 0) + 1, 2 * (coalesce(ss[k + 1], len(h) // 2) - coalesce(es[k], 0)))), '') END)) AS kept_sha256,
               coalesce(n_removed, 0) > 0 AS repeats
        FROM d LEFT JOIN cut USING (r)""",
    "op10_ngram_join": r"""
        WITH RECURSIVE d AS (SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
             s AS (SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
             n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
             pair AS (SELECT a.r AS a, b.r AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY 1, 2),
             link AS MATERIALIZED (SELECT a, b FROM pair JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 10 * k >= 8 * (x.n + y.n - k)),
             reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
             class AS (SELECT a AS r, min(b) AS root, count(*) AS class_size FROM reach GROUP BY a),
             deg AS (SELECT a AS r, count(*) AS n_links FROM link GROUP BY a)
        SELECT d.doc_id, first.doc_id AS class_id, class_size, coalesce(n_links, 0) AS n_links, class.root = d.r AS kept
        FROM d JOIN class USING (r) JOIN d first ON first.r = class.root LEFT JOIN deg ON deg.r = d.r""",
    "op11_centroids": centroids_sql(),
    "op12_vector_codes": codes_sql(),
    "op13_warc": r"""
        WITH p AS (SELECT row_number() OVER () AS r, page_id, coalesce(html, '') AS t FROM pages),
             g AS (SELECT t, max_by(r, (coalesce(page_id, -9223372036854775808), r)) AS last FROM p WHERE strlen(t) >= 1000 GROUP BY t)
        SELECT p.page_id, strlen(p.t)::BIGINT AS payload_bytes, sha1(p.t) AS payload_digest,
               CASE WHEN last <> p.r THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN last <> p.r THEN o.page_id END AS refers_to
        FROM p LEFT JOIN g ON g.t = p.t LEFT JOIN p AS o ON o.r = g.last""",
}
