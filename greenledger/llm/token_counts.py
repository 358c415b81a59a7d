"""Token counts through a digest cache.

Counts are stored per (digest of the text, digest of the tokenizer version).
A run looks its texts up by digest, encodes only the distinct texts that the
cache lacks, appends their counts, and joins every document to its count. The
cache is a Parquet table partitioned by tokenizer digest, in shared storage.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from greenledger.llm.common import fresh_path, written

LIMIT = 4096
CACHE_SCHEMA = "digest binary, n_tokens long, tokenizer string"
#: Texts encoded by one call, to bound the memory of the ids.
CALL = 64


def tokenizer_version(model_path: str) -> str:
    """Digest of everything that decides a count: library, its version, the model file."""
    import sentencepiece

    with open(model_path, "rb") as f:
        model = f.read()
    return hashlib.sha256(f"sentencepiece {sentencepiece.__version__}\0".encode() + model).hexdigest()


def _count(model_path: str):
    def run(batches):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        for batch in batches:
            texts, counts = batch.column("text"), []
            for k in range(0, len(texts), CALL):
                counts += map(len, model.encode(texts[k:k + CALL].to_pylist(), num_threads=1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])
    return run


def read_cache(spark: SparkSession, cache_path: str, version: str) -> DataFrame:
    """(digest, n_tokens) of one tokenizer version; empty if nothing is stored.
    A digest that two runs appended at once counts once."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(cache_path)
    if not jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    return (spark.read.schema(CACHE_SCHEMA).parquet(cache_path).filter(F.col("tokenizer") == version)
            .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))


def count_tokens(docs: DataFrame, model_path: str, cache_path: str | None = None,
                 limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, ``n_bytes``, ``n_tokens``, ``over_limit``.

    The normalised content is the text itself with null as empty: a count
    depends on every byte, so nothing else may be folded. ``cache_path`` None
    starts from an empty cache in the shared folder. Repeated rows share one
    encoding. Other columns are not read. ``model_path`` is read in every task,
    so it must exist on each machine.
    """
    spark = docs.sparkSession
    cache_path = cache_path or fresh_path(spark, "token-cache")
    version = tokenizer_version(model_path)
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("_id"), text.alias("text"),
                        F.unhex(F.sha2(text, 256)).alias("digest"))
    misses = keyed.select("digest", "text").dropDuplicates(["digest"]).join(
        read_cache(spark, cache_path, version), "digest", "left_anti")
    (misses.mapInArrow(_count(model_path), "digest binary, n_tokens long")
     .withColumn("tokenizer", F.lit(version))
     .write.mode("append").partitionBy("tokenizer").parquet(cache_path))
    # Written, so that the join can split the rows of a text with very many copies.
    counts = written(read_cache(spark, cache_path, version), "counts")
    return keyed.select("_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest").join(
        counts, "digest").select(
        F.col("_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
