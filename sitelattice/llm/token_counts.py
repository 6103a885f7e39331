"""Operator 8 - token counts through a digest cache.

Every text is named by the SHA-256 of its content, every tokenizer by the
SHA-256 of its file and its library's version. Counts already stored under both digests are joined in; each
distinct remaining text is encoded once and appended to the cache.

Texts are moved once: distinct texts are gathered by digest with a map-side
partial aggregate, so a text that holds a third of all rows reaches its task once
per map task. The anti-join against the cache and the encoding reuse that
partitioning. The join that hands the counts back moves digests only, never
texts, and adaptive execution may split it.

Nulls: a null text counts as empty (0 bytes, 0 tokens). A null doc_id stays null.
Repeated rows each give a row. An empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, encoding

CACHE_SCHEMA = "digest binary, version string, n_tokens long"


def read_cache(spark: SparkSession, path: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer version; none if nothing is stored yet."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], CACHE_SCHEMA)
    # A job lost between append and commit may be run again: the same digest can be stored twice.
    return (
        spark.read.schema(CACHE_SCHEMA).parquet(path).where(F.col("version") == version)
        .groupBy("digest", "version").agg(F.max("n_tokens").alias("n_tokens"))
    )


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per row of ``docs``.

    ``cache`` is a folder all executors share; what is missing there is appended
    before this returns.
    """
    spark = docs.sparkSession
    common.bounded_batches(spark)
    version = encoding.version(tokenizer)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    distinct = rows.select("digest", "text").dropDuplicates(["digest"])
    stored = read_cache(spark, cache, version)
    missing = distinct.join(stored, "digest", "left_anti")

    def encode(batches):
        lengths = encoding.encoder(tokenizer).lengths
        for b in batches:
            counts = lengths(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column("digest"), pa.array([version] * len(counts), pa.string()), pa.array(counts, pa.int64())],
                ["digest", "version", "n_tokens"],
            )

    missing.mapInArrow(encode, CACHE_SCHEMA).write.mode("append").parquet(cache)
    counts = read_cache(spark, cache, version).select("digest", "n_tokens")
    return (
        rows.select("id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
        .join(counts, "digest")
        .select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all documents. The cache is new for each call, so that a call's
    figures are those of a first run; pass a lasting folder to ``count_tokens``
    to keep it."""
    return count_tokens(common.table(spark, sf_dir, "documents"), encoding.default_path(), common.new_path(spark, "token-counts"))
