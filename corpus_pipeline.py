"""The corpus pipeline: from ``documents`` to packed training sequences.

Stages, in order: documents that the quality classifier rejects go; of each group of
near-duplicates one document stays; documents contaminated with benchmark passages go;
personal data get surrogates; what is left is packed. Each stage is written as Parquet
and read back before the next; then the tables it was made from are deleted, so no more
than two copies of the documents stand at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelattice.llm import common, decontaminate, encoding, packing, pii, quality, simhash


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, common.table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_documents(docs, common.table(spark, sf_dir, "benchmark"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``n_chars`` follows the new text."""
    new = pii.surrogates(docs)
    if "n_chars" not in docs.columns:
        return new
    counted = F.length("text").cast(docs.schema["n_chars"].dataType)
    return new.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), counted))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, encoding.default_path())


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("PII surrogates", private),
    ("best-fit packing", packed),
]
#: SQL cannot express the classifier or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order."""
    docs, before = common.table(spark, sf_dir, "documents"), common.written()
    for i, (_, stage) in enumerate(STAGES):
        path = common.new_path(spark, f"stage-{i}")
        docs = common.persist_table(stage(spark, docs, sf_dir), f"stage-{i}", path)
        common.drop_written(spark, before, (path,))
    return docs
