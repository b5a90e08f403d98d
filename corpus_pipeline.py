"""Corpus pipeline: toxicity, language ID, exact dedup, near-dedup, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept; its result is written as Parquet in the shared folder and
read again as the next one's ``docs``.  All but the last return the columns of
``documents``.  The models are learned from the stage's own input, outside the
folds that the numbered queries hold out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import exact_dedup, langid, packing, simhash, toxicity
from tessera.llm.common import read_table, remove_folder, shared_path

PACKING = packing.PackParams()


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier flags go; null and empty texts are judged like others."""
    labels = read_table(spark, sf_dir, "labels").filter(F.coalesce(toxicity.fold() != 2, F.lit(False)))
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.filter(~F.col("toxic_flag")).select(*docs.columns)


def reject_unclear_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters (null and empty too) or with a narrow margin go."""
    train = docs.filter(F.coalesce(langid.fold() != 0, F.lit(False)))
    return langid.identify(docs, train).filter("lang_reliable").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays."""
    return exact_dedup.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by SimHash the smallest doc_id stays."""
    return simhash.dedup(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length buckets and batches of what is left: one row per document."""
    return packing.packed(docs, PACKING).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", reject_toxic),
    ("language_id", reject_unclear_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]

#: SQL cannot express the classifiers and the fingerprints; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; a stage's folder goes once the next one's is written, and the last one's stays."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        result = stage(spark, docs, sf_dir)
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if before:
            remove_folder(spark, before)
        before = path
    return docs


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
