"""From raw documents to packed training sequences, in five stages.

Each stage reads what its predecessor wrote. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landgrid.llm import common, decontamination, packing, pii, simhash, toxicity
from landgrid.shared import saved
from landgrid.shipping import ship


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from ``labels``, does not reject."""
    return toxicity.without_toxic(docs, common.read(ship(spark), sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash component (3-word shingles, two bits)."""
    ship(spark)
    return simhash.deduplicated(docs, shingle=simhash.SHINGLE, distance=simhash.DISTANCE)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, neither as a copy nor with other numbers and names."""
    return decontamination.clean(docs, common.read(ship(spark), sf_dir, "benchmark"))


def with_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced in ``text``; ``n_chars`` follows where the text changed."""
    ship(spark)
    found = common.fresh(docs, "entities")
    out = pii.anonymised(docs, report=found)
    if "n_chars" in docs.columns:
        now = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.size(found) > 0, now).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences of at most 2048, a row per piece."""
    ship(spark)
    return packing.packed(docs.select("doc_id", "text"), "doc_id", with_ids=True)


STAGES = [
    ("toxicity", without_toxic),
    ("simhash_near_dedup", without_copies),
    ("benchmark_decontamination", without_benchmark),
    ("pii_surrogates", with_surrogates),
    ("packing", packed),
]

#: trained models, hashing and tokenizers have no SQL form; tests hold the pipeline against plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``; each stage's result is written and read again for the next."""
    docs = common.read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
