"""The corpus pipeline: filter, deduplicate, mask and pack the documents, each stage on what the one before kept.

Every stage takes (spark, docs, sf_dir) and works on the rows of docs alone; the first reads the labels to learn from.
All but the last return the columns that they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itinera.llm.common import crc32_of, stored
from itinera.llm.minhash import keep_one
from itinera.llm.packing import pack_documents
from itinera.llm.secret_scan import mask_secrets
from itinera.llm.suffix import drop_repeats
from itinera.llm.toxicity import fit, keep_clean


def _measured(docs: DataFrame) -> DataFrame:
    """n_chars, where there is such a column, follows the changed text."""
    kinds = dict(docs.dtypes)
    return docs.withColumn("n_chars", F.length("text").cast(kinds["n_chars"])) if "n_chars" in kinds else docs


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the filter rejects go. It learns from four fifths of the labels, as the operator's query does."""
    seen = crc32_of() % 5 != 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return keep_clean(docs, fit(docs.where(seen), labels.where(seen)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings that occur more than once leave the texts; the rows stay."""
    return _measured(drop_repeats(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked; the rows stay."""
    return _measured(mask_secrets(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences, with their ids."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("secrets", secrets),
    ("packing", packing),
]

#: SQL states neither the trained filter nor the byte-level stages; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of what all stages keep of the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"stage-{name}")
    return docs
