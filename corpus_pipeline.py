"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; ``run`` writes what a
stage returns as Parquet in the shared folder and rereads it as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sablefin.llm import mixing, packing, quality, secrets, simhash
from sablefin.llm.token_kernel import default_path
from sablefin.session import forget, settle, settled_paths, ship


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality rules keep."""
    return quality.good(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.dedup(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, credentials masked in their texts."""
    return secrets.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences."""
    return packing.pack(docs, default_path())


STAGES = [
    ("quality rules", good_quality),
    ("simhash near-dedup", one_of_each_group),
    ("secret scans", without_secrets),
    ("source mixing", mixed),
    ("best-fit packing", packed),
]

#: Tokenization can't be stated in SQL; tests/llm checks run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in a row over ``documents``. What a stage wrote for itself, and its input, go once its result is written."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        before = len(settled_paths(spark))
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = settle(docs, f"stage-{k}")
            own = settled_paths(spark)[before:-1]
            forget(spark, [*settled_paths(spark)[before - 1 : before], *own] if k else own)
    return docs
