"""The corpus pipeline: documents in, packed training sequences out.

Each stage gets the rows that its predecessor kept, and its decisions take effect:
rejected documents and near copies go, secrets are masked in the text, rows are
dropped or repeated as the mix asks, and what is left is packed. All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.mixing import mix_documents
from starloom.llm.packing import packed
from starloom.llm.quality import keep_good
from starloom.llm.queries import BYTE_BPE, read, ship, vocabulary
from starloom.llm.secret_scan import mask_secrets
from starloom.llm.simhash import drop_near_copies
from starloom.llm.tables import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counted limits and the model trained on ``labels``."""
    ship(spark)
    return keep_good(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of fingerprints at most two bits apart, by shingles of three words."""
    ship(spark)
    return drop_near_copies(docs, shingle=3, budget=2)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    ship(spark)
    return mask_secrets(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mix_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their sequences and offsets."""
    ship(spark)
    return packed(docs, vocabulary(BYTE_BPE))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_scans", secret_scans),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]

# The classifier and the token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; each stage's result is written before the next one reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
