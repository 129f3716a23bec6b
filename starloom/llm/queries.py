"""One registered query for each operator, over its whole table and with production parameters."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

import starloom
from starloom.llm.centroids import centroid_clusters, clusters_with_inertia
from starloom.llm.huffman import read_ids, write_ids
from starloom.llm.languages import identified
from starloom.llm.mixing import mixed
from starloom.llm.oracle import ORACLE  # noqa: F401
from starloom.llm.packing import packed
from starloom.llm.pseudonyms import pseudonymised
from starloom.llm.quality import quality
from starloom.llm.runs import periodic_runs, planted, run_digest
from starloom.llm.secret_scan import secret_digest
from starloom.llm.simhash import near_classes
from starloom.llm.token_counts import token_counts
from starloom.llm.topk import top_k
from starloom.llm.toxicity import toxicity
from starloom.session import new_folder

# Bytes of a record batch between Spark and Python; a few of them are in memory at a time in each task.
BATCH_BYTES = str(8 << 20)

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file; it is installed alike on all machines."""
    import public_tokenizers

    return public_tokenizers.path(name)


def ship(spark: SparkSession) -> None:
    """Give this package to the session's Python workers, once per session, and bound the batches that they get."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    if getattr(spark.sparkContext, "_starloom_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(starloom.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="starloom-code-"), "starloom_code.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    archive.write(file, os.path.join("starloom", os.path.relpath(file, top)))
    spark.sparkContext.addPyFile(path)
    spark.sparkContext._starloom_shipped = True


def registered(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    QUERIES[query.__name__] = run
    return run


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@registered
def op1_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymised(read(spark, sf_dir, "documents"), key="a key for tests; real ones come from a vault")


@registered
def op2_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "huffman")
    write_ids(read(spark, sf_dir, "documents"), path, vocabulary(BYTE_BPE))
    return read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@registered
def op3_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read(spark, sf_dir, "documents"), vocabulary(BYTE_BPE))


@registered
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(read(spark, sf_dir, "documents"))


@registered
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(read(spark, sf_dir, "documents"))


@registered
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"), vocabulary(WORD_BPE))


@registered
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@registered
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@registered
def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")


@registered
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_classes(read(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


@registered
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digest(periodic_runs(planted(read(spark, sf_dir, "documents"))))


@registered
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters_with_inertia(centroid_clusters(read(spark, sf_dir, "embeddings"), k=16, rounds=3, width=64, scale=64, seed=1))


@registered
def op13_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identified(read(spark, sf_dir, "documents"))
