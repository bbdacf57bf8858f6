"""Training-corpus pipeline over ``documents``: five stages, each an operator of ``dqflow.llm``.

Every stage works on all that the one before kept, is written as Parquet to the shared folder and
read again, so a lost executor costs at most the stage at work.  All but the last return the
columns of ``documents``; texts that a stage changes get a new ``n_chars``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqflow.llm import byte_bpe, decontamination, pii, quality, simhash
from dqflow.session import scratch_path
from dqflow.sources.reader import read_table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose perplexity is above their language's threshold."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints."""
    return simhash.keep_one(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without benchmark passages; documents that are mostly such passages go."""
    return _measured(decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark")))


def no_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Entities replaced by surrogates."""
    return _measured(pii.pseudonymise(docs).select(*docs.columns))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens) of each document."""
    ids = byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return ids.withColumn("n_tokens", F.size("ids").cast("long"))


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", no_benchmark),
    ("personal_data", no_personal_data),
    ("byte_bpe", encoded),
]

#: SQL can express neither the language model nor the merges; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
