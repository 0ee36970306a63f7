"""A training corpus in five stages, from the table of documents to token ids.

Each stage takes the documents that the one before it kept, as reread from Parquet. All stages but the last
return the columns of documents; they work on whole texts (but see source_mix) and see nothing but their own input.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lernspur.llm import decontam, mixing, ngramjoin, quality, tokenfile
from lernspur.runtime import table_root

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling rejects go."""
    return quality.keep_good(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    return ngramjoin.one_of_each(docs.select(COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, re-parameterised or not, go."""
    return decontam.without_leaks(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    In the last pass over a source, the document at its target is cut after its last word taken, with single
    spaces between its words. Documents without words, null texts included, are not taken. So targets are met to the word.
    """
    return mixing.mixed_documents(docs.select(COLUMNS)).select(COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids, written and read back: doc_id, start, n_tokens, ids_crc32."""
    return tokenfile.token_table(docs.select(COLUMNS), tokenfile.default_tokenizer())


STAGES = [
    ("quality_filter", quality_filter),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each but the last stored below the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{table_root(spark)}/lernspur-pipeline/{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{base}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


# Tokens and models are beyond SQL. Tests hold what each stage keeps against its operator's own report, and the operators
# against brute force.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLE_SQL_BY_NAME = {}
