"""From raw documents to encoded training text, in five stages.

Each stage reads its predecessor's Parquet and returns rows with the columns of
documents; the last returns token ids.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweek.llm import bpe, exact_dedup, jaccard_join, mixing, quality_rules
from tallyweek.llm.common import shared_folder
from tallyweek.llm.queries import vocabulary_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed rules and the decision list learned from labels."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked on five-word shingles, the document with the smallest doc_id."""
    return jaccard_join.one_of_each(docs, width=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, n_tokens, ids, and whether they decode to the text."""
    coded = bpe.encode(docs.select("doc_id", "source", "lang", "text"), vocabulary_path(), verify=True)
    return coded.select("doc_id", "source", "lang", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("mixing sources", mix),
    ("BPE encoding", encode),
]

#: The first stage learns its rules, which SQL cannot; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what lies between two is a table in the session's shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
