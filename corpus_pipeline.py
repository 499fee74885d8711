"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns documents; all but the last return the
columns of the documents table. ``run`` applies them in order, each over all that the one
before kept, with what it kept written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.llm.common import table
from starledger.llm.mixing import replicate, shuffled
from starledger.llm.near_dedup import keep_one
from starledger.llm.packing import pack_documents
from starledger.llm.quality_rules import keep_good
from starledger.llm.queries import tokenizer_path
from starledger.llm.secrets import redact
from starledger.session import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the threshold table."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: one with the smallest id. Five words, 0.8 or more."""
    return keep_one(docs, width=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, secrets replaced by a mark, ``n_chars`` counted again."""
    clean = redact(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their target weights, shuffled."""
    return shuffled(replicate(docs, ["doc_id"])).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences with their places."""
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL has no tokenizer. Tests compare near_duplicates and secret_scan with plain Python, not all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{name}")
    return docs
