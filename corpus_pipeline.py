"""A training-data pipeline over ``documents``: five stages, each an operator of textloom.llm.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet
and read again as the next stage's ``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textloom.llm.bpe import bpe_digest
from textloom.llm.exact_dedup import drop_exact_copies
from textloom.llm.mixing import mix_documents
from textloom.llm.ngram_join import drop_near_copies
from textloom.llm.quality_rules import filter_quality
from textloom.session import materialize, table

TOKENIZER = "byte_bpe_50k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules accept."""
    return filter_quality(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose texts agree but for white space."""
    return drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class linked by five-word shingles at a similarity of 0.8."""
    return drop_near_copies(docs, width=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents repeated as often as they are taken."""
    return mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded from them, a row for each row."""
    import public_tokenizers

    return bpe_digest(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("mixing sources", mix),
    ("BPE encoding and decoding", encode),
]

#: The rules' estimation, the links' components and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline-{k}")
    return docs
