"""The corpus pipeline: rows of ``documents`` in, packed token sequences out.

Each stage works on all rows that the one before it kept, and hands on the columns of
``documents`` (the last one: pieces of documents with their place in a sequence).

Defined results, by each stage's operator: a null text is empty; an empty or very long text is
treated whole like any other; rows that repeat are each judged, and near_dedup keeps one of
them; rows without an id or a source are treated like others; an empty table gives an empty
table; further columns, whatever their names, are handed on unchanged by all stages but the
last, which does not read them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, hostrules, packing, secrets, simhash
from tidemark.llm.common import saved


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the quality rules and the hosts' verdicts reject.

    A null or empty text has no words and goes; a row without a source is judged by the hard
    rules alone.
    """
    return hostrules.kept(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of each near-duplicate group that has the smallest id.

    Texts without words are one group; of rows that share the smallest id one stays.
    """
    return simhash.one_per_component(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold passages of the benchmark.

    A text without words holds none; an empty benchmark drops nothing.
    """
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in the texts; every document stays, a null text as null."""
    return secrets.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each document, packed into sequences; an empty text is its end id alone."""
    return packing.pack_documents(docs).select(
        F.col("id").alias("doc_id"),
        "piece",
        "start",
        "length",
        F.col("crc32").alias("ids_crc32"),
        "sequence_id",
        "offset",
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("pack", pack),
]

#: SQL has no tokenizer, no XXH64 and no recursive decoding: tests hold the rows
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order; each one's rows are written and read back."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
