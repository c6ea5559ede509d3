"""From raw documents to packed sequences: five stages, each stored before the next.

Every stage takes (spark, docs, sf_dir); all but the last return the columns of
``docs``, whatever they are called. A decision is for a row by its doc_id and text: where
an id repeats with another text, only the row that is rejected goes. Rows that repeat
both share their fate. A null doc_id gives way to any other; an empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import row_hash, table
from millrace.llm.dedup_exact import exact_dedup
from millrace.llm.near_dup import near_duplicates
from millrace.llm.packing import pack_documents
from millrace.llm.quality import classify, trusted_ids
from millrace.llm.secrets import redact


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows (doc_id, row) of ``dropped``."""
    gone = dropped.select(F.col("doc_id").alias("id"), "row").distinct().alias("gone")
    rows = docs.alias("docs")
    named = row_hash(F.col("docs.doc_id"), F.col("docs.text"))
    return rows.join(gone, F.col("docs.doc_id").eqNullSafe(F.col("gone.id")) & (named == F.col("gone.row")), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Kneser-Ney classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _without(docs, classify(docs, trusted_ids(labels), with_row=True).where("NOT kept"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest doc_id stays."""
    return _without(docs, exact_dedup(docs, with_row=True).where("NOT kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the smallest doc_id stays."""
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return _without(docs, near_duplicates(docs, with_row=True).where(~stays))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; all documents stay."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("secret scans", secrets),
    ("packing", packing),
]

#: The classifier, the tokenizer and the packing can't be put in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
