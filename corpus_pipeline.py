"""From documents to packed training sequences: quality, line dedup, near-dedup, decontamination, packing.

Every stage is written as Parquet to the shared folder and read again as the next one's documents. All but the last return the
columns of ``documents``; ``n_chars`` follows the text where a stage changes it. A document that loses all its lines stays, with an
empty text. What each stage does with nulls, empty and repeated rows is stated in its operator's text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.decontaminate import keep_clean
from postlens.llm.line_dedup import dedup_lines
from postlens.llm.near_dedup import keep_first
from postlens.llm.packing import pack, pieces
from postlens.llm.quality import keep_good
from postlens.llm.shared import load, materialize, session

SHINGLE_WORDS = 5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    session(spark)
    return keep_good(docs, load(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one has."""
    session(spark)
    done = dedup_lines(docs)
    return done.withColumns({"text": F.col("l_text"), "n_chars": F.length("l_text").cast("long")}).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates."""
    session(spark)
    return keep_first(docs, words=SHINGLE_WORDS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    session(spark)
    return keep_clean(docs, load(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    session(spark)
    return pack(materialize(pieces(docs), "pieces"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontaminate),
    ("packing", packing),
]

# Hashed n-gram weights and token ids have no SQL; the test compares columns, counts and ids of the stages only.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a table folder."""
    session(spark)
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-stage")
    return docs
