"""Helpers of the operators: the shared folder as tasks see it, texts, documents' order."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.session import configure, materialize, work_folder

# [\x20\x09-\x0D], the white space of the word and line rules.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LAST = (1 << 63) - 1

__all__ = ["configure", "materialize", "work_folder"]


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_or_empty(column: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(column: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(column, UPPER, LOWER)


def ordered_id(column: str = "doc_id") -> Column:
    """The id, with a null id after every other one."""
    return F.coalesce(F.col(column), F.lit(LAST))


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder in the shared store and the path within it, in a task or on the driver."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def unique_name(prefix: str, suffix: str) -> str:
    """A file name no other attempt of the task uses; only names that a committed manifest lists count."""
    return f"{prefix}-{uuid.uuid4().hex}{suffix}"


def packed(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    """A record batch of lists in the schema's order."""
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def session(spark: SparkSession) -> SparkSession:
    """The package's settings, and Arrow batches small enough for long texts."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    return spark
