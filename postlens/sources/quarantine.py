"""Landed JSON records, split into payload rows and a quarantine of those that don't fit.

A record that is no JSON, is cut off, or has a field of another type than the payload's gives no post; it is kept with its file, its place and
the reason, so that it can be mended and landed again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.session import materialize

CORRUPT = "_corrupt"
MALFORMED, WRONG_TYPE, NO_OBJECT = "malformed", "wrong type", "no object"


def landed_records(spark: SparkSession, path: str) -> DataFrame:
    """(ingest_seq, file, split_start, value): the lines of landed files that aren't blank; a line with an array is one record for each element."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split_start"))
    return as_records(lines).withColumn("ingest_seq", F.monotonically_increasing_id())


def as_records(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines as records: blank ones left out, arrays taken apart where they are whole."""
    text = F.trim(column)
    parts = F.when(text.startswith("["), F.from_json(text, "array<string>"))
    each = F.explode(F.when(F.size(parts) >= 0, parts).otherwise(F.array(F.col(column))))
    return lines.where(text != "").withColumn(column, each)


def split_records(records: DataFrame, schema: str, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(payload, quarantine) of records; both keep the columns that the records have beside their text.

    The parser is given the whole schema in both, so a result that reads few columns doesn't judge fewer fields.
    """
    others = [c for c in records.columns if c != column]
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = records.withColumn("_p", F.from_json(column, f"{schema}, {CORRUPT} string", options))
    sound = F.col("_p").isNotNull() & F.col("_p")[CORRUPT].isNull() & F.trim(column).startswith("{")
    good = parsed.where(sound).select(*others, "_p.*").drop(CORRUPT)
    is_json = F.try_parse_json(column).isNotNull()
    reason = F.when(~is_json, MALFORMED).when(~F.trim(column).startswith("{"), NO_OBJECT).otherwise(WRONG_TYPE)
    bad = parsed.where(~F.coalesce(sound, F.lit(False))).select(*others, F.col(column).alias("record"), reason.alias("reason"))
    return good, bad


def quarantine(spark: SparkSession, path: str, schema: str, source: str) -> DataFrame:
    """(source, file, split_start, ingest_seq, record, reason) of the landed records that give no payload row."""
    return split_records(landed_records(spark, path), schema)[1].select(
        F.lit(source).alias("source"), "file", "split_start", "ingest_seq", "record", "reason"
    )


def collect_sources(readers: dict[str, Callable[[], DataFrame]], log: Callable[[str], None] | None = None) -> list[DataFrame]:
    """The sources' posts, each read and stored by jobs of its own; one that fails, even while its files are read, is logged and skipped."""
    frames = []
    for name, read in readers.items():
        try:
            frames.append(materialize(read(), f"source-{name}"))
        except Exception as error:  # whatever is wrong with one source must not end the others
            if log is not None:
                log(f"source {name} skipped: {error}")
    return frames
