"""Streams over landed post files.

The jobs run under any trigger; ``availableNow`` with an outside timer gives
the periodic form. State and offsets live in the checkpoint location, which on
a cluster is shared storage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postlens.functions import text as X
from postlens.functions.dates import first_written, normalize_datetime
from postlens.operators.dedup import dedupe_exact
from postlens.plans.cycle import run_cycle
from postlens.schema import ddl
from postlens.session import materialize
from postlens.streaming.seen import BUCKETS, SeenHashes

LATENESS = "2 hours"


def read_post_stream(spark: SparkSession, path: str, schema: str | None = None, files_per_batch: int = 1000) -> DataFrame:
    """New JSON files of a folder as a stream, under the canonical schema."""
    return (
        spark.readStream.schema(schema or ddl()).option("maxFilesPerTrigger", files_per_batch).json(path)
    )


def with_event_time(posts: DataFrame, when: Column | None = None) -> DataFrame:
    """Event time from the post's date, else from the time it was written."""
    written = first_written(F.col("created_at"), F.col("timestamp"), F.col("date"))
    return posts.withColumn("event_time", F.coalesce(normalize_datetime(F.col("date")), written) if when is None else when)


def hourly_buckets(posts: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Posts and mean non-zero sentiment per hour; a finished hour is emitted once.

    The state holds one row per open hour.
    """
    scored = F.when(F.col("sentiment_polarity") != 0, F.col("sentiment_polarity"))
    windowed = posts.withWatermark("event_time", lateness).groupBy(F.window("event_time", "1 hour"))
    return windowed.agg(F.count("*").alias("posts"), F.avg(scored).alias("avg_sentiment")).select(
        F.col("window.start").alias("hour"), "posts", "avg_sentiment"
    )


def dedupe_stream(posts: DataFrame, key: str = "content", lateness: str = LATENESS) -> DataFrame:
    """The first post of each content hash within the lateness; the state holds hashes only for that long."""
    hashed = posts.where(F.coalesce(key, F.lit("")) != "").withColumn("content_hash", X.content_hash(F.col(key)))
    return hashed.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(["content_hash"])


def run_dedupe(
    stream: DataFrame, path: str, checkpoint: str, key: str = "content", order: str = "ingest_seq", buckets: int = BUCKETS
) -> StreamingQuery:
    """The first post of each content hash over all batches, however far apart they are.

    Kept posts are a table with a folder per batch. Their hashes are kept beside the stream's own state, see ``streaming.seen``: a batch reads
    those that it may meet, not all that were ever kept. A batch that is run again after a failure looks at the batches before it and
    replaces its own folders. Where copies come within a known time, ``dedupe_stream`` needs no such history.
    """

    def keep_new(batch: DataFrame, number: int) -> None:
        landed = materialize(batch, "batch")
        firsts = dedupe_exact(landed, key, order).withColumn("content_hash", X.content_hash(F.col(key)))
        fresh = materialize(firsts, "batch-firsts")
        seen = SeenHashes(batch.sparkSession, f"{checkpoint}/seen", buckets)
        unseen = materialize(seen.unseen(fresh, number), "unseen-hashes")
        fresh.join(unseen, "content_hash", "left_semi").write.mode("overwrite").parquet(f"{path}/batch={number}")
        seen.add(unseen, number)

    return (
        stream.writeStream.foreachBatch(keep_new)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_available(
    stream: DataFrame, path: str, checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Process what has landed and stop; results go to Parquet files."""
    return (
        stream.writeStream.outputMode(mode)
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def run_cycles(
    stream: DataFrame,
    as_of: Callable[[DataFrame], object],
    analyses_path: str,
    recommendations_path: str,
    checkpoint: str,
    near: bool = True,
) -> StreamingQuery:
    """A full cycle over the new posts of each batch.

    The analysis id holds the batch number, so a batch that is run again after
    a failure replaces its own analysis and recommendations.
    """

    def cycle(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        run_cycle(
            batch,
            as_of(batch),
            analyses_path,
            recommendations_path,
            near=near,
            analysis_id=f"analysis_batch_{number}",
        )

    return (
        stream.writeStream.foreachBatch(cycle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
