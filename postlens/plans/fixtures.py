"""Posts derived from the driver tables, the input of the registered queries.

A post is an event with the document of the same number as its text. An event
without a document is a post without text, and a document without an event one
without a time, so that every row of both tables is there. NULLs, date formats
and user names vary with the number so that every rule is exercised.
"""

from __future__ import annotations

import datetime as dt
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions import text as X
from postlens.session import configure

PLATFORMS = ["reddit", "twitter", "linkedin", "quora"]


TEXT_TABLES = {"documents", "pages", "conversations"}


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A driver table; a text table with fewer splits than cores is spread over the cores."""
    configure(spark)
    read = spark.read.parquet(f"{directory}/{name}.parquet")
    return spread(read) if name in TEXT_TABLES else read


def spread(df: DataFrame) -> DataFrame:
    """Give each core a share of an input too small to have a split for each.

    Text work is bound by processors. An input with as many splits as cores,
    as any large one has, is left as it is and is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def _platform() -> Column:
    return F.element_at(F.array(*[F.lit(p) for p in PLATFORMS]), (F.col("user_id") % 4 + 1).cast("int"))


def _tags() -> Column:
    return F.array(
        F.concat(F.lit("#"), "event_type"), F.concat(F.lit("#t"), (F.col("user_id") % 25).cast("string"))
    )


def _polarity() -> Column:
    return F.round(F.least(F.lit(1.0), (F.col("value") - 50) / 100), 4)


def _event_time() -> Column:
    return F.col("ts").cast("timestamp")


def posts(spark: SparkSession, directory: str) -> DataFrame:
    documents = table(spark, directory, "documents")
    events = table(spark, directory, "events")
    joined = documents.join(events, documents.doc_id == events.event_id, "full")
    n = F.coalesce("doc_id", "event_id")
    number = n.cast("string")
    t = _event_time()
    user = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    anonymous = n % 10 == 9
    date = (
        F.when(n % 50 == 11, "n/a")
        .when(n % 4 == 0, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(n % 4 == 1, F.date_format(t, "yyyy-MM-dd HH:mm:ss"))
        .when(n % 4 == 2, F.concat(F.date_format(t, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000")))
    )
    suffix = F.when(n % 3 == 0, "").when(n % 3 == 1, "Z").otherwise("+02:00")
    body = F.concat(
        F.col("text"), F.lit(" #"), F.col("event_type"), F.lit(" @"), user, F.lit(" https://ex.org/"), number
    )
    return joined.select(
        n.alias("ingest_seq"),
        number.alias("post_id"),
        F.when(n % 37 != 5, F.col("source")).alias("source"),
        _platform().alias("platform"),
        F.when(n % 6 != 1, F.col("event_type")).alias("category"),
        F.when(n % 40 != 7, F.array_join(X.first_words(F.col("text"), 8), " ")).alias("title"),
        F.when(n % 45 != 3, body).alias("content"),
        F.concat(F.when(n % 50 == 0, "ftp").otherwise("https"), F.lit("://ex.org/"), number).alias("url"),
        F.when(anonymous, "anonymous").otherwise(user).alias("author"),
        F.when(anonymous, "anonymous").when(n % 3 != 0, user).alias("username"),
        t.alias("event_time"),
        date.alias("date"),
        F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), suffix).alias("created_at"),
        F.lit(None).cast("string").alias("timestamp"),
        F.col("value").cast("long").alias("likes"),
        F.get_json_object("props", "$.k").cast("long").alias("comments"),
        (n % 7).alias("shares"),
        F.lit(None).cast("long").alias("retweets"),
        _tags().alias("hashtags"),
        F.when(n % 10 == 0, 0.0).otherwise(_polarity()).alias("sentiment_polarity"),
    )


def _next_hour(events: DataFrame) -> dt.datetime:
    """The full hour after the newest event: one figure, read once and then a literal in every plan."""
    newest = events.agg((F.date_trunc("hour", F.max(_event_time())) + F.expr("INTERVAL 1 HOUR")).alias("t"))
    seconds = newest.select(F.unix_timestamp("t")).first()[0]
    return dt.datetime.fromtimestamp(seconds or 0, tz=dt.timezone.utc)


@lru_cache(maxsize=64)
def as_of(spark: SparkSession, directory: str) -> dt.datetime:
    return _next_hour(table(spark, directory, "events"))


def counted_posts(spark: SparkSession, directory: str) -> DataFrame:
    """Posts with the word count of their raw content, which statistics read."""
    return posts(spark, directory).withColumn("word_count", X.word_count(F.col("content")))


def tagged_events(spark: SparkSession, directory: str) -> DataFrame:
    """Every event as a tagged post; the user's nation is the country."""
    events = table(spark, directory, "events")
    customers = table(spark, directory, "customer").select("c_custkey", F.col("c_nationkey").alias("country"))
    tagged = events.select(
        "event_id",
        "user_id",
        _event_time().alias("event_time"),
        _tags().alias("hashtags"),
        _platform().alias("platform"),
        _polarity().alias("sentiment_polarity"),
        (F.get_json_object("props", "$.k").cast("double") / 1000).alias("engagement_rate"),
    )
    return tagged.join(customers, tagged.user_id == customers.c_custkey, "left").drop("c_custkey")
