"""Counts, means and distributions over posts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.functions.dates import as_time, hours_before, iso, normalize_datetime
from postlens.operators.common import attach, ratio



def post_date(posts: DataFrame) -> Column:
    """The time of a post's date; a date that is a time already is not read again."""
    known = isinstance(posts.schema["date"].dataType, T.TimestampType)
    return F.col("date") if known else normalize_datetime(F.col("date"))


def _source() -> Column:
    return F.nullif(F.col("source"), F.lit(""))


def content_length() -> Column:
    return F.length(F.coalesce("content", F.lit("")))


def basic_stats(posts: DataFrame, by: Sequence[str] = (), length: Column | None = None) -> DataFrame:
    """Totals, dates and mean length; ``length`` is that of the content where the posts hold none."""
    date = post_date(posts)
    return posts.groupBy(*by).agg(
        F.count("*").alias("total_articles"),
        F.coalesce(iso(F.min(date)), F.lit("Unknown")).alias("date_start"),
        F.coalesce(iso(F.max(date)), F.lit("Unknown")).alias("date_end"),
        F.avg(content_length() if length is None else length).alias("avg_content_length"),
        F.count_distinct(_source()).alias("total_unique_sources"),
    )


def source_counts(posts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    source = F.coalesce("source", F.lit("Unknown")).alias("source")
    return posts.groupBy(*by, source).agg(F.count("*").alias("n"))


def category_counts(posts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    category = F.coalesce("category", F.lit("General")).alias("category")
    return posts.groupBy(*by, category).agg(F.count("*").alias("n"))


def word_count_stats(posts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean, exact median, sample deviation and range of ``word_count``.

    The median merges counts per distinct value, and a word count has few.
    """
    w = F.col("word_count")
    return posts.groupBy(*by).agg(
        F.avg(w).alias("mean"),
        F.median(w).alias("median"),
        F.stddev_samp(w).alias("std"),
        F.min(w).alias("min"),
        F.max(w).alias("max"),
    )


def sentiment_stats(posts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean and shares over every scored post, zero scores included."""
    p = F.col("sentiment_polarity")
    return posts.where(p.isNotNull()).groupBy(*by).agg(
        F.avg(p).alias("avg_sentiment"),
        ratio(p > 0.1).alias("positive_ratio"),
        ratio(p < -0.1).alias("negative_ratio"),
        ratio(F.abs(p) <= 0.1).alias("neutral_ratio"),
    )


def _opinionated(posts: DataFrame) -> DataFrame:
    """Dated posts with a score other than zero."""
    dated = posts.where(F.col("sentiment_polarity").isNotNull() & (F.col("sentiment_polarity") != 0))
    return dated.withColumn("_date", post_date(posts)).where(F.col("_date").isNotNull())


def hourly_sentiment(posts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    p = F.col("sentiment_polarity")
    return _opinionated(posts).groupBy(*by, F.date_trunc("hour", "_date").alias("hour")).agg(
        exact_mean("sentiment_polarity").alias("avg_sentiment"),
        F.count("*").alias("article_count"),
        F.coalesce(F.stddev_samp(p), F.lit(0.0)).alias("sentiment_volatility"),
    )


def sentiment_distribution(posts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Overall mean and shares; a community without a scored, dated post is all neutral."""
    counted = (
        posts.withColumn("_date", post_date(posts))
        .withColumn(
            "_p", F.when(F.col("_date").isNotNull() & (F.col("sentiment_polarity") != 0), F.col("sentiment_polarity"))
        )
        .groupBy(*by)
        .agg(
            F.avg("_p").alias("overall_sentiment"),
            F.avg((F.col("_p") > 0.1).cast("double")).alias("_positive"),
            F.avg((F.col("_p") < -0.1).cast("double")).alias("_negative"),
            F.avg((F.abs("_p") <= 0.1).cast("double")).alias("_neutral"),
        )
    )
    return counted.select(
        *by,
        "overall_sentiment",
        F.coalesce("_positive", F.lit(0.0)).alias("positive"),
        F.coalesce("_negative", F.lit(0.0)).alias("negative"),
        F.coalesce("_neutral", F.lit(1.0)).alias("neutral"),
    )


def exact_mean(column: str) -> Column:
    """Mean of scores summed as decimals of ten places, so that it doesn't depend on the order of the rows."""
    return F.sum(F.col(column).cast("decimal(28,10)")).cast("double") / F.count(column)


def sentiment_by_source(posts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _opinionated(posts).groupBy(*by, F.coalesce("source", F.lit("Unknown")).alias("source")).agg(
        exact_mean("sentiment_polarity").alias("avg_sentiment"), F.count("*").alias("article_count")
    )


def engagement_score(posts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Score per source from volume, length and sentiment."""
    sums = posts.groupBy(*by, F.coalesce("source", F.lit("Unknown")).alias("source")).agg(
        F.count("*").alias("_n"),
        F.avg(F.coalesce("word_count", F.lit(0))).alias("_words"),
        F.coalesce(exact_mean("sentiment_polarity"), F.lit(0.0)).alias("_sentiment"),
    )
    volume = F.least(F.lit(1.0), F.col("_n") / 10)
    length = F.least(F.lit(1.0), F.col("_words") / 500)
    tone = (F.col("_sentiment") + 1) / 2
    return sums.select(*by, "source", (volume * 0.4 + length * 0.3 + tone * 0.3).alias("engagement_score"))


def has_text() -> Column:
    return (F.coalesce("content", F.lit("")) != "") | (F.coalesce("title", F.lit("")) != "")


def text_items(posts: DataFrame) -> DataFrame:
    """Posts that have a content or a title."""
    return posts.where(has_text())


def period_filter(posts: DataFrame, as_of, hours: int = 24, by: Sequence[str] = ()) -> DataFrame:
    """Posts of the last ``hours`` and those without a date.

    A community in which that leaves nothing keeps all its posts.
    """
    recent = post_date(posts) >= hours_before(as_time(as_of), hours)
    undated = F.coalesce("date", F.lit("")) == ""
    marked = posts.withColumn("_in", F.coalesce(recent, F.lit(False)) | undated)
    any_in = marked.groupBy(*by).agg(F.max("_in").alias("_any"))
    kept = attach(marked, any_in, by).where(F.col("_in") | ~F.col("_any"))
    return kept.drop("_in", "_any")


def peak_hour_of_day(posts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Busiest hour of day where more than five posts are dated; ties go to the hour seen first."""
    dated = posts.withColumn("_date", post_date(posts)).where(F.col("_date").isNotNull())
    per_hour = dated.groupBy(*by, F.hour("_date").alias("hour")).agg(
        F.count("*").alias("n"), F.min("ingest_seq").alias("_first")
    )
    best = per_hour.groupBy(*by).agg(
        F.sum("n").alias("dated_posts"),
        F.max_by("hour", F.struct("n", -F.col("_first"))).alias("peak_hour"),
        F.max("n").alias("posts_in_hour"),
    )
    return best.where(F.col("dated_posts") > 5).select(*by, "peak_hour", "posts_in_hour", "dated_posts")


def storage_stats(raw: DataFrame, analyses: DataFrame, recommendations: DataFrame) -> DataFrame:
    """Rows (statistic, source, n) over the stored tables."""
    no_source = F.lit(None).cast("string").alias("source")
    n = F.count("*").alias("n")
    return (
        raw.agg(n).select(F.lit("total_raw_records").alias("statistic"), no_source, "n")
        .unionByName(raw.groupBy("source").agg(n).select(F.lit("records_by_source").alias("statistic"), "source", "n"))
        .unionByName(analyses.agg(n).select(F.lit("total_analyses").alias("statistic"), no_source, "n"))
        .unionByName(recommendations.agg(n).select(F.lit("total_recommendations").alias("statistic"), no_source, "n"))
    )
