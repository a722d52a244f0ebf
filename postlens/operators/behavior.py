"""Community health, content and user behaviour, competition, anomalies, forecasts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens import constants as C
from postlens.functions import text as X
from postlens.functions.dates import hour_key, posted_at
from postlens.operators.common import attach, engagement, place, post_place, top_rows
from postlens.session import small_table

LENGTH_BUCKETS = ["short (0-100)", "medium (101-300)", "long (301+)"]


def _reactions() -> Column:
    return engagement("likes", "comments", "shares")


def _content() -> Column:
    return F.coalesce("content", F.lit(""))


def _post_time() -> Column:
    return posted_at(F.col("timestamp"), F.col("created_at"))


def community_health(posts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    sums = posts.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.coalesce(F.avg(_reactions()), F.lit(0.0)).alias("engagement_rate"),
        F.coalesce(F.avg(F.when(_content() != "", F.col("sentiment_polarity"))), F.lit(0.0)).alias("sentiment_score"),
    )
    level = F.when(F.col("n") > 100, "high").when(F.col("n") > 50, "medium").otherwise("low")
    score = (
        F.least(F.col("engagement_rate") / 10, F.lit(40.0))
        + (F.col("sentiment_score") + 1) * 15
        + F.least(F.col("n") / 10, F.lit(30.0))
    )
    return sums.select(
        *by,
        "engagement_rate",
        "sentiment_score",
        level.alias("activity_level"),
        F.when(F.col("n") == 0, 0.0).otherwise(score).alias("health_score"),
    )


def top_content(posts: DataFrame, n: int = 10, by: Sequence[str] = ()) -> DataFrame:
    likes, comments, shares = (F.coalesce(c, F.lit(0)) for c in ("likes", "comments", "shares"))
    scored = posts.select(
        *by,
        "ingest_seq",
        X.excerpt(F.col("content")).alias("excerpt"),
        (likes + comments * 2 + shares * 3).alias("score"),
        *([] if "source" in by else [F.coalesce("source", F.lit("unknown")).alias("source")]),
        likes.alias("likes"),
        comments.alias("comments"),
        shares.alias("shares"),
    )
    return top_rows(scored, n, [F.desc("score"), F.asc("ingest_seq")], by)


def length_buckets(posts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean reactions and count per length bucket; an empty bucket is a row of zeros."""
    length = F.length(_content())
    names = [F.lit(name) for name in LENGTH_BUCKETS]
    limits = [length <= 100, (length > 100) & (length <= 300), length > 300]
    sums = posts.groupBy(*by).agg(
        F.array(
            *[
                F.struct(
                    name.alias("length_range"),
                    F.coalesce(F.avg(F.when(limit, _reactions())), F.lit(0.0)).alias("average_score"),
                    F.count_if(limit).alias("count"),
                )
                for name, limit in zip(names, limits)
            ]
        ).alias("buckets")
    )
    return sums.select(*by, F.inline("buckets"))


def hashtag_performance(posts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    tagged = posts.select(*by, F.explode("hashtags").alias("hashtag"), _reactions().alias("score"))
    return tagged.groupBy(*by, "hashtag").agg(
        F.avg("score").alias("average_score"), F.count("*").alias("usage_count"), F.sum("score").alias("total_score")
    )


def _named_users(posts: DataFrame) -> DataFrame:
    user = F.coalesce("username", "author", F.lit("anonymous"))
    return posts.withColumn("user", user).where(F.col("user") != "anonymous")


def unique_users(posts: DataFrame, by: Sequence[str] = (), approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return _named_users(posts).groupBy(*by).agg(count(F.col("user")).alias("total_unique_users"))


def top_users(posts: DataFrame, n: int = 10, by: Sequence[str] = ()) -> DataFrame:
    counts = _named_users(posts).groupBy(*by, "user").agg(
        F.count("*").alias("posts"), F.min("ingest_seq").alias("_first")
    )
    return top_rows(counts, n, [F.desc("posts"), F.asc("_first")], by).drop("_first")


def _counts_of(posts: DataFrame, part: Column, name: str, by: Sequence[str]) -> DataFrame:
    timed = posts.withColumn("_time", _post_time()).where(F.col("_time").isNotNull())
    return timed.groupBy(*by, part.alias(name)).agg(F.count("*").alias("posts"), F.min("ingest_seq").alias("_first"))


def peak_hours(posts: DataFrame, n: int = 5, by: Sequence[str] = ()) -> DataFrame:
    counts = _counts_of(posts, F.hour("_time"), "hour", by)
    return top_rows(counts, n, [F.desc("posts"), F.asc("_first")], by).drop("_first")


def peak_days(posts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    counts = _counts_of(posts, F.date_format("_time", "EEEE"), "weekday", by)
    return top_rows(counts, 7, [F.desc("posts"), F.asc("_first")], by).drop("_first")


def competitor_mentions(
    posts: DataFrame, names: Sequence[str] = tuple(C.COMPETITORS), by: Sequence[str] = ()
) -> DataFrame:
    """Substring count of each name; names that never occur are left out."""
    lowered = F.lower(_content())
    per_post = F.array(
        *[
            F.struct(F.lit(n).alias("competitor"), X.occurrences(lowered, F.lit(n.lower())).cast("long").alias("hits"))
            for n in names
        ]
    )
    hits = posts.select(*by, F.inline(per_post)).where(F.col("hits") > 0)
    return hits.groupBy(*by, "competitor").agg(F.sum("hits").alias("mentions"))


def _first_holders(posts: DataFrame, names: Sequence[str], n: int, by: Sequence[str]) -> DataFrame:
    """Posts, marked in ``_upto`` up to the ``n``-th of which a word holds a name; each such post gives a context at least."""
    lowered = F.lower(_content())
    holds = F.lit(False)
    for name in names:
        if not any(c.isspace() for c in name):  # no word holds white space
            holds = holds | (lowered.contains(name.lower()) if name else lowered.rlike(C.NOT_SPACE))
    first = top_rows(posts.where(holds).select(*by, "ingest_seq"), n, [F.asc("ingest_seq")], by)
    last = first.groupBy(*by).agg(F.max("ingest_seq").alias("_last"))
    upto = F.col("ingest_seq").isNull() | (F.col("ingest_seq") <= F.col("_last"))
    return attach(posts, last, by).withColumn("_upto", upto).drop("_last")


def competitor_contexts(
    posts: DataFrame, names: Sequence[str] = tuple(C.COMPETITORS), n: int = 20, reach: int = 3, by: Sequence[str] = ()
) -> DataFrame:
    """The words around each word that holds a name: post, name, then word order.

    Only the first ``n`` posts that hold a name, and those of the same number as the last of them, are split into words.
    """
    held = _first_holders(posts, names, n, by)
    lowered = held.select(*by, "ingest_seq", F.when(F.col("_upto"), X.words(F.lower(_content()))).alias("_words"))

    def around(name: str, order: int) -> Column:
        found = F.filter(
            F.transform(
                F.col("_words"),
                lambda w, i: F.struct(
                    F.lit(order).alias("name_order"), F.lit(name).alias("competitor"), i.alias("position"), w.alias("w")
                ),
            ),
            lambda e: e["w"].contains(name.lower()),
        )
        return F.transform(
            found,
            lambda e: F.struct(
                e["name_order"].alias("name_order"),
                e["competitor"].alias("competitor"),
                e["position"].alias("position"),
                F.array_join(
                    F.slice(
                        F.col("_words"),
                        F.greatest(e["position"] - reach + 1, F.lit(1)),
                        F.least(e["position"], F.lit(reach)) + reach + 1,
                    ),
                    " ",
                ).alias("context"),
            ),
        )

    hits = lowered.select(*by, "ingest_seq", F.inline(F.concat(*[around(c, i) for i, c in enumerate(names)])))
    order = [F.asc("ingest_seq"), F.asc("name_order"), F.asc("position")]
    return top_rows(hits, n, order, by).select(*by, "rank", "ingest_seq", "competitor", "context")


def activity_spikes(posts: DataFrame, by: Sequence[str] = (), deviations: float = 2.0) -> DataFrame:
    """Hours whose count lies more than two population deviations above the mean hour."""
    timed = posts.withColumn("_time", _post_time()).where(F.col("_time").isNotNull())
    hours = timed.groupBy(*by, hour_key(F.col("_time")).alias("hour")).agg(F.count("*").alias("count"))
    shape = hours.groupBy(*by).agg(F.avg("count").alias("_mean"), F.stddev_pop("count").alias("_std"))
    high = attach(hours, shape, by).where(F.col("count") > F.col("_mean") + F.col("_std") * deviations)
    return high.select(*by, "hour", "count", (F.col("count") - F.col("_mean")).alias("deviation"))


def sentiment_anomalies(posts: DataFrame, by: Sequence[str] = (), deviations: float = 2.0) -> DataFrame:
    """Posts whose score lies more than two population deviations from the mean."""
    scored = posts.where((_content() != "") & F.col("sentiment_polarity").isNotNull())
    shape = scored.groupBy(*by).agg(
        F.avg("sentiment_polarity").alias("_mean"), F.stddev_pop("sentiment_polarity").alias("_std")
    )
    slim = scored.select(
        *by,
        "ingest_seq",
        X.excerpt(F.col("content")).alias("excerpt"),
        F.col("sentiment_polarity").alias("sentiment"),
        F.coalesce("timestamp", "created_at").alias("posted"),
    )
    far = F.abs(F.col("sentiment") - F.col("_mean")) > F.col("_std") * deviations
    return attach(slim, shape, by).where(far).drop("_mean", "_std")


TOPICS = T.ArrayType(
    T.StructType([T.StructField("topic", T.StringType()), T.StructField("hits", T.LongType()), T.StructField("position", T.IntegerType())])
)


@F.arrow_udf(TOPICS)
def _topics(texts: pa.Array) -> pa.Array:
    """Each plain word of a lower-case text with its hits and its first position among them."""
    names, hits, positions, ends = [], [], [], [0]
    for text in texts.to_pylist():
        found = [w for w in X.plain(text or "").split() if len(w) > 3 and w.isascii() and w.isalpha()]
        firsts = dict(zip(reversed(found), range(len(found) - 1, -1, -1)))
        counts = Counter(found)
        names.extend(counts)
        hits.extend(counts.values())
        positions.extend(map(firsts.get, counts))
        ends.append(len(names))
    columns = [pa.array(names, pa.string()), pa.array(hits, pa.int64()), pa.array(positions, pa.int32())]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, TOPICS.elementType.names))


def topic_predictions(posts: DataFrame, n: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Most used plain words of four letters or more, each used at least three times.

    A post's words are counted in Arrow batches, so each of its distinct words is one row.
    """
    lowered = posts.where(F.trim(_content()) != "").select(*by, post_place().alias("_post"), F.lower(_content()).alias("_text"))
    counted = lowered.select(*by, "_post", F.inline(_topics(X.settle(F.col("_text")))))
    counts = counted.groupBy(*by, "topic").agg(
        F.sum("hits").alias("mentions"), F.min(place(F.col("_post"), F.col("position"))).alias("_first")
    )
    growth = F.when(F.col("mentions") > 5, "increasing").otherwise("stable").alias("predicted_growth")
    ranked = top_rows(counts.where(F.col("mentions") >= 3), n, [F.desc("mentions"), F.asc("_first")], by)
    return ranked.select(*by, "rank", "topic", "mentions", growth)


def engagement_forecast(posts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    means = posts.groupBy(*by).agg(F.avg(_reactions()).alias("average_current"))
    return means.where(F.col("average_current").isNotNull()).select(
        *by,
        "average_current",
        (F.col("average_current") * 1.1).alias("predicted_next_period"),
        F.lit("medium").alias("confidence"),
    )


def hashtag_lookup(tags: DataFrame) -> DataFrame:
    """Category and related keywords of the ``hashtag`` column."""
    spark = tags.sparkSession
    order = {}
    for category, members in C.HASHTAG_CATEGORIES.items():
        for tag in members:
            order.setdefault(tag, category)
    categories = small_table(spark, list(order.items()), "hashtag string, category string")
    related = small_table(spark, list(C.HASHTAG_KEYWORDS.items()), "hashtag string, related_keywords array<string>")
    default = F.array(*[F.lit(k) for k in C.DEFAULT_HASHTAG_KEYWORDS])
    joined = tags.join(categories, "hashtag", "left").join(related, "hashtag", "left")
    return joined.withColumn("category", F.coalesce("category", F.lit(C.OTHER_CATEGORY))).withColumn(
        "related_keywords", F.coalesce("related_keywords", default)
    )
