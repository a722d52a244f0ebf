"""Keyword trends, hashtag trends, emerging topics and posting velocity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens import constants as C
from postlens.functions import labels as L
from postlens.functions import text as X
from postlens.functions.dates import as_time, first_written, hour_key, hours_before
from postlens.operators.behavior import hashtag_lookup
from postlens.operators.common import engagement, place, post_place, side_by_side, top_rows
from postlens.operators.keywords import extract_keywords, placed_keywords, post_text
from postlens.operators.stats import post_date

WATCHED_KEYWORDS = 30
RELATED_POOL = 15
TOP_TRENDS = 15
PER_POST = 50


def related_keywords(keywords: DataFrame, pool: int = RELATED_POOL, n: int = 3, by: Sequence[str] = ()) -> DataFrame:
    """For each ranked keyword, the first ``n`` of the top ``pool`` that share a word with it.

    ``keywords`` holds (by, keyword, rank) and is a top-k already, so the pool
    of a community is gathered over its few rows and matched in the row.
    """
    candidate = F.when(F.col("rank") <= pool, F.struct("rank", "keyword"))
    gathered = keywords.withColumn("_pool", F.array_sort(F.collect_list(candidate).over(Window.partitionBy(*by))))
    own = F.split("keyword", " ")
    matches = F.filter(
        F.col("_pool"),
        lambda e: (e["keyword"] != F.col("keyword")) & F.arrays_overlap(F.split(e["keyword"], " "), own),
    )
    names = F.slice(F.transform(matches, lambda e: e["keyword"]), 1, n)
    return gathered.withColumn("related_keywords", names).drop("_pool")


def keyword_trends(
    posts: DataFrame,
    as_of,
    time_window_hours: int = 24,
    min_mentions: int = 2,
    by: Sequence[str] = (),
    per_post: int = PER_POST,
    stop_words: Sequence[str] = tuple(C.KEYWORD_STOP_WORDS),
    terms: Sequence[str] = tuple(C.TECH_KEYWORDS),
    ranked: str | None = None,
) -> DataFrame:
    """Trending keywords, at most fifteen per community, ranked by velocity times confidence.

    A post without a readable date counts as posted at ``as_of``. Keywords are
    first summed per (keyword, recent hour) and then per keyword, so both the
    totals and the peak hour come from one pass over the texts. ``per_post``
    keywords of a post take part, its most frequent ones. ``ranked`` names a
    column that holds them already, see ``readings``; the texts are not read then.
    """
    now = as_time(as_of)
    dated = posts.withColumn("_date", F.coalesce(post_date(posts), now))
    recent = F.col("_date") >= hours_before(now, time_window_hours)
    dated = dated.withColumn("_hour", F.when(recent, F.date_trunc("hour", "_date"))).withColumn(
        "_sentiment", F.when(F.col("sentiment_polarity") != 0, F.col("sentiment_polarity"))
    ).withColumn("_post", post_place()).withColumn("_exact", F.col("_sentiment").cast("decimal(28,10)"))
    carry = [*by, "_hour", "_sentiment", "_exact", "_post"]
    if ranked is None:
        per_text = extract_keywords(dated, post_text(), carry=carry, top_n=per_post, stop_words=stop_words, terms=terms)
    else:
        per_text = placed_keywords(dated, ranked, ["ingest_seq"], carry)
    per_hour = per_text.groupBy(*by, "keyword", "_hour").agg(
        F.sum("hits").alias("_hits"),
        F.count("*").alias("_posts"),
        F.sum("_exact").alias("_sum"),  # exact, so the order of rows is no matter
        F.count("_sentiment").alias("_scored"),
        F.min(place(F.col("_post"), F.col("rank"))).alias("_first"),
        F.when(F.count("ingest_seq") == F.count("*"), F.min("ingest_seq")).alias("_seq"),
    )
    in_window = F.col("_hour").isNotNull()
    totals = per_hour.groupBy(*by, "keyword").agg(
        F.sum("_hits").alias("mentions"),
        F.sum("_posts").alias("_posts"),
        F.coalesce(F.sum(F.when(in_window, F.col("_posts"))), F.lit(0)).alias("_recent"),
        F.coalesce(F.try_divide(F.sum("_sum").cast("double"), F.sum("_scored")), F.lit(0.0)).alias("sentiment"),
        F.max_by(
            "_hour", F.when(in_window, F.struct("_posts", (-F.col("_seq")).alias("seq")))
        ).alias("peak_time"),
        F.min("_first").alias("_first"),
    )
    watched = top_rows(totals, WATCHED_KEYWORDS, [F.desc("mentions"), F.asc("_first")], by)
    watched = related_keywords(watched, by=by)

    share = F.col("_recent") / F.greatest(F.lit(1), F.col("_posts"))
    direction = F.when(share >= 0.6, "rising").when(share <= 0.2, "falling").otherwise("stable")
    confidence = (
        F.when(share >= 0.6, F.least(F.lit(0.9), F.col("_recent") / 5))
        .when(share <= 0.2, F.least(F.lit(0.7), F.col("mentions") / 10))
        .otherwise(F.lit(0.5))
    )
    moving = watched.where((F.col("mentions") >= min_mentions) & (F.col("_recent") > 0)).select(
        *by,
        F.col("keyword").alias("topic"),
        "mentions",
        (F.col("_recent") / max(1, time_window_hours)).alias("velocity"),
        "sentiment",
        direction.alias("direction"),
        confidence.alias("confidence"),
        "peak_time",
        "related_keywords",
        F.col("rank").alias("_place"),
    )
    order = [F.desc(F.col("velocity") * F.col("confidence")), F.asc("_place")]
    return top_rows(moving, TOP_TRENDS, order, by).drop("_place")


def hashtag_trends(events: DataFrame, as_of, time_window_hours: int = 24, by: Sequence[str] = ()) -> DataFrame:
    """Hashtags of the current window against the one before it, scored and labelled.

    ``events`` holds hashtags, platform, country, event_time, sentiment_polarity
    and engagement_rate. A tag seen in neither window is left out.
    """
    now = as_time(as_of)
    start, before = hours_before(now, time_window_hours), hours_before(now, 2 * time_window_hours)
    t = F.col("event_time")
    tagged = events.where((t >= before) & (t < now)).select(
        *by, F.explode("hashtags").alias("hashtag"), (t >= start).alias("_now"), "platform", "country",
        "sentiment_polarity", "engagement_rate", "event_time",
    )

    def now_only(column: str) -> Column:
        return F.when(F.col("_now"), F.col(column))

    sums = tagged.groupBy(*by, "hashtag").agg(
        F.count_if("_now").alias("current_mentions"),
        F.count_if(~F.col("_now")).alias("previous_mentions"),
        F.array_sort(F.collect_set(now_only("platform"))).alias("platforms"),
        F.coalesce(F.avg(now_only("sentiment_polarity")), F.lit(0.0)).alias("sentiment_score"),
        F.coalesce(F.avg(now_only("engagement_rate")), F.lit(0.0)).alias("engagement_rate"),
        F.count_distinct(now_only("country")).alias("geographic_spread"),
    )
    scored = sums.withColumn("growth_rate", L.growth_rate(F.col("current_mentions"), F.col("previous_mentions")))
    growth, mood, rate = F.col("growth_rate"), F.col("sentiment_score"), F.col("engagement_rate")
    scored = scored.withColumns(
        {
            "trend_score": L.trend_score(
                growth, F.col("current_mentions"), rate, mood, F.size("platforms"), F.col("geographic_spread")
            ),
            "velocity": L.velocity_label(growth),
            "prediction": L.predicted_direction(growth, rate, mood),
        }
    )
    return hashtag_lookup(scored)


def emerging_topics(
    posts: DataFrame, n: int = 10, by: Sequence[str] = (), heads: Sequence[str] = tuple(C.TOPIC_HEADS)
) -> DataFrame:
    """Words in front of a topic head; of the ``n`` most frequent, those used three times and longer than three."""
    lowered = F.lower(post_text())

    def before(order: int, head: str) -> Column:
        pattern = rf"(?<!{C.WORD_CHAR})({C.WORD_CHAR}++){C.SPACE}++{head}(?!{C.WORD_CHAR})"
        return F.transform(
            F.regexp_extract_all(lowered, F.lit(pattern), F.lit(1)),
            lambda w, i: F.struct(w.alias("word"), F.lit(order).alias("head"), i.alias("position")),
        )

    found = [before(order, head) for order, head in enumerate(heads)]
    hits = posts.select(*by, "ingest_seq", F.inline(F.concat(*found)))
    counts = hits.groupBy(*by, "word").agg(
        F.count("*").alias("mention_count"), F.min(F.struct("head", "ingest_seq", "position")).alias("_first")
    )
    leading = top_rows(counts, n, [F.desc("mention_count"), F.asc("_first")], by)
    kept = leading.where((F.col("mention_count") >= 3) & (F.length("word") > 3))
    return kept.select(
        *by,
        "rank",
        F.concat(X.title_case(F.col("word")), F.lit(" Technology")).alias("topic"),
        F.concat(F.lit("Emerging technology trend related to "), F.col("word")).alias("description"),
        "mention_count",
        F.least(F.col("mention_count") / 20, F.lit(1.0)).alias("confidence_score"),
        L.topic_category(F.col("word")).alias("trend_category"),
    )


def _written() -> Column:
    return first_written(F.col("created_at"), F.col("timestamp"), F.col("date"))


def content_velocity(posts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Posting rates, engagement and peak hour, one row per community."""
    timed = posts.select(
        *by, "ingest_seq", _written().alias("_time"), engagement("likes", "comments", "shares", "retweets").alias("_e")
    )
    hours = timed.groupBy(*by, hour_key(F.col("_time")).alias("_hour")).agg(
        F.count("*").alias("_n"),
        F.coalesce(F.sum(F.when(F.col("_time").isNotNull(), F.col("_e"))), F.lit(0)).alias("_e"),
        F.min("ingest_seq").alias("_first"),
    )
    dated = F.col("_hour").isNotNull()
    day = F.substring("_hour", 1, 10)
    summary = hours.groupBy(*by).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("content_count"),
        F.coalesce(F.sum("_e"), F.lit(0)).alias("total_engagement"),
        F.coalesce(F.sum(F.when(dated, F.col("_n"))), F.lit(0)).alias("_dated"),
        F.count("_hour").alias("_hours"),
        F.count_distinct(day).alias("_days"),
        F.max_by("_hour", F.when(dated, F.struct("_n", (-F.col("_first")).alias("s")))).alias("_peak"),
        F.coalesce(F.max(F.when(dated, F.col("_n"))), F.lit(0)).alias("peak_hour_posts"),
        F.min("_hour").alias("_start"),
        F.max("_hour").alias("_end"),
    )
    na = F.lit("N/A")
    result = summary.select(
        *by,
        "content_count",
        "total_engagement",
        (F.col("total_engagement") / F.greatest("content_count", F.lit(1))).alias("avg_engagement_per_post"),
        F.coalesce(F.try_divide("_dated", "_hours"), F.lit(0.0)).alias("avg_hourly_posting_rate"),
        F.coalesce(F.try_divide("_dated", "_days"), F.lit(0.0)).alias("avg_daily_posting_rate"),
        F.coalesce("_peak", na).alias("peak_hour"),
        "peak_hour_posts",
        F.coalesce("_start", na).alias("period_start"),
        F.coalesce("_end", na).alias("period_end"),
    )
    return side_by_side([result, velocity_trend(posts, by)], by)


def velocity_trend(posts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Last two posting days against the first two, one row per community."""
    days = posts.groupBy(*by, F.date_format(_written(), "yyyy-MM-dd").alias("_day")).agg(F.count("*").alias("_n"))
    # One entry per calendar day, so the array stays short however many posts there are.
    calendars = days.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.when(F.col("_day").isNotNull(), F.struct("_day", "_n")))).alias("_calendar")
    )

    def two_days(start: int) -> Column:
        pair = F.slice(F.col("_calendar"), start, 2)
        return F.aggregate(pair, F.lit(0).cast("long"), lambda total, d: total + d["_n"]) / 2

    sums = calendars.withColumn("_days", F.size("_calendar")).withColumn(
        "_early", F.when(F.col("_days") > 3, two_days(1))
    ).withColumn("_late", F.when(F.col("_days") > 3, two_days(-2)))
    trend = (
        F.when(F.col("_days") < 2, "insufficient_data")
        .when(F.col("_days") < 4, "stable")
        .when(F.col("_late") > F.col("_early") * 1.2, "increasing")
        .when(F.col("_late") < F.col("_early") * 0.8, "decreasing")
        .otherwise("stable")
    )
    return sums.select(*by, trend.alias("velocity_trend"))


def ranked_hashtags(trends: DataFrame, n: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """The ``n`` best hashtags by score; ties go to the more used, then to the name."""
    order = [F.desc("trend_score"), F.desc("current_mentions"), F.asc("hashtag")]
    return top_rows(trends, n, order, by)


def _run_parts(hashtags: DataFrame, topics: DataFrame, velocity: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per community: leading tags, confident topics and velocity."""
    tags = ranked_hashtags(hashtags, 5, by).groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("rank", "hashtag", "trend_score", "velocity"))).alias("_tags")
    )
    counts = hashtags.groupBy(*by).agg(F.count("*").alias("_n_tags"))
    leaders = topics.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("rank", "topic", "confidence_score"))).alias("_topics")
    )
    return side_by_side([velocity, tags, counts, leaders], by)


def trend_summary(hashtags: DataFrame, topics: DataFrame, velocity: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Summary as rows (section, position, item, value)."""
    parts = _run_parts(hashtags, topics, velocity, by)
    row = "struct<section string, position int, item string, value double>"

    def entry(section: str, position, item, value):
        return F.struct(
            F.lit(section).alias("section"), position.cast("int").alias("position"), item.alias("item"),
            value.cast("double").alias("value"),
        )

    none = F.lit(None).cast("string")
    totals = F.array(
        entry("total_hashtags_analyzed", F.lit(1), none, F.coalesce("_n_tags", F.lit(0))),
        entry("total_emerging_topics", F.lit(1), none, F.coalesce(F.size("_topics"), F.lit(0))),
    )
    tags = F.transform(
        F.coalesce("_tags", F.array().cast("array<struct<rank int, hashtag string, trend_score double, velocity string>>")),
        lambda t: entry("top_trending_hashtags", t["rank"], F.concat_ws(" ", t["hashtag"], t["velocity"]), t["trend_score"]),
    )
    sure = F.filter(
        F.coalesce("_topics", F.array().cast("array<struct<rank int, topic string, confidence_score double>>")),
        lambda t: t["confidence_score"] > 0.7,
    )
    topics_out = F.transform(
        sure, lambda t, i: entry("high_confidence_emerging_topics", i + 1, t["topic"], t["confidence_score"])
    )
    notes = F.array_compact(
        F.array(
            F.when(F.col("velocity_trend") == "increasing", "Content velocity is increasing - good time for active engagement")
            .when(F.col("velocity_trend") == "decreasing", "Content velocity is decreasing - may need to boost content creation"),
            F.when(F.col("avg_engagement_per_post") > 50, "High engagement rate detected - content resonating well")
            .when(F.col("avg_engagement_per_post") < 10, "Low engagement rate - consider content strategy adjustment"),
        )
    )
    notes_out = F.transform(notes, lambda s, i: entry("velocity_insights", i + 1, s, F.lit(None)))
    rows = [a.cast(f"array<{row}>") for a in (totals, tags, topics_out, notes_out)]
    return parts.select(*by, F.inline(F.concat(*rows)))


def trend_advice(hashtags: DataFrame, topics: DataFrame, velocity: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """At most five pieces of advice per community, in order."""
    parts = _run_parts(hashtags, topics, velocity, by)
    tag = F.get(F.col("_tags"), F.lit(0))
    sure = F.get(F.filter(F.col("_topics"), lambda t: t["confidence_score"] > 0.8), F.lit(0))
    advice = F.array_compact(
        F.array(
            F.when(
                tag["velocity"] == "explosive",
                F.concat(F.lit("Capitalize on explosive trend: "), tag["hashtag"], F.lit(" - create content immediately")),
            ).when(
                tag["velocity"] == "rapid",
                F.concat(F.lit("Join trending conversation: "), tag["hashtag"], F.lit(" - high engagement potential")),
            ),
            F.concat(
                F.lit("Early mover advantage: Create content about '"), sure["topic"],
                F.lit("' - high confidence emerging trend"),
            ),
            F.when(
                F.col("velocity_trend") == "increasing",
                "Content velocity increasing - scale up posting schedule to match momentum",
            ).when(
                F.col("velocity_trend") == "decreasing",
                "Content velocity decreasing - focus on quality over quantity, boost engagement tactics",
            ),
            F.lit("Monitor trend velocity daily for rapid response opportunities"),
            F.lit("Cross-reference hashtag trends with emerging topics for content synergy"),
            F.lit("Prepare content templates for quick deployment during trend spikes"),
        )
    )
    chosen = parts.select(*by, F.posexplode(F.slice(advice, 1, 5)).alias("_i", "advice"))
    return chosen.select(*by, (F.col("_i") + 1).alias("position"), "advice")


def trend_run(
    events: DataFrame,
    posts: DataFrame,
    as_of,
    time_window_hours: int = 24,
    by: Sequence[str] = (),
    heads: Sequence[str] = tuple(C.TOPIC_HEADS),
) -> DataFrame:
    """A full trend run as rows (by, section, row as JSON)."""
    hashtags = hashtag_trends(events, as_of, time_window_hours, by)
    topics = emerging_topics(posts, by=by, heads=heads)
    velocity = content_velocity(posts, by)
    sections = {
        "hashtag_trends": hashtags,
        "emerging_topics": topics,
        "content_velocity": velocity,
        "trend_summary": trend_summary(hashtags, topics, velocity, by),
        "key_recommendations": trend_advice(hashtags, topics, velocity, by),
    }
    frames = [
        frame.select(*by, F.lit(name).alias("section"), F.to_json(F.struct(*[c for c in frame.columns if c not in by])).alias("row"))
        for name, frame in sections.items()
    ]
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole
