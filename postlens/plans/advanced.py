"""The advanced analysis bundle: one stored input, many small results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens import constants as C
from postlens.operators import behavior as B


def advanced_analysis(
    posts: DataFrame, names: Sequence[str] = tuple(C.COMPETITORS), by: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """Results by name; they all read ``posts``, which should be a stored table."""
    return {
        "community_health": B.community_health(posts, by),
        "top_performing_content": B.top_content(posts, by=by),
        "optimal_length": B.length_buckets(posts, by),
        "hashtag_performance": B.hashtag_performance(posts, by),
        "unique_users": B.unique_users(posts, by),
        "most_active_users": B.top_users(posts, by=by),
        "peak_hours": B.peak_hours(posts, by=by),
        "peak_days": B.peak_days(posts, by),
        "competitor_mentions": B.competitor_mentions(posts, names, by),
        "competitive_topics": B.competitor_contexts(posts, names, by=by),
        "activity_spikes": B.activity_spikes(posts, by),
        "sentiment_anomalies": B.sentiment_anomalies(posts, by),
        "trending_predictions": B.topic_predictions(posts, by=by),
        "engagement_forecast": B.engagement_forecast(posts, by),
    }


def as_rows(results: dict[str, DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """Results of differing shape as one frame of (section, community, row as JSON)."""
    frames = []
    for section, result in results.items():
        body = [c for c in result.columns if c not in by]
        frames.append(result.select(F.lit(section).alias("section"), *by, F.to_json(F.struct(*body)).alias("row")))
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole
