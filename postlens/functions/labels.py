"""Labels and scores computed from a few numbers of one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlens import constants as C


def sentiment_label(polarity: Column) -> Column:
    return F.when(polarity > 0.1, "positive").when(polarity < -0.1, "negative").otherwise("neutral")


def growth_rate(current: Column, previous: Column) -> Column:
    return (current - previous) / F.greatest(previous, F.lit(1)) * 100


def trend_score(growth, mentions, engagement, sentiment, platforms, countries) -> Column:
    """Weighted sum of growth, volume, engagement, sentiment and spread, within 0 to 100."""
    weighted = (
        growth * 0.3
        + F.least(mentions / 1000, F.lit(10.0)) * 0.2
        + engagement * 20
        + (sentiment + 1) * 0.5
        + platforms * 0.2
        + F.least(countries / 10, F.lit(5.0)) * 0.1
    )
    return F.greatest(F.lit(0.0), F.least(weighted, F.lit(100.0)))


def velocity_label(growth: Column) -> Column:
    return (
        F.when(growth > 200, "explosive").when(growth > 50, "rapid").when(growth > 10, "moderate")
        .when(growth > 0, "slow").otherwise("declining")
    )


def predicted_direction(growth: Column, engagement: Column, sentiment: Column) -> Column:
    return (
        F.when((growth > 30) & (engagement > 0.05) & (sentiment > 0.2), "rising")
        .when((growth < -10) | (sentiment < -0.3), "declining")
        .when(growth > 5, "stable_growth")
        .otherwise("stable")
    )


def engagement_estimate(priority: Column, velocity: Column) -> Column:
    score = priority + velocity * 2
    return (
        F.when(score >= 12, "very_high").when(score >= 9, "high").when(score >= 6, "medium").otherwise("low")
    )


def topic_category(topic: Column) -> Column:
    lowered = F.lower(topic)
    label = F.lit(C.DEFAULT_TOPIC_CATEGORY)
    for name, parts in reversed(C.TOPIC_CATEGORIES):
        hit = lowered.contains(parts[0])
        for part in parts[1:]:
            hit = hit | lowered.contains(part)
        label = F.when(hit, name).otherwise(label)
    return label
