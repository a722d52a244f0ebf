"""The analytics report of a period, and its JSON form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens import constants as C
from postlens.functions.dates import as_time, hours_before, iso
from postlens.operators import stats
from postlens.operators.common import side_by_side
from postlens.operators.insights import insights
from postlens.operators.readings import RANKED, readings
from postlens.operators.trends import keyword_trends
from postlens.session import materialize

REPORTED_TRENDS = 10
REPORTED_INSIGHTS = 10


def analytics_report(
    posts: DataFrame,
    as_of,
    period_hours: int = 24,
    by: Sequence[str] = (),
    stop_words: Sequence[str] = tuple(C.KEYWORD_STOP_WORDS),
    terms: Sequence[str] = tuple(C.TECH_KEYWORDS),
) -> DataFrame:
    """One row per community: totals, first trends, distribution, sources, insights.

    Only the texts of the period's posts are read, once. The trends, a few per
    community, are written, since the report and its insights both read them.
    """
    now = as_time(as_of)
    chosen = readings(stats.period_filter(posts, now, period_hours, by), by, stop_words=stop_words, terms=terms)
    trends = materialize(keyword_trends(chosen, now, period_hours, by=by, ranked=RANKED), "trends")
    lines = insights(chosen, trends, by)
    totals = chosen.groupBy(*by).agg(F.count("*").alias("total_articles"))
    fields = ["topic", "mentions", "velocity", "sentiment", "direction", "confidence", "peak_time", "related_keywords"]
    leaders = trends.groupBy(*by).agg(
        F.sum("mentions").alias("total_mentions"),
        F.slice(F.array_sort(F.collect_list(F.struct("rank", *fields))), 1, REPORTED_TRENDS).alias("top_trends"),
    )
    # One entry per source: bounded by the number of sources, not of posts.
    sources = stats.source_counts(chosen, by).groupBy(*by).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "n")))).alias("source_breakdown")
    )
    texts = lines.groupBy(*by).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("insight_no", "insight"))), lambda e: e["insight"]).alias(
            "insights"
        )
    )
    row = side_by_side([totals, leaders, stats.sentiment_distribution(chosen, by), sources, texts], by)
    return row.select(
        *by,
        hours_before(now, period_hours).alias("period_start"),
        now.alias("period_end"),
        "total_articles",
        F.coalesce("total_mentions", F.lit(0)).alias("total_mentions"),
        "top_trends",
        F.struct("positive", "negative", "neutral").alias("sentiment_distribution"),
        "source_breakdown",
        "insights",
        now.alias("generated_at"),
    )


def report_json(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Reports as JSON text; times in ISO form, an absent peak time stays absent."""
    timed = report.withColumns({c: iso(F.col(c)) for c in ("period_start", "period_end", "generated_at")})
    trends = F.transform(
        F.coalesce("top_trends", F.array().cast(report.schema["top_trends"].dataType)),
        lambda t: t.withField("peak_time", iso(t["peak_time"])).dropFields("rank"),
    )
    body = timed.withColumn("top_trends", trends)
    columns = [c for c in body.columns if c not in by]
    return body.select(*by, F.to_json(F.struct(*columns)).alias("json"))
