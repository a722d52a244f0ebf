"""One cycle: collect, dedupe, enrich, analyse, recommend, summarise, store."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens import constants as C
from postlens.functions.dates import as_time, iso
from postlens.operators import stats
from postlens.operators.common import side_by_side
from postlens.operators.dedup import dedupe_exact, dedupe_near
from postlens.operators.enrich import enrich
from postlens.operators.insights import insights
from postlens.operators.readings import RANKED, readings
from postlens.operators.recommend import recommend_all
from postlens.operators.trends import keyword_trends
from postlens.session import materialize
from postlens.sources import store

CYCLE_WINDOW_HOURS = 24
CYCLE_MIN_MENTIONS = 3
CYCLE_TRENDS = 10
CYCLE_INSIGHTS = 10
# What the analysis and the summary read of the enriched posts, besides the community.
READ = ("ingest_seq", "source", "date", "title", "content", "sentiment_polarity", "word_count")


@dataclass
class Analysis:
    """Lazy results of a cycle's analysis; each is a small frame per community."""

    basic: DataFrame
    sources: DataFrame
    trends: DataFrame
    distribution: DataFrame
    hourly: DataFrame
    insights: DataFrame
    by_source: DataFrame
    figures: DataFrame


def collect_posts(
    posts: DataFrame, as_of, near: bool = True, threshold: float = 0.8, lexicon: DataFrame | None = None,
    score_sentiment: bool = True,
) -> DataFrame:
    """Canonical posts without duplicates, valid and enriched."""
    unique = dedupe_near(posts, threshold) if near else dedupe_exact(posts)
    return enrich(unique, as_of, lexicon, score_sentiment=score_sentiment)


def enriched_posts(
    posts: DataFrame, as_of, by: Sequence[str] = (), near: bool = True, lexicon: DataFrame | None = None
) -> DataFrame:
    """The cycle's posts, collected and written once to the shared work folder, since every result reads them.

    Only the columns in ``READ`` are written, so measures that no result of
    the cycle reads, such as language and entities, are not worked out.
    """
    rich = collect_posts(posts, as_of, near=near, lexicon=lexicon)
    return materialize(rich.select(*dict.fromkeys([*by, *READ])), "enriched")


def analyze(
    posts: DataFrame,
    as_of,
    by: Sequence[str] = (),
    stop_words: Sequence[str] = tuple(C.KEYWORD_STOP_WORDS),
    terms: Sequence[str] = tuple(C.TECH_KEYWORDS),
) -> Analysis:
    """Statistics over all posts; trends, sentiment and insights over those with text.

    The posts are read once, see ``readings``; the results read what that leaves of them.
    """
    posts = readings(posts, by, stop_words=stop_words, terms=terms)
    texts = posts.where("has_text")
    trends = keyword_trends(texts, as_of, CYCLE_WINDOW_HOURS, CYCLE_MIN_MENTIONS, by=by, ranked=RANKED)
    sources = stats.source_counts(posts, by)
    groups = sources.groupBy(*by).agg(F.sum("n").alias("total_articles"), F.count("*").alias("source_groups"))
    return Analysis(
        basic=stats.basic_stats(posts, by, F.col("content_length")),
        sources=sources,
        trends=trends.where(F.col("rank") <= CYCLE_TRENDS),
        distribution=stats.sentiment_distribution(texts, by),
        hourly=stats.hourly_sentiment(texts, by),
        insights=insights(texts, trends, by).where(F.col("insight_no") <= CYCLE_INSIGHTS),
        by_source=stats.sentiment_by_source(texts, by),
        figures=groups,
    )


def analysis_rows(analysis: Analysis, by: Sequence[str] = ()) -> DataFrame:
    """The analysis as rows (section, position, label, value)."""

    def rows(frame: DataFrame, section: str, position, label, value) -> DataFrame:
        return frame.select(
            *by, F.lit(section).alias("section"), position.cast("int").alias("position"), label.alias("label"),
            value.cast("double").alias("value"),
        )

    basic = analysis.basic
    parts = [
        rows(basic, "total_items", F.lit(1), F.concat_ws(" - ", "date_start", "date_end"), F.col("total_articles")),
        rows(basic, "unique_sources", F.lit(1), F.lit("sources"), F.col("total_unique_sources")),
        rows(
            analysis.trends, "trend", F.col("rank"), F.concat_ws(" ", "topic", "direction"),
            F.col("velocity") * F.col("confidence"),
        ),
        rows(analysis.distribution, "positive", F.lit(1), F.lit("ratio"), F.col("positive")),
        rows(analysis.distribution, "negative", F.lit(1), F.lit("ratio"), F.col("negative")),
        rows(analysis.hourly, "hourly_sentiment", F.col("article_count"), iso(F.col("hour")), F.col("avg_sentiment")),
        rows(analysis.sources, "source", F.lit(1), F.col("source"), F.col("n")),
        rows(analysis.by_source, "source_sentiment", F.col("article_count"), F.col("source"), F.col("avg_sentiment")),
        rows(analysis.insights, "insight", F.col("insight_no"), F.col("insight"), F.lit(5)),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def recommend(analysis: Analysis, as_of, by: Sequence[str] = ()) -> DataFrame:
    return recommend_all(analysis.trends, analysis.distribution, analysis.figures, as_of, by)


def cycle_summary(posts: DataFrame, analysis: Analysis, recommendations: DataFrame, as_of, by=()) -> DataFrame:
    """One row per community: what the cycle collected and produced."""
    now = as_time(as_of)
    totals = posts.groupBy(*by).agg(
        F.count("*").alias("total_items_collected"),
        F.count_distinct(F.coalesce("source", F.lit("Unknown"))).alias("sources_accessed"),
    )
    found = analysis.insights.groupBy(*by).agg(F.count("*").alias("_insights"))
    given = recommendations.groupBy(*by).agg(F.count("*").alias("_recommendations"))
    row = side_by_side([totals, found, given], by)
    return row.select(
        *by,
        F.concat(F.lit("cycle_"), F.date_format(now, "yyyyMMdd_HHmmss")).alias("cycle_id"),
        "total_items_collected",
        "sources_accessed",
        F.coalesce("_insights", F.lit(0)).alias("total_insights"),
        F.coalesce("_recommendations", F.lit(0)).alias("total_recommendations"),
        (F.col("total_items_collected") > 0).alias("analysis_success"),
    )


def run_cycle(
    posts: DataFrame,
    as_of,
    analyses_path: str | None = None,
    recommendations_path: str | None = None,
    by: Sequence[str] = (),
    near: bool = True,
    lexicon: DataFrame | None = None,
    analysis_id: str | None = None,
    details_path: str | None = None,
    raw_path: str | None = None,
) -> DataFrame:
    """Run a cycle on canonical posts and return its summary; store it where paths are given.

    ``details_path`` takes the analysis itself: trends, sentiment, hours, sources and insights as rows. ``raw_path`` takes the posts as they
    came, per source and before any are dropped; the cycle's second is their batch, so a cycle that is run again replaces its own.

    The enriched posts are written once, see ``enriched_posts``.
    """
    now = as_time(as_of)
    if raw_path is not None:
        raw = store.raw_envelope(posts, F.coalesce("source", F.lit("Unknown")), F.lit("posts"), now)
        store.save_raw(raw, raw_path, posts.sparkSession.range(1).select(now.cast("long")).first()[0])
    enriched = enriched_posts(posts, as_of, by, near, lexicon)
    analysis = analyze(enriched, as_of, by)
    recommendations = recommend(analysis, as_of, by)
    summary = cycle_summary(enriched, analysis, recommendations, as_of, by)
    if analyses_path is None:
        return summary
    name = F.lit(analysis_id) if analysis_id else F.concat(F.lit("analysis_"), F.date_format(now, "yyyyMMdd_HHmmss"))
    if by:
        name = F.concat_ws("_", name, *by)
    named = summary.withColumns({"analysis_id": name, "timestamp": now})
    store.upsert_analyses(store.analysis_rows(named), analyses_path)
    if recommendations_path is not None:
        rows = store.recommendation_rows(recommendations, name, now)
        store.save_recommendations(rows, recommendations_path)
    if details_path is not None:
        store.save_details(analysis_rows(analysis, by).withColumn("analysis_id", name), details_path)
    # The stored rows are the result: reading them back does not run the cycle again.
    return store.read_analyses(posts.sparkSession, analyses_path)
