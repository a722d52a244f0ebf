"""Summaries, trends, insights and recommendations on small frames and at their limits."""

import datetime as dt

import pytest

from postlens.operators import behavior as B
from postlens.operators import enrich, insights, recommend, sentiment, stats, trends
from postlens.operators.keywords import extract_keywords, post_text
from postlens.plans import cycle

NOW = dt.datetime(2024, 1, 2, 10, 0)
SCHEMA = (
    "ingest_seq long, source string, title string, content string, date string, created_at string, timestamp string, "
    "likes long, comments long, shares long, retweets long, username string, author string, hashtags array<string>, "
    "sentiment_polarity double, word_count int, category string, url string, c string"
)


def frame(spark, rows):
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.get(n, i if n == "ingest_seq" else None) for n in names) for i, r in enumerate(rows)], SCHEMA)


def one(df):
    (row,) = df.collect()
    return row.asDict()


def test_empty_input(spark):
    none = frame(spark, [])
    assert one(stats.basic_stats(none))["total_articles"] == 0
    assert one(stats.sentiment_distribution(none)) == {"overall_sentiment": None, "positive": 0.0, "negative": 0.0, "neutral": 1.0}
    assert stats.hourly_sentiment(none).count() == 0 and stats.peak_hour_of_day(none).count() == 0
    assert [r[-1] for r in insights.insights(none, trends.keyword_trends(none, NOW)).collect()] == ["No data available for analysis."]
    assert one(trends.content_velocity(none))["velocity_trend"] == "insufficient_data"
    assert [r["count"] for r in B.length_buckets(none).collect()] == [0, 0, 0]
    assert one(B.community_health(none))["health_score"] == 0.0
    assert B.engagement_forecast(none).count() == 0


def test_zero_polarity_counts_in_one_place_only(spark):
    posts = frame(spark, [{"sentiment_polarity": p, "date": "2024-01-01T00:00:00"} for p in (0.0, 0.0, 0.1, 0.5, -0.5)])
    assert one(stats.sentiment_stats(posts))["neutral_ratio"] == pytest.approx(0.6)
    assert one(stats.sentiment_distribution(posts))["neutral"] == pytest.approx(1 / 3)


def test_period_filter_falls_back_to_all(spark):
    old = [{"date": "2023-01-01"}, {"date": "bad"}]
    assert stats.period_filter(frame(spark, old), NOW).count() == 2
    assert [r.ingest_seq for r in stats.period_filter(frame(spark, old + [{"date": None}, {"date": "2024-01-02T00:00:00"}]), NOW).orderBy("ingest_seq").collect()] == [2, 3]


def test_keywords_count_substrings_and_break_ties_by_place(spark):
    posts = frame(spark, [{"content": "Said the AI: rain, rain-maker zeta alpha", "title": "no-code ai"}])
    got = [(r.keyword, r.hits) for r in extract_keywords(posts, post_text(), top_n=4).orderBy("rank").collect()]
    assert got == [("ai", 5), ("rain", 2), ("said", 1), ("maker", 1)]


def test_trend_directions(spark):
    rows = [{"content": "apple pie", "date": "2024-01-02T09:00:00"}] * 3 + [{"content": "pear", "date": "2023-12-01"}] * 9
    rows += [{"content": "pear"}] + [{"content": "plum", "date": "2024-01-02T01:00:00"}, {"content": "plum", "date": "2023-12-01"}]
    found = {r.topic: r for r in trends.keyword_trends(frame(spark, rows), NOW).collect()}
    assert (found["apple"].direction, found["apple"].confidence, found["apple"].velocity) == ("rising", 0.6, 3 / 24)
    assert (found["pear"].direction, found["pear"].confidence) == ("falling", 0.7)
    assert (found["plum"].direction, found["plum"].confidence) == ("stable", 0.5)
    assert found["apple"].peak_time == dt.datetime(2024, 1, 2, 9)


@pytest.mark.parametrize("counts,label", [([5], "insufficient_data"), ([1, 9, 9], "stable"), ([1, 1, 2, 2], "increasing"), ([5, 5, 4, 4], "stable"), ([5, 5, 1, 1], "decreasing")])
def test_velocity_trend(spark, counts, label):
    rows = [{"created_at": f"2024-01-0{d + 1}T00:00:00"} for d, n in enumerate(counts) for _ in range(n)]
    assert one(trends.velocity_trend(frame(spark, rows)))["velocity_trend"] == label


def test_contexts_and_mentions(spark):
    posts = frame(spark, [{"content": "a b c Google d e f g google"}, {"content": "metagoogle"}])
    rows = B.competitor_contexts(posts).collect()
    assert [(r.competitor, r.context) for r in rows] == [
        ("google", "a b c google d e f"), ("google", "e f g google"), ("google", "metagoogle"), ("meta", "metagoogle"),
    ]
    assert {r.competitor: r.mentions for r in B.competitor_mentions(posts).collect()} == {"google": 3, "meta": 1}


def test_users_fall_back_to_author(spark):
    posts = frame(spark, [{"username": "x"}, {"author": "x"}, {"author": "anonymous"}, {}])
    assert one(B.unique_users(posts))["total_unique_users"] == 1
    assert one(B.top_users(posts))["posts"] == 2


def test_recommendations_rank_and_score(spark):
    t = spark.createDataFrame([(1, "machine learning", 150, 3.2, 0.2, "rising", 0.85), (2, "x", 9, 1.0, 0.0, "stable", 0.5)], "rank int, topic string, mentions long, velocity double, sentiment double, direction string, confidence double")
    mood = spark.createDataFrame([(0.75, 0.15, 0.1)], "positive double, negative double, neutral double")
    figures = spark.createDataFrame([(125, 6)], "total_articles long, source_groups long")
    rows = recommend.recommend_all(t, mood, figures, NOW).orderBy("rank").collect()
    assert [r.type for r in rows] == [
        "trend_based", "sentiment_amplification", "content_type", "trend_based", "engagement_optimization", "content_type", "content_diversity", "timing_optimization",
    ]
    first = rows[0]
    assert (first.content_type, first.estimated_engagement, first.confidence_score, first.hashtags[0]) == ("news", "very_high", 0.95, "#machinelearning")
    assert rows[1].reasoning == "High positive sentiment (75.0%) - good time to amplify"
    assert (rows[-1].title, rows[-1].schedule_for) == ("Optimal posting time: 19:00", "2024-01-02T19:00:00")


def test_cycle_by_community_equals_cycles_apart(spark):
    text = "Rain falls on the {} today and people talk about it. It may go on for {} more days."
    rows = [{"c": "ab"[i % 2], "source": f"s{i % 4}", "title": "what a day", "content": text.format("townvalley"[i % 5:], i), "date": "2024-01-02T08:00:00", "sentiment_polarity": 0.3, "word_count": 20} for i in range(12)]
    posts = frame(spark, rows)
    together = cycle.analysis_rows(cycle.analyze(posts, NOW, ["c"]), ["c"]).collect()
    for c in "ab":
        alone = cycle.analysis_rows(cycle.analyze(posts.where(f"c = '{c}'"), NOW)).collect()
        assert sorted(map(tuple, alone), key=str) == sorted((tuple(r)[1:] for r in together if r.c == c), key=str)


def test_sentiment_in_the_row_equals_the_join(spark, monkeypatch):
    lexicon = spark.createDataFrame([("good", 0.7, 0.6, 1.0), ("bad", -0.6, 0.9, 1.0), ("very", 0.2, 0.3, 1.3)], sentiment.LEXICON_SCHEMA)
    texts = ["very good, not bad", "bad very very GOOD good", "", None, "none of these", "not very good"]
    posts = frame(spark, [{"content": t} for t in texts])
    read = lambda df: [tuple(r) for r in df.select("ingest_seq", *sentiment.SCORES).orderBy("ingest_seq").collect()]
    in_row = read(sentiment.lexicon_sentiment(posts, lexicon))
    empty = read(sentiment.lexicon_sentiment(posts, lexicon.limit(0)))
    monkeypatch.setattr(sentiment, "IN_ROW", 2)
    assert in_row == read(sentiment.lexicon_sentiment(posts, lexicon)) and len(in_row) == len(texts)
    # very 0.2, good 0.7 * 1.3, not bad -0.6 * -0.5
    assert in_row[0][1:] == (0.47, 0.6, "positive") and in_row[3][1:] == (0.0, 0.0, "neutral")
    assert {r[1:] for r in empty} == {(0.0, 0.0, "neutral")}


def test_texts_are_worked_on_without_a_shuffle(spark):
    posts = frame(spark, [{"content": "some words about rain", "title": "some title"}])
    for df in (enrich.enrich(posts, NOW), extract_keywords(posts, post_text())):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_stored_cycle_holds_its_analysis(spark, tmp_path):
    from postlens.sources import store

    rows = [{"source": f"s{i % 2}", "title": "what a day it is", "content": f"Rain falls on town {i} and people talk about it. It may go on for days.", "date": "2024-01-02T08:00:00", "url": f"https://a.b/{i}"} for i in range(6)]
    paths = [str(tmp_path / n) for n in ("analyses", "recommendations", "details")]
    for _ in range(2):  # the second run replaces the first
        cycle.run_cycle(frame(spark, rows), NOW, paths[0], paths[1], near=False, analysis_id="a", details_path=paths[2])
    stored = store.read_details(spark, paths[2])
    assert {r.label: r.value for r in stored.where("section = 'source'").collect()} == {"s0": 3.0, "s1": 3.0}
    assert stored.where("section = 'total_items'").count() == 1 and stored.where("section = 'insight'").count() >= 1
