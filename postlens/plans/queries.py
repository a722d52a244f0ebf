"""The registered queries: every operator on the driver tables, flat and rounded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens import constants as C
from postlens.functions import labels as L
from postlens.functions import text as X
from postlens.functions.dates import as_time, hour_key, iso, normalize_datetime, posted_at, first_written
from postlens.operators import behavior as B
from postlens.operators import common, dedup, enrich, insights, keywords, language, recommend, sentiment, stats, trends
from postlens.operators.readings import RANKED, readings
from postlens.plans import advanced, cycle, report
from postlens.plans.fixtures import as_of, counted_posts, posts, table, tagged_events
from postlens.schema import conform
from postlens.session import materialize, small_table, work_folder
from postlens.sources import html, payloads, store
from postlens.sources.quarantine import as_records, split_records
from postlens.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

# The prose of the tables is invented, so the queries look for words that occur in it.
TERMS = ["ai", "iot", "der", "que la"]
NAMES = ["tion", "anth", "ouen"]
HEADS = ["ai", "the", "der", "que", "of", "und"]
LEXICON = [
    ("the", 0.5, 0.4, 1.0), ("with", -0.3, 0.6, 1.0), ("from", 0.8, 0.9, 1.0), ("was", -0.6, 0.5, 1.0),
    ("les", 0.7, 0.8, 1.0), ("und", -0.4, 0.2, 1.0), ("of", 0.0, 0.1, 1.3), ("la", 0.0, 0.2, 0.5),
]
NEGATIONS = ["and", "que", "der"]
BY = ["platform"]


def lexicon(spark: SparkSession) -> DataFrame:
    return small_table(spark, LEXICON, sentiment.LEXICON_SCHEMA)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded and times as text, so that results compare by value.

    The order of a distributed sum is open. Its noise is rounded off first, so
    that a mean exactly between two results goes the same way in every run.
    """
    columns = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if kind == "double":
            columns.append(F.round(F.round(f.name, 12), digits).alias(f.name))
        elif kind == "timestamp":
            columns.append(iso(F.col(f.name)).alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


def documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents as posts of content only, copies included."""
    return table(spark, d, "documents").select(F.col("doc_id").alias("ingest_seq"), F.col("text").alias("content"))


def shared_posts(spark: SparkSession, d: str) -> DataFrame:
    """Posts written once, for queries that read them several times."""
    return materialize(counted_posts(spark, d), "posts")


# --- dates and text ---------------------------------------------------------


def normalize_dates(spark, d):
    n, t = F.col("ingest_seq"), F.col("event_time")
    date = (
        F.when(n % 11 == 1, F.date_format(t, "yyyy/MM/dd HH:mm:ss"))
        .when(n % 11 == 2, F.date_format(t, "MMM d, yyyy"))
        .when(n % 11 == 3, F.date_format(t, "EEE MMM dd HH:mm:ss '+0000' yyyy"))
        .when(n % 11 == 4, F.date_format(t, "MMMM d, yyyy HH:mm"))
        .when(n % 11 == 5, F.date_format(t, "MM/dd/yyyy HH:mm:ss"))
        .otherwise(F.col("date"))
    )
    dated = posts(spark, d).select("ingest_seq", date.alias("date"))
    return dated.withColumn("normalized", iso(normalize_datetime(F.col("date"))))


def event_hour(spark, d):
    written = first_written(F.col("created_at"), F.col("timestamp"), F.col("date"))
    return posts(spark, d).select(
        "ingest_seq",
        hour_key(posted_at(F.col("timestamp"), F.col("created_at"))).alias("hour_key"),
        hour_key(written).alias("written_hour_key"),
    )


def clean_text(spark, d):
    return posts(spark, d).select(
        "ingest_seq",
        F.lower(X.clean_text(F.col("content"))).alias("clean"),
        F.lower(X.clean_text(F.col("content"), preserve_entities=False)).alias("plain"),
    )


def extract_entities(spark, d):
    found = X.entities(F.col("content"))

    def rows(kind: str, values: Column) -> Column:
        return F.transform(values, lambda v, i: F.struct(F.lit(kind).alias("kind"), i.alias("position"), v.alias("value")))

    kinds = F.concat(*[rows(kind, values) for kind, values in found.items()])
    return posts(spark, d).select("ingest_seq", F.inline(kinds))


def content_hash(spark, d):
    return documents(spark, d).select("ingest_seq", X.content_hash(F.col("content")).alias("content_hash"))


def pair_similarity(spark, d):
    """Each document against the one before it."""
    newer = documents(spark, d)
    older = documents(spark, d).select((F.col("ingest_seq") + 1).alias("ingest_seq"), F.col("content").alias("_old"))
    ratio = dedup.pair_similarity(F.col("content"), F.col("_old"))
    # Heavy on processors, light on bytes: spread, so that pairs are not packed by size.
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = newer.join(older, "ingest_seq").repartition(spread, "ingest_seq")
    return pairs.select("ingest_seq", F.round(ratio, 6).alias("similarity"))


def validate_posts(spark, d):
    checked = enrich.validate(posts(spark, d))
    return checked.select("ingest_seq", "is_valid", F.array_join("issues", "; ").alias("issues"))


def rejection_reasons(spark, d):
    return enrich.rejection_reasons(posts(spark, d))


def sentiment_label(spark, d):
    return posts(spark, d).select("ingest_seq", L.sentiment_label(F.col("sentiment_polarity")).alias("sentiment_label"))


def readability(spark, d):
    return rounded(posts(spark, d).select("ingest_seq", X.readability(F.col("content")).alias("readability_score")))


def text_stats(spark, d):
    measures = X.text_stats(F.coalesce("content", F.lit("")))
    return rounded(posts(spark, d).select("ingest_seq", *[c.alias(n) for n, c in measures.items()]))


def lexicon_sentiment(spark, d):
    return rounded(sentiment.lexicon_sentiment(posts(spark, d), lexicon(spark), negations=NEGATIONS))


def detect_language(spark, d):
    return rounded(language.with_language(documents(spark, d)).drop("content"))


def enrich_posts(spark, d):
    rich = enrich.enrich(posts(spark, d), as_of(spark, d), lexicon(spark), NEGATIONS)
    return rounded(
        rich.select(
            "ingest_seq", F.lower("title").alias("title"), F.md5(F.lower("content")).alias("content_md5"),
            "word_count", "char_count", "sentence_count", "avg_word_length",
            *[F.size(k).alias(f"n_{k}") for k in ("mentions", "hashtags", "urls", "emails", "phones")],
            "has_entities", "readability_score", "sentiment_polarity", "sentiment_subjectivity", "sentiment_label",
            "language", "language_confidence", "content_hash",
        )
    )


def extract_keywords(spark, d):
    return keywords.extract_keywords(posts(spark, d), keywords.post_text(), terms=TERMS)


def text_items(spark, d):
    return stats.text_items(posts(spark, d)).select("ingest_seq")


def period_filter(spark, d):
    return stats.period_filter(posts(spark, d), as_of(spark, d), 24).select("ingest_seq")


def _document_tags(spark, d) -> DataFrame:
    """Every word of the documents, in capitals, as a hashtag with its number of uses."""
    tag = F.concat(F.lit("#"), F.upper("word"))
    words = table(spark, d, "documents").select(F.explode(F.split(F.lower("text"), r"[^a-z]+")).alias("word"))
    return words.where("word <> ''").groupBy("word").agg(F.count("*").alias("uses")).select(tag.alias("hashtag"), "word", "uses")


def hashtag_category(spark, d):
    tagged = B.hashtag_lookup(_document_tags(spark, d))
    return tagged.groupBy("category").agg(F.count("*").alias("tags"), F.sum("uses").alias("uses"))


def hashtag_related(spark, d):
    tagged = B.hashtag_lookup(_document_tags(spark, d)).select(F.explode("related_keywords").alias("related"), "uses")
    return tagged.groupBy("related").agg(F.count("*").alias("tags"), F.sum("uses").alias("uses"))


def topic_category(spark, d):
    topics = _document_tags(spark, d).select(L.topic_category(F.col("word")).alias("category"), "uses")
    return topics.groupBy("category").agg(F.count("*").alias("topics"), F.sum("uses").alias("uses"))


def url_site(spark, d):
    link = F.concat(F.when(F.col("page_id") % 2 == 0, "/item/").otherwise("http://x.org/"), F.col("page_id").cast("string"))
    return table(spark, d, "pages").select(
        "page_id",
        X.site_host(F.col("url")).alias("site"),
        X.join_link(F.col("url"), link).alias("link"),
        X.bare_subreddit(F.concat(F.lit("r/"), X.site_host(F.col("url")))).alias("subreddit"),
    )


# --- duplicates -------------------------------------------------------------


def dedupe_exact(spark, d):
    return dedup.dedupe_exact(documents(spark, d)).select("ingest_seq")


def dedupe_near(spark, d):
    return dedup.dedupe_near(documents(spark, d)).select("ingest_seq")


def clean_frame(spark, d):
    source = table(spark, d, "documents")
    frame = source.select(
        F.col("doc_id").alias("ingest_seq"),
        F.when(F.col("doc_id") % 29 != 4, F.col("text")).alias("content"),
        F.when(F.col("doc_id") % 31 != 6, F.array_join(F.slice(X.words(F.col("text")), 1, 8), " ")).alias("title"),
        F.col("source").alias("author"),
    )
    cleaned = enrich.clean_frame(frame)
    return rounded(cleaned.select("ingest_seq", F.lower("title").alias("title"), "word_count", "readability_score"))


# --- statistics -------------------------------------------------------------


def basic_stats(spark, d):
    return rounded(stats.basic_stats(posts(spark, d)))


def basic_stats_by_platform(spark, d):
    return rounded(stats.basic_stats(posts(spark, d), BY))


def source_counts(spark, d):
    return stats.source_counts(posts(spark, d))


def category_counts(spark, d):
    return stats.category_counts(posts(spark, d))


def word_count_stats(spark, d):
    return rounded(stats.word_count_stats(counted_posts(spark, d)))


def sentiment_stats(spark, d):
    return rounded(stats.sentiment_stats(posts(spark, d)))


def hourly_sentiment(spark, d):
    return rounded(stats.hourly_sentiment(posts(spark, d)))


def sentiment_distribution(spark, d):
    return rounded(stats.sentiment_distribution(posts(spark, d), BY))


def sentiment_by_source(spark, d):
    return rounded(stats.sentiment_by_source(posts(spark, d)))


def engagement_score(spark, d):
    return rounded(stats.engagement_score(counted_posts(spark, d)))


def peak_hour_of_day(spark, d):
    return stats.peak_hour_of_day(posts(spark, d))


def _stored(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw, analysis and recommendation tables as a cycle per platform would store them."""
    p, now = posts(spark, d), as_of(spark, d)
    raw = store.raw_envelope(p, F.coalesce("source", F.lit("Unknown")), F.lit("posts"), now)
    figures = _figures(spark, d, BY)
    name = F.concat(F.lit("analysis_"), F.col("platform"))
    analyses = store.analysis_rows(figures.select(name.alias("analysis_id"), F.col("total_articles"), as_time(now).alias("timestamp")))
    recommendations = recommend.recommend_engagement(figures, now, BY)
    return raw, analyses, store.recommendation_rows(recommendations, name, now)


def storage_stats(spark, d):
    return stats.storage_stats(*_stored(spark, d))


# --- behaviour --------------------------------------------------------------


def community_health(spark, d):
    return rounded(B.community_health(posts(spark, d), BY))


def length_buckets(spark, d):
    return rounded(B.length_buckets(posts(spark, d)))


def hashtag_performance(spark, d):
    return rounded(B.hashtag_performance(posts(spark, d)))


def unique_users(spark, d):
    return B.unique_users(posts(spark, d))


def top_users(spark, d):
    return B.top_users(posts(spark, d))


def peak_hours(spark, d):
    return B.peak_hours(posts(spark, d))


def peak_days(spark, d):
    return B.peak_days(posts(spark, d))


def top_content(spark, d):
    return B.top_content(posts(spark, d))


def top_content_by_platform(spark, d):
    return B.top_content(posts(spark, d), by=BY)


def _event_posts(spark, d) -> DataFrame:
    events = table(spark, d, "events")
    return events.select(
        F.col("event_id").alias("ingest_seq"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"),
        F.lit(None).cast("string").alias("timestamp"),
    )


def activity_spikes(spark, d):
    at = lambda k: B.activity_spikes(_event_posts(spark, d), deviations=k).withColumn("deviations", F.lit(k))
    return rounded(at(1.5).unionByName(at(2.0)))


def sentiment_anomalies(spark, d):
    at = lambda k: B.sentiment_anomalies(posts(spark, d), deviations=k).withColumn("deviations", F.lit(k))
    return rounded(at(1.5).unionByName(at(2.0)))


def topic_predictions(spark, d):
    return B.topic_predictions(posts(spark, d))


def engagement_forecast(spark, d):
    return rounded(B.engagement_forecast(posts(spark, d), BY))


def competitor_mentions(spark, d):
    return B.competitor_mentions(posts(spark, d), NAMES)


def competitor_contexts(spark, d):
    turns = table(spark, d, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("ingest_seq"), F.col("text").alias("content")
    )
    return B.competitor_contexts(turns, NAMES)


def advanced_analysis(spark, d):
    results = advanced.advanced_analysis(materialize(posts(spark, d), "posts"), NAMES)
    return advanced.as_rows(results)


# --- trends -----------------------------------------------------------------


def _trends(spark, d, by=(), source=None) -> DataFrame:
    return trends.keyword_trends(posts(spark, d) if source is None else source, as_of(spark, d), by=by, terms=TERMS)


def _flat_trends(t: DataFrame, by=()) -> DataFrame:
    related = F.array_join("related_keywords", ", ").alias("related_keywords")
    columns = ["rank", "topic", "mentions", "velocity", "sentiment", "direction", "confidence"]
    return rounded(t.select(*by, *columns, "peak_time", related))


def keyword_trends(spark, d):
    return _flat_trends(_trends(spark, d))


def keyword_trends_by_platform(spark, d):
    return _flat_trends(_trends(spark, d, BY), BY)


def trend_peak_hour(spark, d):
    return rounded(_trends(spark, d).select("topic", "peak_time"))


def related_keywords(spark, d):
    """Related keywords of the thirty most frequent two-word phrases of the documents."""
    texts = table(spark, d, "documents").select(X.words(F.lower("text")).alias("_words"))
    following = F.slice("_words", 2, F.size("_words"))
    pairs = F.zip_with("_words", following, lambda a, b: F.when(b.isNotNull(), F.concat_ws(" ", a, b)))
    phrases = texts.select(F.explode(F.array_compact(pairs)).alias("keyword"))
    counts = phrases.groupBy("keyword").agg(F.count("*").alias("n"))
    ranked = common.top_rows(counts, 30, [F.desc("n"), F.asc("keyword")])
    related = trends.related_keywords(ranked)
    return related.select("rank", "keyword", F.array_join("related_keywords", ", ").alias("related_keywords"))


def _hashtags(spark, d) -> DataFrame:
    return trends.hashtag_trends(tagged_events(spark, d), as_of(spark, d))


def hashtag_trends(spark, d):
    return rounded(
        _hashtags(spark, d).select(
            "hashtag", "current_mentions", "previous_mentions", "growth_rate",
            F.array_join("platforms", ",").alias("platforms"), "sentiment_score", "engagement_rate",
            "geographic_spread", "trend_score", "velocity", "prediction", "category",
            F.array_join("related_keywords", ",").alias("related_keywords"),
        ),
        digits=8,
    )


def _topics(spark, d) -> DataFrame:
    return trends.emerging_topics(posts(spark, d), heads=HEADS)


def emerging_topics(spark, d):
    return rounded(_topics(spark, d))


def content_velocity(spark, d):
    return rounded(trends.content_velocity(posts(spark, d)))


def velocity_trend(spark, d):
    return trends.velocity_trend(_event_posts(spark, d).withColumn("date", F.lit(None).cast("string")))


def _trend_parts(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    p = shared_posts(spark, d)
    return _hashtags(spark, d), trends.emerging_topics(p, heads=HEADS), trends.content_velocity(p)


def trend_summary(spark, d):
    return rounded(trends.trend_summary(*_trend_parts(spark, d)))


def trend_advice(spark, d):
    return trends.trend_advice(*_trend_parts(spark, d))


def trend_run(spark, d):
    run = trends.trend_run(
        materialize(tagged_events(spark, d), "events"), shared_posts(spark, d), as_of(spark, d), heads=HEADS
    )
    return run.groupBy("section").agg(F.count("*").alias("rows"))


# --- insights and recommendations -------------------------------------------


def insight_lines(spark, d):
    p = readings(counted_posts(spark, d), terms=TERMS)
    return insights.insights(p, trends.keyword_trends(p, as_of(spark, d), ranked=RANKED))


def scored_insights(spark, d):
    """Per platform, from its sentiment, its first trend and its busiest hour."""
    p = shared_posts(spark, d)
    moods = stats.sentiment_distribution(p, BY).select(
        *BY, (F.col("positive") * 100).alias("positive_pct"), (F.col("negative") * 100).alias("negative_pct")
    )
    top = _trends(spark, d, BY, p).where("rank = 1").select(
        *BY, F.col("topic").alias("top_topic"), F.col("mentions").alias("top_mentions")
    )
    hour = B.peak_hours(p, 1, BY).select(*BY, F.col("hour").alias("top_hour"))
    figures = common.side_by_side([moods, top, hour], BY)
    return insights.scored_insights(figures, BY)


def analytics_report(spark, d):
    r = report.analytics_report(counted_posts(spark, d), as_of(spark, d), terms=TERMS)
    return rounded(
        r.select(
            "period_start", "period_end", "total_articles", "total_mentions",
            F.array_join(F.transform("top_trends", lambda t: t["topic"]), ",").alias("topics"),
            F.col("sentiment_distribution.positive").alias("positive"),
            F.col("sentiment_distribution.negative").alias("negative"),
            F.col("sentiment_distribution.neutral").alias("neutral"),
            F.array_join(F.transform(F.map_entries("source_breakdown"), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("sources"),
            F.array_join("insights", " | ").alias("insights"),
        )
    )


def report_json(spark, d):
    j = report.report_json(report.analytics_report(counted_posts(spark, d), as_of(spark, d), terms=TERMS))
    get = lambda path, name: F.get_json_object("json", path).alias(name)
    return j.select(
        get("$.period_start", "period_start"), get("$.total_articles", "total_articles"),
        get("$.total_mentions", "total_mentions"), get("$.top_trends[0].topic", "first_topic"),
        get("$.insights[0]", "first_insight"),
    )


def _figures(spark, d, by=(), source=None) -> DataFrame:
    sources = stats.source_counts(posts(spark, d) if source is None else source, by)
    return sources.groupBy(*by).agg(F.sum("n").alias("total_articles"), F.count("*").alias("source_groups"))


def _flat_recommendations(df: DataFrame, by=()) -> DataFrame:
    hashtags = F.array_join("hashtags", " ").alias("hashtags")
    columns = [c for c in df.columns if c not in (*by, "hashtags", "rule_order")]
    return rounded(df.select(*by, *columns, hashtags))


def recommend_trends(spark, d):
    return _flat_recommendations(recommend.recommend_trends(_trends(spark, d), as_of(spark, d)))


def recommend_sentiment(spark, d):
    return _flat_recommendations(
        recommend.recommend_sentiment(stats.sentiment_distribution(posts(spark, d), BY), as_of(spark, d), BY), BY
    )


def recommend_engagement(spark, d):
    return _flat_recommendations(recommend.recommend_engagement(_figures(spark, d, BY), as_of(spark, d), BY), BY)


def recommend_timing(spark, d):
    return _flat_recommendations(recommend.recommend_timing(_figures(spark, d, BY), as_of(spark, d), by=BY), BY)


def recommend_fallback(spark, d):
    """Sources are communities; those with a post on the newest platform hour count as analysed."""
    communities = table(spark, d, "documents").select("source")
    analyzed = posts(spark, d).where(F.col("shares") == 6).where(F.col("likes") > 100).select("source")
    rows = recommend.recommend_fallback(communities, analyzed, as_of(spark, d), ["source"])
    return _flat_recommendations(rows, ["source"])


def _all_recommendations(spark, d, by=()) -> DataFrame:
    # Only the trends read the texts, and once; what the figures read is written without them.
    p = materialize(posts(spark, d).select("source", "platform", "date", "sentiment_polarity"), "posts")
    return recommend.recommend_all(
        _trends(spark, d, by), stats.sentiment_distribution(p, by), _figures(spark, d, by, p), as_of(spark, d), by
    )


def recommend_all(spark, d):
    return _flat_recommendations(_all_recommendations(spark, d))


def recommend_all_by_platform(spark, d):
    return _flat_recommendations(_all_recommendations(spark, d, BY), BY)


def recommendation_bands(spark, d):
    return recommend.recommendation_bands(_all_recommendations(spark, d, BY), BY).drop("json")


def recommendations_by_analysis(spark, d):
    _, analyses, recommendations = _stored(spark, d)
    joined = store.recommendations_by_analysis(recommendations, analyses)
    return rounded(joined.select("analysis_id", "recommendation_type", "priority", "analyzed_at"))


# --- sources and sinks ------------------------------------------------------


def _payload(spark, d, value: Column) -> DataFrame:
    return posts(spark, d).select("ingest_seq", F.to_json(value).alias("value"))


def _seconds(column: str = "event_time") -> Column:
    return F.unix_timestamp(column)


def quarantined_records(spark, d):
    """Every document as a landed record, some cut off, some with a field of another type, some in an array: its post, or why there is none."""
    n = F.col("doc_id")
    line = F.to_json(F.struct(n.cast("string").alias("id"), F.col("lang").alias("title"), F.col("n_chars").alias("score")))
    value = (
        F.when(n % 10 == 3, F.expr("substring(line, 1, length(line) - 5)"))
        .when(n % 10 == 7, F.regexp_replace("line", r'"score":\d+', '"score":"many"'))
        .when(n % 10 == 9, F.concat(F.lit("["), "line", F.lit("]")))
        .otherwise(F.col("line"))
    )
    lines = table(spark, d, "documents").select("doc_id", line.alias("line")).select("doc_id", value.alias("value"))
    good, bad = split_records(as_records(lines), payloads.REDDIT)
    posts = good.select("doc_id", F.col("id").alias("post_id"), "title", "score", F.lit(None).cast("string").alias("reason"))
    return posts.unionByName(bad.select("doc_id", "reason"), allowMissingColumns=True)


def ingest_reddit(spark, d):
    n = F.col("ingest_seq")
    body = F.struct(
        F.col("post_id").alias("id"), "title", F.when(n % 3 == 0, "").otherwise(F.col("content")).alias("selftext"),
        "url", F.concat(F.lit("/r/x/"), "post_id").alias("permalink"), F.when(n % 10 != 9, F.col("author")).alias("author"),
        F.col("likes").alias("score"), F.col("comments").alias("num_comments"), _seconds().alias("created_utc"),
        (n % 2 == 0).alias("is_self"), F.concat(F.lit("r/"), "platform").alias("subreddit"),
        F.transform(
            F.slice(X.words(F.coalesce("content", F.lit(""))), 1, 7),
            lambda w, i: F.struct(w.alias("body"), i.cast("long").alias("score"), _seconds().alias("created_utc")),
        ).alias("comments"),
    )
    lines = payloads.parse_json(_payload(spark, d, body), payloads.REDDIT)
    p = payloads.reddit_posts(lines, as_of(spark, d))
    return p.select(
        "ingest_seq", "post_id", "title", F.md5("content").alias("content_md5"), "permalink", "author", "subreddit",
        "score", "num_comments", "created_at", "post_type", F.size("top_comments").alias("n_comments"),
        F.get("top_comments", F.lit(0))["author"].alias("first_comment_author"),
    )


def ingest_stackoverflow(spark, d):
    n = F.col("ingest_seq")
    item = F.struct(
        n.alias("question_id"), "title", F.concat(F.lit("<p>"), F.col("content"), F.lit(" &lt;b&gt;</p>")).alias("body"),
        F.col("url").alias("link"), F.struct(F.when(n % 10 != 9, F.col("author")).alias("display_name"), F.col("comments").alias("reputation")).alias("owner"),
        F.col("likes").alias("score"), _seconds().alias("creation_date"), _seconds().alias("last_activity_date"),
        F.col("hashtags").alias("tags"), (n % 2 == 0).alias("is_answered"),
    )
    lines = payloads.parse_json(
        _payload(spark, d, F.struct(F.col("platform").alias("keyword"), F.array(item).alias("items"))), payloads.STACKOVERFLOW
    )
    p = payloads.stackoverflow_posts(lines, as_of(spark, d))
    return p.select(
        "post_id", "title", F.md5("content").alias("content_md5"), F.length("content").alias("content_length"), "author",
        "author_reputation", "score", "view_count", "created_at", F.array_join("tags", ",").alias("tags"),
        "is_answered", "keyword_searched",
    )


def ingest_hackernews(spark, d):
    n = F.col("ingest_seq")
    body = F.struct(
        n.alias("id"), "title", F.col("content").alias("text"), "url", F.when(n % 10 != 9, F.col("author")).alias("by"),
        F.col("likes").alias("score"), F.when(n % 4 != 0, F.col("comments")).alias("descendants"), _seconds().alias("time"),
    )
    p = payloads.hackernews_posts(payloads.parse_json(_payload(spark, d, body), payloads.HACKERNEWS), as_of(spark, d))
    return p.select(
        "post_id", "title", F.md5("content").alias("content_md5"), "permalink", "author", "score", "comment_count",
        "created_at", "story_type",
    )


def ingest_tweets(spark, d):
    n = F.col("ingest_seq")
    body = F.struct(
        n.alias("id"), F.col("content").alias("full_text"),
        F.struct(F.col("author").alias("screen_name"), F.col("comments").alias("followers_count"), F.when(n % 2 == 0, "").otherwise(F.col("platform")).alias("location")).alias("user"),
        "created_at", F.col("likes").alias("favorite_count"), F.col("shares").alias("retweet_count"),
        F.when(n % 3 == 0, F.col("comments")).alias("reply_count"),
        F.struct(
            F.transform("hashtags", lambda h: F.struct(h.alias("text"))).alias("hashtags"),
            F.array(F.struct(F.col("author").alias("screen_name"))).alias("user_mentions"),
            F.array(F.struct(F.col("url").alias("expanded_url"))).alias("urls"),
        ).alias("entities"),
        F.when(n % 5 == 0, F.struct(n.alias("id"))).alias("retweeted_status"), F.lit("en").alias("lang"),
        F.col("category").alias("keyword"),
    )
    p = payloads.tweet_posts(payloads.parse_json(_payload(spark, d, body), payloads.TWEET), as_of(spark, d))
    return p.select(
        "post_id", F.md5("content").alias("content_md5"), "username", "user_followers", "created_at", "likes", "retweets",
        "replies", F.array_join("hashtags", ",").alias("hashtags"), F.array_join("mentions", ",").alias("mentions"),
        F.array_join("urls", ",").alias("urls"), "is_retweet", "location", "keyword_searched",
    )


def _xml_text(column: Column) -> Column:
    return F.replace(F.replace(column, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def ingest_rss(spark, d):
    """Each document is a feed whose entries are its sentences."""
    entry = lambda s, i: F.concat(
        F.lit("<item><title>Entry "), i.cast("string"), F.lit("</title><description>"), _xml_text(F.trim(s)),
        F.lit("</description><link>https://ex.org/"), i.cast("string"), F.lit("</link></item>"),
    )
    feeds = table(spark, d, "documents").select(
        F.col("doc_id").alias("ingest_seq"),
        F.concat(
            F.lit("<channel><title>"), F.col("source"), F.lit("</title>"),
            F.array_join(F.transform(X.sentences(F.regexp_replace("text", r"[^\p{L}\p{N} .&<]", " ")), entry), ""),
            F.lit("</channel>"),
        ).alias("value"),
    )
    a = payloads.feed_articles(payloads.parse_feeds(feeds), as_of(spark, d))
    return a.select("ingest_seq", "position", "title", F.md5("content").alias("content_md5"), "url", "source", "author", "date", "category")


def ingest_trending(spark, d):
    words = X.words(F.col("text"))
    feed = F.struct(
        F.transform(
            words,
            lambda w: F.struct(
                F.concat(F.lit("#"), w).alias("name"), F.when(F.length(w) % 2 == 0, F.length(w).cast("long")).alias("tweet_volume")
            ),
        ).alias("trends")
    )
    lines = table(spark, d, "documents").select(F.col("doc_id").alias("ingest_seq"), F.to_json(feed).alias("value"))
    tags = payloads.trending_tags(payloads.parse_json(lines, payloads.TRENDING), as_of(spark, d))
    return tags.select("ingest_seq", "rank", "name", "url", "tweet_volume", "source")


def _articles(profile: str) -> Query:
    def run(spark, d):
        found = html.extract_articles(table(spark, d, "pages"), as_of(spark, d), profile)
        return found.select("page_id", "position", "title", "content", "url", "source", "author", "category")

    return run


def extract_articles_blocks(spark, d):
    """Pages with each article shown as a block of the front page that lists it."""
    block = F.replace(
        F.replace("html", F.lit("<article>"), F.lit('<div class="post-block"><h2 class="post-block__title"><a href="/x">Story</a></h2><div class="post-block__content">')),
        F.lit("</article>"), F.lit("</div></div>"),
    )
    pages = table(spark, d, "pages").withColumn("html", block)
    found = html.extract_articles(pages, as_of(spark, d), "blocks")
    return found.select("page_id", "position", "title", "content", "url", "source", "author", "category")


def extract_articles_light(spark, d):
    """Pages whose article element carries a class, as the light profile wants it."""
    pages = table(spark, d, "pages").withColumn("html", F.replace("html", F.lit("<article>"), F.lit('<article class="MainArticle">')))
    found = html.extract_articles(pages, as_of(spark, d), "light")
    return found.select("page_id", "position", "title", "content", "url", "source")


def keyword_search(spark, d):
    found = payloads.keyword_search(posts(spark, d), TERMS, normalize_datetime(F.col("date")), n=15)
    return found.select("keyword_searched", "rank", "ingest_seq", F.array_join("keywords_matched", ",").alias("keywords_matched"))


def _raw(spark, d) -> DataFrame:
    p = posts(spark, d)
    raw = store.raw_envelope(p, F.coalesce("source", F.lit("Unknown")), F.lit("posts"), F.col("event_time"))
    return raw.withColumn("id", F.get_json_object("metadata", "$.ingest_seq").cast("long"))


def raw_envelope(spark, d):
    return rounded(
        _raw(spark, d).select(
            "id", "source", "type", F.md5("content").alias("content_md5"),
            F.get_json_object("metadata", "$.title").alias("title"),
            F.get_json_object("metadata", "$.likes").cast("long").alias("likes"), "timestamp", "processed",
        )
    )


def load_raw(spark, d):
    return rounded(store.load_raw(_raw(spark, d), "src3").select("id", "source", "timestamp"))


def load_latest_analysis(spark, d):
    """The latest of one analysis per hour."""
    p = posts(spark, d)
    hourly = p.groupBy(F.date_trunc("hour", "event_time").alias("timestamp")).agg(F.count("*").alias("total_items"))
    analyses = store.analysis_rows(hourly.withColumn("analysis_id", F.concat(F.lit("analysis_"), F.date_format("timestamp", "yyyyMMdd_HH"))))
    latest = store.load_analysis(analyses)
    return rounded(latest.select("analysis_id", F.get_json_object("results", "$.total_items").cast("long").alias("total_items"), "timestamp"))


def upsert_analysis(spark, d):
    """Hourly analyses, those of even hours written again with one more item, on disk."""
    p = posts(spark, d)
    hourly = p.groupBy(F.date_trunc("hour", "event_time").alias("timestamp")).agg(F.count("*").alias("total_items"))
    named = hourly.withColumn("analysis_id", F.date_format("timestamp", "yyyyMMdd_HH"))
    again = named.where(F.hour("timestamp") % 2 == 0).withColumn("total_items", F.col("total_items") + 1)
    path = work_folder(spark, "analyses")
    store.upsert_analyses(store.analysis_rows(named), path)
    store.upsert_analyses(store.analysis_rows(again), path)
    stored = store.read_analyses(spark, path)
    return stored.select("analysis_id", F.get_json_object("results", "$.total_items").cast("long").alias("total_items"))


def export_csv(spark, d):
    path = work_folder(spark, "csv")
    store.export_csv(posts(spark, d).select("ingest_seq", "source", "platform", "likes", "hashtags", "url"), path)
    back = spark.read.option("header", True).option("escape", '"').schema(
        "ingest_seq long, source string, platform string, likes long, hashtags string, url string"
    ).csv(path)
    return back


# --- unions and cycles ------------------------------------------------------


def _sources(spark, d, p: DataFrame) -> dict[str, DataFrame]:
    """Each platform's posts as its own source, with the columns that source has."""
    common_columns = ["ingest_seq", "post_id", "platform", "content", "created_at"]
    return {
        "reddit": p.where("platform = 'reddit'").select(*common_columns, "title", "author", F.lit("Reddit").alias("source"), F.col("likes").alias("score")),
        "quora": p.where("platform = 'quora'").select(*common_columns, "title", "author", F.lit("Quora").alias("source")),
        "twitter": p.where("platform = 'twitter'").select(*common_columns, "username", F.lit("Twitter").alias("source"), "likes", "hashtags"),
        "linkedin": p.where("platform = 'linkedin'").select(*common_columns, "username", F.lit("LinkedIn").alias("source"), "likes"),
        "news": table(spark, d, "documents").select(
            F.col("doc_id").alias("ingest_seq"), F.col("doc_id").cast("string").alias("post_id"), F.lit("news").alias("platform"),
            F.col("text").alias("content"), F.array_join(F.slice(X.words(F.col("text")), 1, 8), " ").alias("title"),
            F.col("source"), F.lit("news").alias("category"),
        ),
    }


def unified_posts(spark, d):
    """All sources in one schema, exact copies and invalid posts removed; counts per platform."""
    s = _sources(spark, d, materialize(posts(spark, d), "posts"))  # read by each source, twice
    union = payloads.union_sources([s["news"], s["twitter"], s["linkedin"], s["reddit"], s["quora"]])
    rich = cycle.collect_posts(union, as_of(spark, d), near=False, lexicon=lexicon(spark))
    return rich.groupBy("platform").agg(F.count("*").alias("posts"), F.sum("word_count").alias("words"))


def unified_by_family(spark, d):
    s = _sources(spark, d, posts(spark, d))
    families = {"news": [s["news"]], "social": [s["twitter"], s["linkedin"]], "forums": [s["reddit"], s["quora"]]}
    frames = [payloads.union_sources(f).withColumn("family", F.lit(name)) for name, f in families.items()]
    union = frames[0].unionByName(frames[1]).unionByName(frames[2])
    return union.groupBy("family", "source").agg(F.count("*").alias("posts"), F.count("title").alias("titles"))


def cycle_analysis(spark, d):
    analysis = cycle.analyze(counted_posts(spark, d), as_of(spark, d), terms=TERMS)
    return rounded(cycle.analysis_rows(analysis))


def cycle_summary(spark, d):
    """A cycle over the posts with exact dedupe, which SQL can express, and scored sentiment."""
    now = as_of(spark, d)
    collected = materialize(posts(spark, d), "posts")  # read by the hashes and by the posts that they leave
    enriched = cycle.enriched_posts(collected, now, near=False, lexicon=lexicon(spark))
    analysis = cycle.analyze(enriched, now, terms=TERMS)
    return cycle.cycle_summary(enriched, analysis, cycle.recommend(analysis, now), now)


def cycle_stored(spark, d):
    """The analysis of a cycle, stored and read back."""
    path = work_folder(spark, "details")
    rows = cycle.analysis_rows(cycle.analyze(counted_posts(spark, d), as_of(spark, d), terms=TERMS))
    store.save_details(rows.withColumn("analysis_id", F.lit("analysis_1")), path)
    return rounded(store.read_details(spark, path))


def cycle_near(spark, d):
    """A whole cycle over the posts, with near dedupe and scored sentiment."""
    return cycle.run_cycle(posts(spark, d), as_of(spark, d), lexicon=lexicon(spark))


# --- streams ----------------------------------------------------------------


def _post_stream(spark, d) -> DataFrame:
    """The documents, one file or a folder of files, as a stream of posts.

    The path is a pattern, since Spark takes a plain one for a folder.
    """
    schema = table(spark, d, "documents").schema
    return _as_posts(spark, d, spark.readStream.schema(schema).parquet(f"{d}/documents.parque[t]"))


def _as_posts(spark, d, stream: DataFrame) -> DataFrame:
    """A stream of documents joined to the events as a table, shaped like posts."""
    events = table(spark, d, "events")
    t = F.col("ts").cast("timestamp")
    joined = stream.join(events, stream.doc_id == events.event_id)
    return joined.select(
        F.col("doc_id").alias("ingest_seq"), F.col("doc_id").cast("string").alias("post_id"), "source",
        F.array_join(F.slice(X.words(F.col("text")), 1, 8), " ").alias("title"), F.col("text").alias("content"),
        iso(t).alias("created_at"), t.alias("event_time"),
        F.round(F.least(F.lit(1.0), (F.col("value") - 50) / 100), 4).alias("sentiment_polarity"),
    )


def stream_hourly(spark, d):
    out, state = work_folder(spark, "hourly"), work_folder(spark, "state")
    jobs.run_available(jobs.hourly_buckets(_post_stream(spark, d)), out, state).awaitTermination()
    return rounded(spark.read.schema("hour timestamp, posts long, avg_sentiment double").parquet(out))


def stream_dedupe(spark, d):
    """Documents landed as several files, three to a batch; copies in different batches are found as well."""
    landed, out, state = (work_folder(spark, n) for n in ("landed", "unique", "state"))
    documents = table(spark, d, "documents")
    documents.write.parquet(landed)
    stream = spark.readStream.schema(documents.schema).option("maxFilesPerTrigger", 3).parquet(landed)
    jobs.run_dedupe(_as_posts(spark, d, stream), out, state, buckets=16).awaitTermination()
    return spark.read.schema("content_hash string, batch long").parquet(out).select("content_hash")


def stream_cycle(spark, d):
    analyses, recommendations, state = (work_folder(spark, n) for n in ("analyses", "recommendations", "state"))
    now = as_of(spark, d)
    stream = conform(_post_stream(spark, d), keep_extra=False)
    jobs.run_cycles(stream, lambda batch: now, analyses, recommendations, state, near=False).awaitTermination()
    stored = store.read_analyses(spark, analyses)
    get = lambda name: F.get_json_object("results", f"$.{name}").cast("long").alias(name)
    return stored.select("analysis_id", get("total_items_collected"), get("sources_accessed"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        normalize_dates, event_hour, clean_text, extract_entities, content_hash, pair_similarity, validate_posts,
        rejection_reasons, sentiment_label, readability, text_stats, lexicon_sentiment, detect_language, enrich_posts,
        extract_keywords, text_items, period_filter, hashtag_category, hashtag_related, topic_category, url_site,
        dedupe_exact, dedupe_near, clean_frame, basic_stats, basic_stats_by_platform, source_counts, category_counts,
        word_count_stats, sentiment_stats, hourly_sentiment, sentiment_distribution, sentiment_by_source,
        engagement_score, peak_hour_of_day, storage_stats, community_health, length_buckets, hashtag_performance,
        unique_users, top_users, peak_hours, peak_days, top_content, top_content_by_platform, activity_spikes,
        sentiment_anomalies, topic_predictions, engagement_forecast, competitor_mentions, competitor_contexts,
        advanced_analysis, keyword_trends, keyword_trends_by_platform, trend_peak_hour, related_keywords,
        hashtag_trends, emerging_topics, content_velocity, velocity_trend, trend_summary, trend_advice, trend_run,
        scored_insights, analytics_report, report_json, recommend_trends, recommend_sentiment, recommend_engagement,
        recommend_timing, recommend_fallback, recommend_all, recommend_all_by_platform, recommendation_bands,
        recommendations_by_analysis, ingest_reddit, ingest_stackoverflow, ingest_hackernews, ingest_tweets,
        quarantined_records, ingest_rss, ingest_trending, extract_articles_blocks, extract_articles_light, keyword_search, raw_envelope,
        load_raw, load_latest_analysis, upsert_analysis, export_csv, unified_posts, unified_by_family, cycle_analysis,
        cycle_summary, cycle_stored, cycle_near, stream_hourly, stream_dedupe, stream_cycle,
    )
}
QUERIES["insights"] = insight_lines
QUERIES["extract_articles"] = _articles("generic")
