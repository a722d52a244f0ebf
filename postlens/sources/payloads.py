"""Source payloads as rows of the canonical post schema.

Each source has a payload schema, a function from payload rows to posts, and a
reader over landed files. Readers take a fixed schema, so nothing is inferred.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.functions import text as X
from postlens.functions.dates import as_time, iso
from postlens.schema import conform
from postlens.sources.quarantine import landed_records, split_records

REDDIT = (
    "id string, title string, selftext string, url string, permalink string, author string, score long, "
    "num_comments long, upvote_ratio double, created_utc long, link_flair_text string, is_self boolean, "
    "is_video boolean, domain string, subreddit string, "
    "comments array<struct<body string, score long, author string, created_utc long>>"
)
STACKOVERFLOW = (
    "keyword string, items array<struct<question_id long, title string, body string, link string, "
    "owner struct<display_name string, reputation long>, score long, view_count long, answer_count long, "
    "comment_count long, creation_date long, last_activity_date long, tags array<string>, is_answered boolean, "
    "accepted_answer_id long>>"
)
HACKERNEWS = "id long, title string, text string, url string, `by` string, type string, score long, descendants long, time long"
TWEET = (
    "id long, full_text string, user struct<screen_name string, followers_count long, location string>, "
    "created_at string, favorite_count long, retweet_count long, reply_count long, "
    "entities struct<hashtags array<struct<text string>>, user_mentions array<struct<screen_name string>>, "
    "urls array<struct<expanded_url string>>>, retweeted_status struct<id long>, lang string, keyword string"
)
TRENDING = "trends array<struct<name string, url string, tweet_volume long>>"
FEED = (
    "title string, item array<struct<title string, summary string, description string, link string, "
    "author string, published string, pubDate string>>"
)

FEED_ENTRIES = 10
FEED_SUMMARY = 1000
QUESTION_BODY = 1000
TOP_COMMENTS = 5
TRENDING_TAGS = 20


def _time(seconds: Column) -> Column:
    return iso(F.timestamp_seconds(F.coalesce(seconds, F.lit(0))))


def _or(column: str, default) -> Column:
    return F.coalesce(F.col(column), F.lit(default))


def _sequence() -> Column:
    """Order of ingest: file partition, then position. It is unique, not dense."""
    return F.monotonically_increasing_id()


def reddit_posts(payload: DataFrame, as_of) -> DataFrame:
    author = F.coalesce("author", F.lit("[deleted]"))
    comments = F.transform(
        F.slice(F.coalesce("comments", F.array().cast("array<struct<body string, score long, author string, created_utc long>>")), 1, TOP_COMMENTS),
        lambda c: F.struct(
            c["body"].alias("body"), c["score"].alias("score"),
            F.coalesce(c["author"], F.lit("[deleted]")).alias("author"), _time(c["created_utc"]).alias("created_at"),
        ),
    )
    return payload.select(
        "ingest_seq",
        F.col("id").alias("post_id"),
        "title",
        F.coalesce(F.nullif("selftext", F.lit("")), "title").alias("content"),
        "url",
        F.concat(F.lit("https://reddit.com"), "permalink").alias("permalink"),
        author.alias("author"),
        X.bare_subreddit(F.col("subreddit")).alias("subreddit"),
        "score",
        "upvote_ratio",
        "num_comments",
        _time(F.col("created_utc")).alias("created_at"),
        F.col("link_flair_text").alias("flair"),
        "is_self",
        "is_video",
        "domain",
        F.lit("Reddit").alias("source"),
        F.lit("reddit").alias("platform"),
        as_time(as_of).alias("scraped_at"),
        F.when(F.col("is_self"), "self_post").otherwise("link_post").alias("post_type"),
        comments.alias("top_comments"),
    )


def stackoverflow_posts(payload: DataFrame, as_of) -> DataFrame:
    items = payload.select("ingest_seq", "keyword", F.posexplode("items").alias("position", "q"))
    q = F.col("q")
    return items.select(
        "ingest_seq",
        q["question_id"].cast("string").alias("post_id"),
        F.coalesce(q["title"], F.lit("")).alias("title"),
        F.substring(X.strip_tags(F.coalesce(q["body"], F.lit(""))), 1, QUESTION_BODY).alias("content"),
        F.coalesce(q["link"], F.lit("")).alias("url"),
        F.coalesce(q["owner"]["display_name"], F.lit("Anonymous")).alias("author"),
        F.coalesce(q["owner"]["reputation"], F.lit(0)).alias("author_reputation"),
        F.coalesce(q["score"], F.lit(0)).alias("score"),
        F.coalesce(q["view_count"], F.lit(0)).alias("view_count"),
        F.coalesce(q["answer_count"], F.lit(0)).alias("answer_count"),
        F.coalesce(q["comment_count"], F.lit(0)).alias("comment_count"),
        _time(q["creation_date"]).alias("created_at"),
        _time(q["last_activity_date"]).alias("last_activity"),
        F.coalesce(q["tags"], F.array().cast("array<string>")).alias("tags"),
        F.coalesce(q["is_answered"], F.lit(False)).alias("is_answered"),
        q["accepted_answer_id"].alias("accepted_answer_id"),
        F.lit("StackOverflow").alias("source"),
        F.lit("stackoverflow").alias("platform"),
        F.col("keyword").alias("keyword_searched"),
        as_time(as_of).alias("scraped_at"),
    )


def hackernews_posts(payload: DataFrame, as_of) -> DataFrame:
    return payload.select(
        "ingest_seq",
        F.col("id").cast("string").alias("post_id"),
        _or("title", "").alias("title"),
        _or("text", "").alias("content"),
        _or("url", "").alias("url"),
        F.concat(F.lit("https://news.ycombinator.com/item?id="), F.col("id").cast("string")).alias("permalink"),
        _or("by", "Anonymous").alias("author"),
        _or("score", 0).alias("score"),
        _or("descendants", 0).alias("comment_count"),
        _time(F.col("time")).alias("created_at"),
        _or("type", "story").alias("story_type"),
        F.lit("Hacker News").alias("source"),
        F.lit("hackernews").alias("platform"),
        as_time(as_of).alias("scraped_at"),
    )


def tweet_posts(payload: DataFrame, as_of) -> DataFrame:
    def names(entity: str, field: str) -> Column:
        return F.transform(F.col(f"entities.{entity}"), lambda e: e[field]).alias(
            {"user_mentions": "mentions"}.get(entity, entity)
        )

    return payload.select(
        "ingest_seq",
        F.col("id").cast("string").alias("post_id"),
        F.col("full_text").alias("content"),
        F.col("user.screen_name").alias("username"),
        F.col("user.followers_count").alias("user_followers"),
        "created_at",
        F.col("favorite_count").alias("likes"),
        F.col("retweet_count").alias("retweets"),
        _or("reply_count", 0).alias("replies"),
        names("hashtags", "text"),
        names("user_mentions", "screen_name"),
        names("urls", "expanded_url"),
        F.lit("Twitter").alias("source"),
        F.lit("twitter").alias("platform"),
        F.col("keyword").alias("keyword_searched"),
        as_time(as_of).alias("scraped_at"),
        F.col("retweeted_status").isNotNull().alias("is_retweet"),
        F.col("lang").alias("language"),
        F.nullif(F.col("user.location"), F.lit("")).alias("location"),
    )


def trending_tags(payload: DataFrame, as_of, n: int = TRENDING_TAGS) -> DataFrame:
    """Feed order is rank; an absent volume is zero."""
    tags = payload.select("ingest_seq", F.posexplode(F.slice("trends", 1, n)).alias("_i", "t"))
    return tags.select(
        "ingest_seq",
        F.col("t.name").alias("name"),
        F.coalesce("t.url", F.lit("")).alias("url"),
        F.coalesce("t.tweet_volume", F.lit(0)).alias("tweet_volume"),
        F.lit("Twitter Trends").alias("source"),
        as_time(as_of).alias("collected_at"),
        (F.col("_i") + 1).alias("rank"),
    )


def feed_articles(payload: DataFrame, as_of, entries: int = FEED_ENTRIES) -> DataFrame:
    """The first entries of each feed; a feed is one row, so its order is the array's."""
    now = as_time(as_of)
    rows = payload.select(
        "ingest_seq", F.col("title").alias("_feed"), F.posexplode(F.slice("item", 1, entries)).alias("position", "e")
    )
    summary = F.coalesce("e.summary", "e.description", F.lit(""))
    return rows.select(
        "ingest_seq",
        "position",
        F.coalesce("e.title", F.lit("")).alias("title"),
        F.substring(summary, 1, FEED_SUMMARY).alias("content"),
        F.coalesce("e.link", F.lit("")).alias("url"),
        F.coalesce("_feed", F.lit("Unknown Source")).alias("source"),
        F.coalesce("e.author", F.lit("Unknown")).alias("author"),
        F.coalesce("e.published", "e.pubDate", F.date_format(now, "yyyy-MM-dd HH:mm:ss")).alias("date"),
        F.lit("RSS Feed").alias("category"),
        now.alias("scraped_at"),
    )


def parse_json(lines: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """Payload rows from JSON text already in a column, ``ingest_seq`` kept."""
    return lines.select("ingest_seq", F.from_json(column, schema).alias("_p")).select("ingest_seq", "_p.*")


def parse_feeds(lines: DataFrame, column: str = "value") -> DataFrame:
    return lines.select("ingest_seq", F.from_xml(column, FEED).alias("_p")).select("ingest_seq", "_p.*")


def _read_json(schema: str, shape: Callable[[DataFrame, object], DataFrame]):
    """A reader that numbers the posts after shaping, so that the items of one response have numbers of their own.

    Records that don't fit the schema give no post; ``quarantine`` has them.
    """

    def read(spark: SparkSession, path: str, as_of) -> DataFrame:
        payload = split_records(landed_records(spark, path), schema)[0].drop("file", "split_start")
        return shape(payload, as_of).withColumn("ingest_seq", _sequence())

    return read


read_reddit = _read_json(REDDIT, reddit_posts)
read_stackoverflow = _read_json(STACKOVERFLOW, stackoverflow_posts)
read_hackernews = _read_json(HACKERNEWS, hackernews_posts)
read_tweets = _read_json(TWEET, tweet_posts)
read_trending = _read_json(TRENDING, trending_tags)


def read_feeds(spark: SparkSession, path: str, as_of) -> DataFrame:
    payload = spark.read.format("xml").option("rowTag", "channel").schema(FEED).load(path)
    return feed_articles(payload.withColumn("ingest_seq", _sequence()), as_of).withColumn("ingest_seq", _sequence())


def newest_per_keyword(found: DataFrame, n: int, order: str = "ingest_seq") -> DataFrame:
    """The ``n`` newest posts of each searched keyword; each partition is cut to n before the shuffle."""
    newest = Window.partitionBy("keyword_searched").orderBy(F.desc_nulls_last("_when"), F.asc(order))
    return found.withColumn("rank", F.row_number().over(newest)).where(F.col("rank") <= n).drop("_when")


def keyword_search(posts: DataFrame, keywords, when: Column, n: int = 3) -> DataFrame:
    """Rows (keyword, post): posts whose text contains a tracked keyword, the newest ``n`` each.

    The keyword list is short and is matched inside the row, so a post is read once.
    """
    text = F.lower(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("content", F.lit(""))))
    hits = F.array_compact(F.array(*[F.when(text.contains(k.lower()), F.lit(k)) for k in keywords]))
    found = posts.select("*", when.alias("_when"), F.explode(hits).alias("_keyword"))
    tagged = found.withColumn("keyword_searched", F.col("_keyword")).withColumn(
        "keywords_matched", F.array("_keyword")
    )
    return newest_per_keyword(tagged.drop("_keyword"), n)


def union_sources(sources: list[DataFrame]) -> DataFrame:
    """Canonical posts of several sources; ``ingest_seq`` follows source order, then the source's own.

    The source number goes into the top bits, so no row is moved to number them.
    """
    shaped = []
    for i, source in enumerate(sources):
        if "ingest_seq" not in source.columns:
            raise ValueError(f"source {i} has no ingest_seq; posts without one would be lost in later joins")
        posts = conform(source)
        shaped.append(posts.withColumn("ingest_seq", F.col("ingest_seq") + F.lit(i << 56)))
    result = shaped[0]
    for posts in shaped[1:]:
        result = result.unionByName(posts)
    return result


def read_available(readers: dict[str, Callable[[], DataFrame]], log=None) -> list[DataFrame]:
    """Frames of the sources that can be read; one that fails to load is logged and skipped."""
    frames = []
    for name, read in readers.items():
        try:
            frames.append(read())
        except Exception as error:  # a missing path or a broken schema must not stop the others
            if log is not None:
                log(f"source {name} skipped: {error}")
    return frames
