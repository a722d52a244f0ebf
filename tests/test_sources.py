"""Landed files to posts, stored tables, exports and streams."""

import datetime as dt
import json
import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

from postlens.functions import text as X
from postlens.operators.dedup import dedupe_exact
from postlens.schema import POSTS, ddl
from postlens.sources import html, payloads, store
from postlens.streaming import jobs

NOW = dt.datetime(2024, 1, 2, 3, 4, 5)


def land(tmp_path, name, rows):
    folder = tmp_path / name
    folder.mkdir()
    (folder / "part.json").write_text("\n".join(json.dumps(r) for r in rows))
    return str(folder)


def test_reddit_file(spark, tmp_path):
    comments = [{"body": f"c{i}", "score": i, "author": None, "created_utc": 0} for i in range(7)]
    rows = [
        {"id": "a", "title": "T", "selftext": "", "permalink": "/r/x/a", "created_utc": 86400, "is_self": False, "comments": comments, "subreddit": "r/ai"},
        {"id": "b", "title": "U", "selftext": "body", "author": "me", "created_utc": 0, "is_self": True},
    ]
    a, b = payloads.read_reddit(spark, land(tmp_path, "r", rows), NOW).orderBy("post_id").collect()
    assert (a.content, a.author, a.created_at, a.post_type, a.subreddit) == ("T", "[deleted]", "1970-01-02T00:00:00", "link_post", "ai")
    assert len(a.top_comments) == 5 and a.top_comments[0].author == "[deleted]"
    assert (b.content, b.author, b.post_type, b.top_comments) == ("body", "me", "self_post", [])


def test_stackoverflow_file(spark, tmp_path):
    rows = [{"keyword": "python", "items": [{"question_id": 1, "body": "<p>a &lt;b&gt; " + "x" * 2000 + "</p>"}, {"question_id": 2, "owner": {"display_name": "n", "reputation": 5}}]}]
    one, two = payloads.read_stackoverflow(spark, land(tmp_path, "s", rows), NOW).orderBy("post_id").collect()
    assert one.content.startswith("a <b> xx") and len(one.content) == 1000 and one.author == "Anonymous" and one.tags == []
    assert (two.author, two.author_reputation, two.is_answered, two.keyword_searched) == ("n", 5, False, "python")


def test_hackernews_tweets_trending(spark, tmp_path):
    story = payloads.read_hackernews(spark, land(tmp_path, "h", [{"id": 7, "by": "x", "time": 60}]), NOW).first()
    assert (story.permalink, story.author, story.story_type, story.comment_count) == ("https://news.ycombinator.com/item?id=7", "x", "story", 0)
    tweet = {"id": 1, "full_text": "t", "user": {"screen_name": "s", "followers_count": 3, "location": ""}, "entities": {"hashtags": [{"text": "h"}], "user_mentions": [], "urls": [{"expanded_url": "u"}]}, "retweeted_status": {"id": 2}}
    row = payloads.read_tweets(spark, land(tmp_path, "t", [tweet]), NOW).first()
    assert (row.hashtags, row.mentions, row.urls, row.is_retweet, row.replies, row.location) == (["h"], [], ["u"], True, 0, None)
    feed = {"trends": [{"name": f"#{i}", "tweet_volume": None} for i in range(25)]}
    tags = payloads.read_trending(spark, land(tmp_path, "f", [feed]), NOW).orderBy("rank").collect()
    assert [t.rank for t in tags] == list(range(1, 21)) and tags[0].tweet_volume == 0


def test_feed_files(spark, tmp_path):
    items = "".join(f"<item><title>t{i}</title><description>d &amp; {i}</description></item>" for i in range(12))
    (tmp_path / "feed.xml").write_text(f"<rss><channel><title>News</title>{items}</channel></rss>")
    rows = payloads.read_feeds(spark, str(tmp_path / "feed.xml"), NOW).orderBy("position").collect()
    assert len(rows) == 10 and rows[3].title == "t3" and rows[3].content == "d & 3"
    assert (rows[0].source, rows[0].author, rows[0].category, rows[0].date) == ("News", "Unknown", "RSS Feed", "2024-01-02 03:04:05")


def test_failed_source_is_skipped_and_union_keeps_order(spark, tmp_path):
    good = land(tmp_path, "g", [{"id": 1, "full_text": "t", "user": {}, "entities": {}}])
    seen = []
    frames = payloads.read_available(
        {"none": lambda: payloads.read_tweets(spark, str(tmp_path / "missing"), NOW), "tweets": lambda: payloads.read_tweets(spark, good, NOW),
         "again": lambda: payloads.read_tweets(spark, good, NOW)}, seen.append,
    )
    assert len(frames) == 2 and "none" in seen[0]
    union = payloads.union_sources(frames)
    assert union.columns == list(POSTS)
    assert union.select("ingest_seq").distinct().count() == 2


PAGE = """<html><body><article class="x"><h2> A long <b>title</b> here</h2><p>One<br> two <!-- c --> three
<script>var t="</p>";</script></p><a href="/rel">l</a></article><article><h1>short</h1></article></body></html>"""
BLOCKS = """<div class="big post-block"><h2 class="post-block__title"><a href="https://t/1">First story</a></h2>
<div class="post-block__content"> Text </div><div class="river-byline__authors">Me</div></div><div class="post-block"></div>
<div class="post-block"><h2 class="post-block__title"><a>No link</a></h2></div>"""


def test_article_profiles(spark):
    def run(page, profile):
        pages = spark.createDataFrame([(1, "https://s.org/", page), (2, "https://s.org/", None)], "page_id long, url string, html string")
        return html.extract_articles(pages, NOW, profile).orderBy("position").collect()

    (a,) = run(PAGE, "generic")
    assert (a.title, a.content, a.url, a.source, a.category) == ("A longtitlehere", "Onetwothree", "https://s.org/rel", "s.org", "General")
    first, second = run(BLOCKS, "blocks")
    assert (first.title, first.content, first.url, first.author) == ("First story", "Text", "https://t/1", "Me")
    assert (second.title, second.content, second.url, second.author) == ("No title", "", "", "Unknown")
    (light,) = run('<div class="TheArticle"><h3>A title long enough</h3> and text</div>', "light")
    assert (light.title, light.content) == ("A title long enough", "A title long enoughand text")


def test_store_replaces_an_analysis_and_reads_the_latest(spark, tmp_path):
    path = str(tmp_path / "analyses")
    rows = lambda pairs: store.analysis_rows(spark.createDataFrame(pairs, "analysis_id string, n long").withColumn("timestamp", F.timestamp_seconds("n")))
    store.upsert_analyses(rows([("a", 1), ("b", 2)]), path)
    store.upsert_analyses(rows([("a", 9)]), path)
    stored = store.read_analyses(spark, path)
    assert sorted((r.analysis_id, json.loads(r.results)["n"]) for r in stored.collect()) == [("a", 9), ("b", 2)]
    assert store.load_analysis(stored).first().analysis_id == "a"
    assert store.load_analysis(stored, "b").count() == 1 and store.load_analysis(stored, "c").count() == 0


def test_raw_table_and_csv(spark, tmp_path):
    items = spark.createDataFrame([(1, "x", ["p", "q"]), (2, None, None)], "id long, content string, tags array<string>")
    raw = store.raw_envelope(items, F.lit("news"), F.lit("articles"), NOW)
    store.save_raw(raw, str(tmp_path / "raw"), 0)
    store.save_raw(raw, str(tmp_path / "raw"), 1)
    back = store.read_raw(spark, str(tmp_path / "raw"))
    assert store.load_raw(back, "news", 3).count() == 3
    assert sorted(r.content for r in back.collect()) == ["", "", "x", "x"]
    store.export_csv(items, str(tmp_path / "csv"))
    rows = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "csv")).orderBy("id").collect()
    assert rows[0].tags == '["p","q"]'


def posts_rows():
    start = dt.datetime(2024, 1, 1)
    return [
        {"ingest_seq": i, "title": f"a title {i}", "content": f"text number {i % 7}", "sentiment_polarity": (i % 5 - 2) / 10,
         "date": (start + dt.timedelta(minutes=17 * i)).strftime("%Y-%m-%dT%H:%M:%S")}
        for i in range(60)
    ]


def test_streams_equal_batches(spark, tmp_path):
    rows = posts_rows()
    folder = tmp_path / "in"
    folder.mkdir()
    for part in range(3):
        (folder / f"{part}.json").write_text("\n".join(json.dumps(r) for r in rows[part * 20:part * 20 + 20]))
    schema = ddl() + ", sentiment_polarity double"
    stream = jobs.with_event_time(jobs.read_post_stream(spark, str(folder), schema))
    batch = jobs.with_event_time(spark.read.schema(schema).json(str(folder)))

    jobs.run_available(jobs.hourly_buckets(stream), str(tmp_path / "hours"), str(tmp_path / "c1")).awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "hours")).collect()}
    horizon = batch.agg(F.max("event_time") - F.expr("INTERVAL 2 HOURS")).first()[0]
    want = {tuple(r) for r in jobs.hourly_buckets(batch).collect() if r.hour + dt.timedelta(hours=1) <= horizon}
    assert got == want and want

    jobs.run_available(jobs.dedupe_stream(stream, lateness="30 days").select("content_hash"), str(tmp_path / "unique"), str(tmp_path / "c2")).awaitTermination()
    unique = {r[0] for r in spark.read.parquet(str(tmp_path / "unique")).collect()}
    assert unique == {r[0] for r in dedupe_exact(batch).select(X.content_hash(F.col("content"))).collect()}


def test_dedupe_across_batches_and_runs(spark, tmp_path):
    """Copies far apart in time and in different batches and runs are found."""
    rows = [{"ingest_seq": i, "content": f"text number {i % 13}" if i % 5 else None, "date": f"2024-01-{1 + i % 28:02d}T00:00:00"} for i in range(60)]
    folder = tmp_path / "posts"
    folder.mkdir()
    out, state = str(tmp_path / "kept"), str(tmp_path / "state")
    for run in range(2):
        for part in range(2 * run, 2 * run + 2):
            (folder / f"{part}.json").write_text("\n".join(json.dumps(r) for r in rows[part * 15:part * 15 + 15]))
        stream = jobs.read_post_stream(spark, str(folder), files_per_batch=1)
        jobs.run_dedupe(stream, out, state).awaitTermination()
    kept = spark.read.parquet(out)
    assert kept.select("batch").distinct().count() >= 1 and len(list((tmp_path / "kept").glob("batch=*"))) == 4
    hashes = sorted(r[0] for r in kept.select("content_hash").collect())
    batch = spark.read.schema(ddl()).json(str(folder))
    assert hashes == sorted(r[0] for r in dedupe_exact(batch).select(X.content_hash(F.col("content"))).collect())


def test_cleanup_empties_the_work_folder(tmp_path):
    """In a session of its own process, since a clean-up ends what other tests have stored."""
    code = f"""
import os
from postlens.session import cleanup, local_session, materialize
spark = local_session(cores="2", partitions=2, memory="1g")
cleanup(spark)
spark.sparkContext.setCheckpointDir({str(tmp_path)!r})
stored = materialize(spark.range(9), "stored")
assert stored.checkpoint().count() == 9
(own,) = os.listdir({str(tmp_path)!r})
own = os.path.join({str(tmp_path)!r}, own)
other = os.path.join({str(tmp_path)!r}, "other")
open(other, "w").close()
assert os.listdir(own)
cleanup(spark)
assert not os.listdir(own) and os.path.exists(other)
"""
    root = Path(__file__).parents[1]
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]


def test_cycle_stream_stores_once_per_batch(spark, tmp_path):
    text = "One sentence with some words in it. Another sentence follows here now {}."
    rows = [{"ingest_seq": i, "title": "a good title", "content": text.format(i), "source": f"s{i % 3}", "date": "2024-01-01T00:00:00"} for i in range(9)]
    source = land(tmp_path, "posts", rows)
    for _ in range(2):
        stream = jobs.read_post_stream(spark, source)
        jobs.run_cycles(stream, lambda b: NOW, str(tmp_path / "a"), str(tmp_path / "r"), str(tmp_path / "c"), near=True).awaitTermination()
    (analysis,) = store.read_analyses(spark, str(tmp_path / "a")).collect()
    found = json.loads(analysis.results)
    assert found["total_items_collected"] == 1 and found["total_recommendations"] >= 3
    assert store.read_recommendations(spark, str(tmp_path / "r")).count() == found["total_recommendations"]
