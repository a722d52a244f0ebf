"""Streams over documents that are a folder of files, as large tables are."""

import datetime as dt

from postlens.plans.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EVENTS = "event_id long, user_id long, event_type string, ts timestamp, value double, props string"


def tables(spark, path, files):
    text = "One sentence of the text stands here. Another one comes after it, with words. Post number {}."
    docs = [(i, text.format("x" * i), "en", f"src{i % 3}", 90) for i in range(30)]
    start = dt.datetime(2024, 1, 1)
    events = [(i, i % 5, "view", start + dt.timedelta(minutes=20 * i), 40.0 + i, '{"k": 1}') for i in range(30)]
    spark.createDataFrame(events, EVENTS).write.parquet(f"{path}/events.parquet")
    frame = spark.createDataFrame(docs, DOCS)
    if files > 1:
        frame.repartition(files).write.parquet(f"{path}/documents.parquet")
    else:
        frame.toPandas().to_parquet(f"{path}/documents.parquet")
    return str(path)


def test_stream_reads_a_file_and_a_folder_alike(spark, tmp_path):
    one, many = tables(spark, tmp_path / "one", 1), tables(spark, tmp_path / "many", 4)
    found = [sorted(map(str, QUERIES["stream_hourly"](spark, d).collect())) for d in (one, many)]
    assert found[0] == found[1] and len(found[0]) == 7


def test_cycle_of_a_streamed_folder(spark, tmp_path):
    (row,) = QUERIES["stream_cycle"](spark, tables(spark, tmp_path, 4)).collect()
    assert tuple(row) == ("analysis_batch_0", 30, 3)


def test_unified_sources_read_posts_that_were_joined_once(spark, tmp_path):
    found = QUERIES["unified_posts"](spark, tables(spark, tmp_path, 2))
    assert "FullOuter" not in found._jdf.queryExecution().optimizedPlan().toString()
    # the others have no title; post 3 has no content
    assert {r.platform: r.posts for r in found.collect()} == {"news": 30, "reddit": 12, "quora": 5}
