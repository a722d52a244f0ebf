"""An analysis reads texts and dates in one pass; its results are those of the posts themselves."""

import datetime as dt

from pyspark.sql import functions as F

from postlens.functions import text as X
from postlens.operators import insights, readings, stats, trends
from postlens.operators.keywords import _ranked
from postlens.plans import cycle, report

NOW = dt.datetime(2024, 1, 2, 10, 0)


def posts(spark):
    texts = ["Alpha beta ALPHA, gamma!", "beta Ärger ΑΣ ΑΣΑ 一x", None, "", "  ", "alpha 'beta' delta delta"]
    dates = ["2024-01-02 09:30:00", "Tue, 02 Jan 2024 08:15:00 +0000", None, "", "n/a", "1500-03-01", "12024-01-01"]
    rows = [
        (i if i % 5 else None, "ab"[i % 2], ["s", None, ""][i % 3], texts[i % 6], [None, "A title", ""][i % 3], dates[i % 7], i % 4 / 4 - 0.5)
        for i in range(42)
    ]
    frame = spark.createDataFrame(
        rows, "ingest_seq long, c string, source string, content string, title string, date string, sentiment_polarity double"
    )
    return frame.withColumn("word_count", X.word_count(F.col("content")))


def same(one, other):
    columns = [F.col(c).cast("string") for c in one.columns]  # years beyond 9999 have no datetime
    rows = sorted(map(str, one.select(columns).collect()))
    assert rows == sorted(map(str, other.select(columns).collect())) and rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_results_of_readings_are_those_of_the_posts(spark):
    p = posts(spark)
    read = readings.readings(p, ["c"], terms=["ta"])
    assert not {"content", "title"} & set(read.columns) and read.schema["date"].dataType.typeName() == "timestamp"
    for by in ([], ["c"]):
        found = trends.keyword_trends(read, NOW, by=by, ranked=readings.RANKED)
        same(found, plain := trends.keyword_trends(p, NOW, by=by, terms=["ta"]))
        same(insights.insights(read, found, by), insights.insights(p, plain, by))
        same(stats.basic_stats(read, by, F.col("content_length")), stats.basic_stats(p, by))
        texts, plain_texts = read.where("has_text"), stats.text_items(p)
        for f in (stats.hourly_sentiment, stats.sentiment_distribution, stats.sentiment_by_source, stats.peak_hour_of_day):
            same(f(texts, by), f(plain_texts, by))


def test_an_analysis_reads_no_text_twice(spark):
    p = posts(spark).drop("c").withColumn("c", F.lit("x"))
    rows = cycle.analysis_rows(cycle.analyze(p, NOW, ["c"]), ["c"])
    for df in (rows, report.analytics_report(p, NOW, 48, ["c"])):
        assert "ArrowEvalPython" not in plan(df) and "regexp_replace" not in plan(df)
        assert df.count() > 0


def test_a_community_may_be_a_column_that_is_read(spark):
    p = posts(spark)
    for by in (["source"], ["date"]):
        same(trends.keyword_trends(readings.readings(p, by), NOW, by=by, ranked=readings.RANKED), trends.keyword_trends(p, NOW, by=by))


def test_lower_case_of_settled_texts_is_that_of_java(spark):
    chars = [chr(i) for i in [*range(0x860), *range(0x2000, 0x2140), 0x1E9E, 0x4E00, 0x1D400, 0x10400, 0xA7CB]]
    texts = [form.format(c) for c in chars for form in ("{0}", "A{0}", "A{0}B {0}")]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = frame.select("t", X.settle(F.lower("t")).alias("java"), X.settle_case(F.col("t")).alias("settled")).collect()
    assert [r.t for r in rows if X.plain(r.settled.lower()) != X.plain(r.java)] == []
    assert all(r.settled == r.t for r in rows if max(r.t) < "ΐ")


def test_words_are_counted_without_making_them():
    texts = ["", " ", "a", " a  b\t", "a\x85b\xa0c\x1cd\x1fe\x0bf", "　a b c", "\xe9 \xb5\n", "a​b c"]
    texts += [f"{x}{chr(i)}{y}" for i in range(0x300) for x in ("", "a") for y in ("", "b", " b")]
    assert [t for t in texts if X.count_words(t) != len(t.split())] == []


def test_keywords_that_come_once_follow_in_their_order():
    import pyarrow as pa

    (got,) = _ranked(1, 5, ["z"], []).func(pa.array(["d b z a b c a z e"])).to_pylist()
    assert got == {"keywords": ["b", "a", "d", "c", "e"], "hits": [2, 2, 1, 1, 1]}
