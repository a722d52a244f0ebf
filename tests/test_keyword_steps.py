"""Steps of the keyword queries: the same results as the plain forms, without their sorts and array functions."""

from pyspark.sql import functions as F

from postlens.functions import text as X
from postlens.operators import common, trends
from postlens.operators.keywords import _ranked

ODD = [None, "", "  ", "a", " a b ", "　a\x85b  c d", "a\x1cb\x1fc​d", "\ta\n\nb"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plain_texts_are_those_of_java(spark):
    chars = [chr(i) for i in [*range(0x860), *range(0x2000, 0x20D0), 0x4E00, 0x1D7CE, 0x1F600, 0xFFFD, 0x3000]]
    texts = [f"a{c}b" for c in chars] + ["né €5, 字。x!", "ÿ-þ", "a…b"]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    java = F.regexp_replace("t", r"[^\p{L}\p{N}_\t-\r\x1c-\x20\x85\p{Z}]", " ")
    rows = frame.select("t", java.alias("java"), X.settle(F.col("t")).alias("settled")).collect()
    assert [r.t for r in rows if X.plain(r.settled) != r.java] == []
    assert all(r.settled == r.t for r in rows if max(r.t) < "ࡠ")


def test_words_are_counted_without_an_array_of_them(spark):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "i int, t string")
    t = F.coalesce("t", F.lit(""))
    rows = frame.select(X.word_count(F.col("t")).alias("n"), F.size(X.words(t)).alias("same")).collect()
    assert [r.n for r in rows] == [r.same for r in rows]
    assert "split(" not in plan(frame.select(X.word_count(F.col("t"))))


def test_a_place_orders_as_a_struct_of_post_and_position(spark):
    seqs = [None, -(2**63), -1, 0, 5, 5, 2**63 - 1]
    frame = spark.createDataFrame([(s, p) for s in seqs for p in (0, 1, 2**31 - 1)], "ingest_seq long, p int")
    key = common.place(common.post_place(), F.col("p"))
    assert frame.where(key.isNull()).count() == 0
    by_struct = [tuple(r) for r in frame.orderBy(F.struct("ingest_seq", "p")).collect()]
    assert [tuple(r) for r in frame.orderBy(key).collect()] == by_struct


def test_keywords_of_posts_are_summed_by_hashing(spark):
    rows = [(None, "Beta, alpha!", "2024-01-01 09:30:00"), (1, "alpha beta", "2024-01-01 08:30:00"), (3, "beta gamma", None), (2, None, None)]
    posts = spark.createDataFrame(rows, "ingest_seq long, content string, date string").withColumns(
        {"title": F.lit(None).cast("string"), "sentiment_polarity": F.lit(0.5)}
    )
    found = trends.keyword_trends(posts, "2024-01-01 10:00:00")
    assert "partial_min(struct" not in plan(found)
    got = [(r.topic, r.mentions, str(r.peak_time)[11:13]) for r in found.collect()]
    assert got == [("beta", 3, "08"), ("alpha", 2, "08")]


def test_a_term_that_is_no_word_that_counts_comes_last():
    import pyarrow as pa

    texts = pa.array(["ai und ai und b bb c++ bb", "b-b, AB"])
    got = _ranked(2, 9, ["und"], ["und", "b", "ai", "ai"]).func(texts).to_pylist()
    assert got[0] == {"keywords": ["ai", "b", "bb", "und"], "hits": [6, 5, 2, 2]}
    assert got[1] == {"keywords": ["b", "AB"], "hits": [2, 1]}
