"""Text work is done once a post, and keywords without interpreted array functions."""

import datetime as dt
import hashlib

import pyarrow as pa
from pyspark.sql import functions as F

from postlens import constants as C
from postlens.functions import text as X
from postlens.operators import enrich
from postlens.operators.keywords import _ranked, extract_keywords
from postlens.plans import cycle


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_keywords_are_counted_outside_of_array_functions(spark):
    posts = spark.createDataFrame(
        [(1, "Beta alpha beta gamma alpha and to beta"), (2, None), (3, "  "), (4, "ai ai alpha c++ C++")], "ingest_seq long, t string"
    )
    found = extract_keywords(posts, F.col("t"), top_n=3, stop_words=["and"], terms=["ai", "alpha", "zz"])
    assert "lambda" not in plan(found)
    rows = sorted((r.ingest_seq, r["rank"], r.keyword, r.hits) for r in found.collect())
    assert rows == [(1, 1, "alpha", 4), (1, 2, "beta", 3), (1, 3, "gamma", 1), (4, 1, "alpha", 2), (4, 2, "ai", 2)]


def test_clean_articles_are_cleaned_once(spark):
    rows = [(i, f"Text of article number {i % 3}", "A title", "", "") for i in range(6)]
    frame = spark.createDataFrame(rows, "ingest_seq long, content string, title string, description string, author string")
    clean = enrich.clean_frame(frame)
    assert "_nfkd" not in plan(clean)
    assert sorted(r.ingest_seq for r in clean.collect()) == [0, 1, 2]


def test_only_texts_with_a_run_of_capitals_are_calmed(spark):
    texts = ["", None, "ABC abc", "ABCD", "xABCDEy ABC", "ÄBCDE FGHI\nJKLMN"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in frame.orderBy("i").select(X.calm_capitals(F.col("t"))).collect()]
    assert got == ["", None, "ABC abc", "ABcd", "xABcdey ABC", "ÄBCde FGhi\nJKlmn"]


def test_first_words_are_the_first_of_all_words_and_the_rest_is_not_split(spark):
    texts = [None, "", "  ", "a", " a b", "a b c ", "　a\x85b  c d", "a b c d e", "\ta  b c"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    t = F.col("t")
    for n in (1, 2, 3, 8):
        rows = frame.select(X.first_words(t, n).alias("few"), F.slice(X.words(t), 1, n).alias("same")).collect()
        assert [r.few for r in rows] == [r.same for r in rows]
    assert ", 5)" in plan(frame.select(X.first_words(t, 3)))


def test_keywords_look_at_each_distinct_word_once():
    looked = []

    class Stop(str):
        __hash__ = str.__hash__

        def __eq__(self, other):
            looked.append(other)
            return str.__eq__(self, other)

    texts = pa.array(["und b1 und und c22 c22 b1 ai", None, ""])
    (first, *rest) = _ranked(2, 2, [Stop("und")], ["ai", "c2"]).func(texts).to_pylist()
    assert first == {"keywords": ["b1", "c22"], "hits": [2, 2]} and rest == [{"keywords": [], "hits": []}] * 2
    assert looked == ["und"]


def test_a_cycle_writes_what_its_results_read_and_finds_the_same(spark):
    now = dt.datetime(2024, 1, 2, 10, 0)
    text = "The bright robot learns. It reads a long text of {0} words about tools, and writes {0} of its own."
    rows = [
        (i, ["a", None][i % 2], "A fine title here", text.format(i % 4), f"2024-01-02 0{i % 3}:00:00", "https://x.org/", "c")
        for i in range(8)
    ] + [(None, "b", "A fine title here", text.format("nine"), None, None, "c"), (8, "b", "x", "too short", None, None, "c")]
    posts = spark.createDataFrame(rows, "ingest_seq long, source string, title string, content string, date string, url string, c string")
    written = cycle.enriched_posts(posts, now, ["c"], near=False)
    assert written.columns == ["c", *cycle.READ]
    whole = cycle.collect_posts(posts, now, near=False)
    assert sorted(map(str, written.collect())) == sorted(map(str, whole.select(written.columns).collect()))
    assert len(cycle.analysis_rows(cycle.analyze(written, now, ["c"]), ["c"]).collect()) > 0


def test_white_space_is_rewritten_only_where_it_is_not_one_blank(spark):
    texts = ["a b", " a  b ", "a\tb", "a \t b", "a　 　b", "　a", "a \x85\x1c", "a  b c\n\nd", "\n a"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    one, every = F.regexp_replace("t", C.WIDE_SPACE, " "), F.regexp_replace("t", C.SPACE + "+", " ")
    assert [r[0] == r[1] for r in frame.select(one, every).collect()] == [True] * len(texts)
    assert frame.where(F.col("t").rlike(C.WIDE_SPACE)).count() == len(texts) - 1


def test_words_of_a_hash_are_filtered_once(spark):
    frame = spark.createDataFrame([("  The cat AND a dog ",), (None,), ("cat # \x85 dog",)], "t string")
    hashed = frame.select(X.content_hash(F.col("t")).alias("h"))
    assert plan(hashed).count("filter(") == 1
    assert [r.h for r in hashed.collect()] == [hashlib.md5(s).hexdigest() for s in (b"cat dog", b"", b"cat dog")]
