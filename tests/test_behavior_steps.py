"""Topics are counted in the post, contexts looked for in the first posts only."""

import pytest
from pyspark.sql import functions as F

from postlens.operators import behavior as B


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_topics_are_counted_in_the_post(spark):
    rows = [(2, "zeta, alpha zeta 12ab über alphaé"), (None, "omega beta; omega-omega"), (2, "beta alpha_ alpha zeta beta"), (3, None), (4, "Alpha")]
    posts = spark.createDataFrame(rows, "ingest_seq long, content string")
    found = B.topic_predictions(posts)
    assert "lambda" not in plan(found) and "partial_min(struct" not in plan(found)
    got = [(r["rank"], r.topic, r.mentions) for r in found.collect()]
    assert got == [(1, "omega", 3), (2, "beta", 3), (3, "zeta", 3), (4, "alpha", 3)]


@pytest.mark.parametrize("by", [(), ("g",)])
def test_contexts_are_looked_for_in_the_first_posts_that_hold_a_name(spark, by):
    rows = [(s, "x", t) for s, t in [(1, "none"), (2, "b"), (2, "a"), (None, "xax y"), (9, "a a"), (3, None), (4, "a b")]] + [(7, "y", "b"), (8, None, "a")]
    posts = spark.createDataFrame(rows, "ingest_seq long, g string, content string")
    for names in (["a", "b"], ["b", "a b"], ["", "a"]):
        whole = B.competitor_contexts(posts, names, n=99, by=by)
        for n in (1, 2, 3):
            few = B.competitor_contexts(posts, names, n=n, by=by)
            same = whole.where(F.col("rank") <= n)
            assert sorted(map(str, few.collect())) == sorted(map(str, same.collect()))
    held = B._first_holders(posts, ["a"], 2, ()).where("_upto").collect()
    assert sorted(str(r.ingest_seq) for r in held) == ["1", "2", "2", "None"]
