"""Recommendations store no texts."""

from postlens.plans import queries


def test_figures_of_recommendations_are_written_without_texts(spark, monkeypatch):
    written = []
    keep = queries.materialize
    monkeypatch.setattr(queries, "materialize", lambda df, name: (written.append(df.columns), keep(df, name))[1])
    queries._all_recommendations(spark, "/root/testdata/sf0.001")
    assert written and not {"content", "title"} & set(written[0])
