"""Text, date and label expressions on hand-made edge rows."""

import re
import unicodedata

from pyspark.sql import functions as F

from postlens.functions import labels as L
from postlens.functions import text as X
from postlens.functions.dates import iso, normalize_datetime, wall_clock


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i long, v {kind}").repartition(2)


def apply(spark, values, expression, kind="string"):
    return [r[1] for r in column(spark, values, kind).select("i", expression.alias("o")).orderBy("i").collect()]


def expected_clean(text, keep):
    if not text:
        return ""
    t = unicodedata.normalize("NFKD", re.sub(r"<[^>]+>", " ", text))
    t = re.sub(r"([.!?]){3,}", r"\1\1\1", t)
    t = re.sub("[A-Z]{4,}", lambda m: m[0][:2] + m[0][2:].lower(), t)
    t = re.sub(r"\s+", " ", t).strip()
    if not keep:
        t = re.sub(r"https?://[!$-_a-z]+", "", t)
    return re.sub(r"[^\w\s.,!?@#\-:/]" if keep else r"[^\w\s.,!?\-]", "", t).strip()


TEXTS = [
    None, "", "   ", "ÉCOLE ABCÉ ABCD abCDEFgh", "ﬁn naïve space x\x85y", "wow!!!! what?!?!?! ok... end....",
    "<p>Hi <b>THERE</b></p> see https://a.b/c?d=1&e#frag now @me #tag", "no<tag", "a - b: c/d; (e) [f] {g} €5 100%",
    "HTTP://X.Y http://x.y/é", "tab\tnew\nline\x1cfs", "日本語 テキスト １２", "ABCDE", "aABCDb", "x_y-z",
]


def test_clean_text_both_modes(spark):
    for keep in (True, False):
        assert apply(spark, TEXTS, X.clean_text(F.col("v"), keep)) == [expected_clean(t, keep) for t in TEXTS]


def test_words_follow_unicode_spaces(spark):
    assert apply(spark, TEXTS[1:], X.words(F.col("v"))) == [t.split() for t in TEXTS[1:]]


def test_phone_gives_its_prefix(spark):
    phones = X.entities(F.col("v"))["phones"]
    values = ["call +1 555-123-4567 or (555) 123-4567", "none", None]
    assert apply(spark, values, phones) == [["+1 ", ""], [], []]


def test_emails_and_urls(spark):
    e = X.entities(F.col("v"))
    values = ["write a.b@c.org, x@y.z or é@q.com", "https://ex.org/a_b?c=1 http://[x] ftp://no"]
    assert apply(spark, values, e["emails"])[0] == ["a.b@c.org"]
    assert apply(spark, values, e["urls"])[1] == ["https://ex.org/a_b?c=1", "http://[x]"]


def test_issues_at_their_limits(spark):
    ten = "one two three four five six seven eight. nine ten."
    rows = [
        ("a b c", ten, "https://x"), ("a b", ten, "http://x"), ("a b c", "one two.", None), (None, None, ""),
        ("t " * 100, ten, "ftp://x"), ("t " * 100 + "tt", ten, None), ("a b c", ten + "x" * (10000 - len(ten)), None),
        ("a b c", ten + "x" * (10001 - len(ten)), None),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, t string, c string, u string")
    got = [r[0] for r in df.orderBy("i").select(X.issues(F.col("t"), F.col("c"), F.col("u"))).collect()]
    assert got == [
        [], ["Title too short"], ["Content too short (< 10 words)", "Content lacks proper sentences"],
        ["Missing title", "Missing content"], ["Invalid URL format"], ["Title too long"], [],
        ["Content too long (> 10000 chars)"],
    ]


def test_readability(spark):
    def rule(t):
        sentences = [s for s in t.split(".") if s.strip()]
        w = t.split()
        if not sentences or not w:
            return 0.0
        return max(0, 100 - min(100, (len(w) / len(sentences) * 0.6 + sum(map(len, w)) / len(w) * 0.4) * 5))

    values = ["", "...", "One two. Three four five.", "word " * 60]
    assert apply(spark, values, X.readability(F.col("v"))) == [rule(v) for v in values]


def test_dates(spark):
    values = [
        "2024-01-02T03:04:05", "2024-01-02T03:04:05Z", "2024-01-02T03:04:05+02:00", "2024-01-02", "Tue, 2 Jan 2024 03:04:05 GMT",
        "Tue, 02 Jan 2024 03:04:05 -0500", "n/a", "", None, "12:30",
        "2024/01/02 10:00", "Jan 2, 2024", "Wed Oct 10 20:19:24 +0000 2018", "January 2, 2024 03:04", "01/02/2024 3:04:05", "2 Jan 2024",
        "Jan 2024", "2024/13/02",
    ]
    utc = apply(spark, values, iso(normalize_datetime(F.col("v"))))
    assert utc == [
        "2024-01-02T03:04:05", "2024-01-02T03:04:05", "2024-01-02T01:04:05", "2024-01-02T00:00:00", "2024-01-02T03:04:05",
        "2024-01-02T08:04:05", None, None, None, None,
        "2024-01-02T10:00:00", "2024-01-02T00:00:00", "2018-10-10T20:19:24", "2024-01-02T03:04:00", "2024-01-02T03:04:05", "2024-01-02T00:00:00",
        None, None,
    ]
    written = apply(spark, values, iso(wall_clock(F.col("v"))))
    assert written[:4] == ["2024-01-02T03:04:05"] * 3 + ["2024-01-02T00:00:00"] and written[6:10] == [None] * 4


def test_labels_at_their_thresholds(spark):
    v = F.col("v")
    assert apply(spark, [0.1, 0.11, -0.1, -0.11, None], L.sentiment_label(v), "double") == [
        "neutral", "positive", "neutral", "negative", "neutral",
    ]
    assert apply(spark, [200.0, 200.1, 50.0, 50.1, 10.0, 10.1, 0.0, 0.1, -1.0], L.velocity_label(v), "double") == [
        "rapid", "explosive", "moderate", "rapid", "slow", "moderate", "declining", "slow", "declining",
    ]
    assert apply(spark, ["Said", "Green power", "no-code", "Cars"], L.topic_category(v)) == [
        "AI & Computing", "Sustainability", "Developer Tools", "General Technology",
    ]


def test_links(spark):
    site = F.lit("https://a.b:8/c/")
    assert apply(spark, ["/x", "http://q", "", "y"], X.join_link(site, F.col("v"))) == [
        "https://a.b:8/c/x", "http://q", "", "https://a.b:8/c/y",
    ]
    assert apply(spark, ["https://a.b:8/c/"], X.site_host(F.col("v"))) == ["a.b:8"]
