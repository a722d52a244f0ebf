"""URL filters: fixed host and path rules first, then association rules over URL tokens.

Spark's FP-growth mines combinations of URL tokens that go with bad pages: a page is bad where its label (by id) says low quality or
toxic. A combination becomes a rule if together with the bad mark it has the least support and confidence; a rule is dropped if
a part of it is a rule already, since that one fits wherever it does. The rules are matched by an inverted index: each is filed under
its rarest token, and a URL that has this token is tested for the others. All of it is DataFrame and MLlib work.

Rules are bounded by the support, a share of the labelled pages; pages are not. A null URL, or one without "://", has an empty host and
path; its tokens are those of the whole string. Repeated rows are judged alike, labels that contradict count as bad, and with no
labelled page nothing is blocked but by the fixed rules. Other columns of the pages are kept by ``judge``.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.shared import LOWER, UPPER, ascii_lower, load, materialize, session, text_or_empty

# Verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
MIN_SUPPORT, MIN_COUNT, MIN_CONFIDENCE = 0.002, 5, 0.5
BAD = "(bad)"  # no token holds a bracket


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(text_or_empty(url), r"(?s)\A.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(text_or_empty(url), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column) -> Column:
    """Distinct tokens with a letter, lower-cased."""
    found = F.regexp_extract_all(ascii_lower(text_or_empty(url)), F.lit("[a-z0-9]*[a-z][a-z0-9]*"), F.lit(0))
    return F.array_distinct(found)


def fixed_rule(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """A struct (rule, verdict) of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):  # later ones win
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def mine(pages: DataFrame, labels: DataFrame, support: float = MIN_SUPPORT, least: int = MIN_COUNT, confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (tokens, first), ``first`` the rarest of its tokens."""
    spark = pages.sparkSession
    bad = F.bool_or((F.col("quality") == 0) | (F.col("toxic") == 1))
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("page_id")).agg(F.coalesce(bad, F.lit(False)).alias("bad"))
    baskets = pages.join(marks, "page_id").select(
        F.concat(tokens_of(F.col("url")), F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))).alias("items")
    )
    baskets = materialize(baskets.filter(F.size("items") > 0), "url-baskets")
    n = baskets.count()
    if not n:
        return spark.createDataFrame([], "tokens array<string>, first string")
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(support, least / n)), minConfidence=0.0).fit(baskets)
    sets = materialize(model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"), "url-itemsets")
    singles = sets.filter(F.size("items") == 1).select(F.get("items", 0).alias("token"), F.col("freq").alias("token_freq"))
    together = sets.filter(F.array_contains("items", BAD) & (F.size("items") > 1)).select(
        F.array_remove("items", BAD).alias("items"), F.col("freq").alias("bad_freq")
    )
    strong = together.join(sets, "items").filter(F.col("bad_freq") >= confidence * F.col("freq")).select(F.col("items").alias("tokens"))
    first = (
        strong.withColumn("token", F.explode("tokens"))
        .join(singles, "token")
        .groupBy("tokens")
        .agg(F.min_by("token", F.struct("token_freq", "token")).alias("first"))
    )
    rules = materialize(first, "url-rules")
    # a rule with a part that is a rule: found by the part's own filing
    parts = rules.select(F.col("tokens").alias("part"), F.col("first").alias("token"))
    wider = rules.withColumn("token", F.explode("tokens")).join(parts, "token").filter(
        (F.size("part") < F.size("tokens")) & (F.size(F.array_except("part", "tokens")) == 0)
    )
    return rules.join(wider.select("tokens").distinct(), "tokens", "left_anti")


def blocked_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct URLs that a mined rule fits."""
    index = rules.select(F.col("first").alias("token"), "tokens")
    urls = pages.filter("url is not null").select("url").distinct().withColumn("own", tokens_of(F.col("url")))
    hits = urls.withColumn("token", F.explode("own")).join(index, "token").filter(F.size(F.array_except("tokens", "own")) == 0)
    return hits.select(F.col("url").alias("u_url"), F.lit(True).alias("u_hit")).distinct()


def judge(pages: DataFrame, labels: DataFrame, rules: tuple = RULES) -> DataFrame:
    """The pages with u_host, u_path, u_rule and u_verdict; page columns of these four names are replaced, all others kept."""
    # names of its own that no page column has
    key, hit, first = (f"{'_' * (1 + max(map(len, pages.columns)))}{n}" for n in ("url", "hit", "fixed"))
    found = blocked_urls(pages, mine(pages, labels)).withColumnsRenamed({"u_url": key, "u_hit": hit})
    url = F.col("url")
    named = pages.withColumns({"u_host": host_of(url), "u_path": path_of(url)})
    fixed = named.withColumn(first, fixed_rule(F.col("u_host"), F.col("u_path"), rules))
    mined = F.when(F.col(hit), "block").otherwise("allow")
    joined = fixed.join(found, fixed["url"] == found[key], "left")
    return joined.withColumns({"u_rule": F.col(f"{first}.rule"), "u_verdict": F.coalesce(F.col(f"{first}.verdict"), mined)}).drop(first, key, hit)


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    session(spark)
    pages = load(spark, sf_dir, "pages").select("page_id", "url")
    judged = judge(pages, load(spark, sf_dir, "labels"))
    return judged.select("page_id", *[F.col(f"u_{c}").alias(c) for c in ("host", "path", "rule", "verdict")])


def _sql_rule(what: int) -> str:
    cases = []
    for verdict, name, start in sorted(RULES, key=lambda r: -len(r[1] + r[2])):
        cases.append(f"WHEN (host = '{name}' OR host LIKE '%.{name}') AND starts_with(path, '{start}') THEN '{(name + start, verdict)[what]}'")
    return "CASE " + " ".join(cases) + " END"


SQL = f"""
WITH p AS (SELECT page_id, url, translate(coalesce(url, ''), '{UPPER}', '{LOWER}') AS low,
             translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM pages),
t AS (SELECT *, list_sort(list_distinct(regexp_extract_all(low, '[a-z0-9]*[a-z][a-z0-9]*'))) AS toks FROM p),
m AS (SELECT doc_id, bool_or(quality = 0 OR toxic = 1) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
lab AS (SELECT row_number() OVER () AS b, toks, coalesce(bad, false) AS bad FROM t JOIN m ON page_id = doc_id WHERE len(toks) > 0 OR bad),
least_count AS (SELECT ceil(least(1.0, greatest({MIN_SUPPORT}, {MIN_COUNT}.0 / count(*))) * count(*)) AS n FROM lab),
subs AS (SELECT bad, list_filter(toks, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS s
         FROM lab, unnest(generate_series(1, (1::BIGINT << len(toks)) - 1)) AS g(mask)),
rules AS (SELECT s FROM subs GROUP BY s HAVING count(*) FILTER (bad) >= (SELECT n FROM least_count)
          AND count(*) FILTER (bad) >= {MIN_CONFIDENCE} * count(*)),
urls AS (SELECT DISTINCT url, toks FROM t WHERE url IS NOT NULL),
hit AS (SELECT DISTINCT url FROM (SELECT url, list_filter(toks, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS s
        FROM urls, unnest(generate_series(1, (1::BIGINT << len(toks)) - 1)) AS g(mask)) JOIN rules USING (s))
SELECT page_id, host, path, {_sql_rule(0)} AS rule,
       coalesce({_sql_rule(1)}, CASE WHEN url IN (SELECT url FROM hit) THEN 'block' ELSE 'allow' END) AS verdict FROM t
"""
