"""The registered queries again, in SQL for DuckDB, written from the rules alone.

Used to check results only; the package does not import it.
"""

from __future__ import annotations

from postlens import constants as C
from postlens.plans.queries import HEADS, LEXICON, NAMES, NEGATIONS, TERMS

SP = r"[\t-\r\x1c-\x20\x85\p{Z}]"
NSP = r"[^\t-\r\x1c-\x20\x85\p{Z}]"
W = r"[\p{L}\p{N}_]"
URL = r"https?://[!$-_a-z]+"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def lst(items) -> str:
    return "[" + ", ".join(q(i) for i in items) + "]"


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{SP}+'), lambda w: w <> '')"


def n_words(x: str) -> str:
    return f"len({words(x)})"


def n_sentences(x: str) -> str:
    return f"len(list_filter(string_split({x}, '.'), lambda s: regexp_matches(s, '{NSP}')))"


def letters(x: str) -> str:
    return f"length(regexp_replace({x}, '{SP}', '', 'g'))"


def count_of(x: str, term: str) -> str:
    return f"((length({x}) - length(replace({x}, {term}, ''))) // length({term}))"


def iso(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%dT%H:%M:%S')"


def clean(x: str, keep: bool) -> str:
    t = f"strip_accents(regexp_replace(coalesce({x}, ''), '<[^>]+>', ' ', 'g'))"
    t = rf"regexp_replace({t}, '([.!?]){{3,}}', '\1\1\1', 'g')"
    t = f"trim(regexp_replace({t}, '{SP}+', ' ', 'g'))"
    if keep:
        return rf"trim(regexp_replace({t}, '[^\p{{L}}\p{{N}}_ .,!?@#\-:/]', '', 'g'))"
    t = f"regexp_replace({t}, '{URL}', '', 'g')"
    return rf"trim(regexp_replace({t}, '[^\p{{L}}\p{{N}}_ .,!?\-]', '', 'g'))"


def chash(x: str) -> str:
    kept = f"list_filter({words('lower(' + clean(x, False) + ')')}, lambda h: NOT list_contains({lst(C.HASH_STOP_WORDS)}, h))"
    return f"md5(array_to_string({kept}, ' '))"


def readability(x: str) -> str:
    w, s, n = n_words(x), n_sentences(x), letters(x)
    return (
        f"CASE WHEN {w} = 0 OR {s} = 0 THEN 0.0 ELSE "
        f"greatest(0.0, 100.0 - least(100.0, ({w} / {s} * 0.6 + {n} / {w} * 0.4) * 5)) END"
    )


PLATFORM = "CASE user_id % 4 WHEN 0 THEN 'reddit' WHEN 1 THEN 'twitter' WHEN 2 THEN 'linkedin' ELSE 'quora' END"
POSTS = f"""
base AS (SELECT coalesce(d.doc_id, e.event_id) AS n, d.text, d.source AS src, e.* FROM documents d FULL JOIN events e ON d.doc_id = e.event_id),
posts AS MATERIALIZED (
  SELECT n AS ingest_seq, CAST(n AS VARCHAR) AS post_id,
    CASE WHEN n % 37 <> 5 THEN src END AS source,
    {PLATFORM} AS platform,
    CASE WHEN n % 6 <> 1 THEN event_type END AS category,
    CASE WHEN n % 40 <> 7 THEN array_to_string({words('text')}[1:8], ' ') END AS title,
    CASE WHEN n % 45 <> 3 THEN text || ' #' || event_type || ' @u' || user_id || ' https://ex.org/' || n END AS content,
    CASE WHEN n % 50 = 0 THEN 'ftp' ELSE 'https' END || '://ex.org/' || n AS url,
    CASE WHEN n % 10 = 9 THEN 'anonymous' ELSE 'u' || user_id END AS author,
    CASE WHEN n % 10 = 9 THEN 'anonymous' WHEN n % 3 <> 0 THEN 'u' || user_id END AS username,
    ts AS event_time,
    CASE WHEN n % 50 = 11 THEN 'n/a' WHEN n % 4 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
         WHEN n % 4 = 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
         WHEN n % 4 = 2 THEN strftime(ts, '%a, %d %b %Y %H:%M:%S') || ' +0000' END AS date,
    CASE WHEN n % 50 = 11 OR n % 4 = 3 THEN NULL ELSE date_trunc('second', ts) END AS dated,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE n % 3 WHEN 0 THEN '' WHEN 1 THEN 'Z' ELSE '+02:00' END AS created_at,
    date_trunc('second', ts) AS created,
    CAST(trunc(value) AS BIGINT) AS likes, CAST(json_extract_string(props, '$.k') AS BIGINT) AS comments,
    n % 7 AS shares, ['#' || event_type, '#t' || (user_id % 25)] AS hashtags,
    CASE WHEN n % 10 = 0 THEN 0.0 ELSE round(least(1.0, (value - 50) / 100), 4) END AS sentiment_polarity,
    coalesce(CASE WHEN n % 45 <> 3 THEN text || ' #' || event_type || ' @u' || user_id || ' https://ex.org/' || n END, '') AS body
  FROM base),
counted AS (SELECT *, {n_words('body')} AS word_count FROM posts),
clock AS (SELECT date_trunc('hour', max(event_time)) + INTERVAL 1 HOUR AS now FROM posts)
"""


def with_posts(sql: str, *ctes: str) -> str:
    return f"WITH {', '.join([POSTS, *ctes])} {sql}"


def keyword_ctes(part: str = "''", source: str = "posts", name: str = "kw", top: int = 50) -> str:
    """Keyword counts per post: (part, ingest_seq, keyword, hits, rk)."""
    text = rf"regexp_replace(lower(coalesce(content, '') || ' ' || coalesce(title, '')), '[^\p{{L}}\p{{N}}_\t-\r\x1c-\x20\x85\p{{Z}}]', ' ', 'g')"
    terms = " UNION ALL ".join(
        f"SELECT ingest_seq, {q(t)}, {count_of('t', q(t))}, {1 << 30} + {i} FROM {name}_text" for i, t in enumerate(TERMS)
    )
    return f"""
{name}_text AS (SELECT ingest_seq, {text} AS t FROM {source}),
{name}_words AS (SELECT ingest_seq, unnest({words('t')}) AS keyword, 1 AS hits, generate_subscripts({words('t')}, 1) AS pos FROM {name}_text),
{name}_all AS (
  SELECT * FROM {name}_words WHERE length(keyword) >= 3 AND NOT list_contains({lst(C.KEYWORD_STOP_WORDS)}, keyword)
  UNION ALL SELECT * FROM ({terms}) AS x(ingest_seq, keyword, hits, pos) WHERE hits > 0),
{name}_sum AS (SELECT ingest_seq, keyword, sum(hits) AS hits, min(pos) AS pos FROM {name}_all GROUP BY ALL),
{name}_rank AS (SELECT *, row_number() OVER (PARTITION BY ingest_seq ORDER BY hits DESC, pos) AS rk FROM {name}_sum),
{name} AS (SELECT {part} AS part, ingest_seq, keyword, hits, rk FROM {name}_rank JOIN {source} USING (ingest_seq) WHERE rk <= {top})"""


def trend_ctes(part: str = "''", source: str = "posts", name: str = "trends", least: int = 2) -> str:
    k = f"{name}_kw"
    return keyword_ctes(part, source, k) + f""",
{name}_hit AS (
  SELECT k.*, coalesce(p.dated, c.now) AS d, nullif(p.sentiment_polarity * 1.0000, 0) AS s,
    coalesce(p.dated, c.now) >= c.now - INTERVAL 24 HOUR AS recent
  FROM {k} k JOIN {source} p USING (ingest_seq), clock c),
{name}_total AS (
  SELECT part, keyword, sum(hits) AS mentions, count(*) AS posts, count(*) FILTER (recent) AS recent,
    coalesce(CAST(sum(CAST(round(s * 10000) AS BIGINT)) AS BIGINT) / 10000.0 / count(s), 0.0) AS sentiment, min(ingest_seq * 1000 + rk) AS first_seen
  FROM {name}_hit GROUP BY ALL),
{name}_peak AS (
  SELECT part, keyword, date_trunc('hour', d) AS hour, count(*) AS n, min(ingest_seq * 1000 + rk) AS f
  FROM {name}_hit WHERE recent GROUP BY ALL),
{name}_peaks AS (
  SELECT part, keyword, hour FROM {name}_peak
  QUALIFY row_number() OVER (PARTITION BY part, keyword ORDER BY n DESC, f // 1000) = 1),
{name}_top AS (
  SELECT *, row_number() OVER (PARTITION BY part ORDER BY mentions DESC, first_seen) AS place FROM {name}_total
  QUALIFY place <= 30),
{name}_pool AS (
  SELECT *, list(keyword) OVER (PARTITION BY part ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS pool FROM {name}_top),
{name}_related AS (
  SELECT *, array_to_string(list_filter(pool[1:15], lambda k: k <> keyword AND len(list_intersect(string_split(k, ' '), string_split(keyword, ' '))) > 0)[1:3], ', ') AS related
  FROM {name}_pool),
{name}_stack AS (
  SELECT part, keyword, mentions, recent, posts, sentiment, place, NULL::TIMESTAMP AS hour, related FROM {name}_related
  UNION ALL SELECT part, keyword, NULL, NULL, NULL, NULL, NULL, hour, NULL FROM {name}_peaks),
{name}_all_of AS (
  SELECT part, keyword, max(mentions) AS mentions, max(recent) AS recent, max(posts) AS posts, max(sentiment) AS sentiment, max(place) AS place,
    max(hour) AS hour, max(related) AS related FROM {name}_stack GROUP BY part, keyword),
{name}_lab AS (
  SELECT part, keyword AS topic, mentions, recent / 24 AS velocity, sentiment, place, recent / greatest(1, posts) AS share,
    CASE WHEN recent / greatest(1, posts) >= 0.6 THEN least(0.9, recent / 5) WHEN recent / greatest(1, posts) <= 0.2
         THEN least(0.7, mentions / 10) ELSE 0.5 END AS confidence,
    hour AS peak_time, coalesce(related, '') AS related_keywords
  FROM {name}_all_of WHERE mentions >= {least} AND recent > 0),
{name}_last AS (
  SELECT *, row_number() OVER (PARTITION BY part ORDER BY velocity * confidence DESC, place) AS rank FROM {name}_lab
  QUALIFY rank <= 15),
{name} AS (SELECT *, CASE WHEN share >= 0.6 THEN 'rising' WHEN share <= 0.2 THEN 'falling' ELSE 'stable' END AS direction FROM {name}_last)"""


TREND_COLUMNS = f"""rank, topic, CAST(mentions AS BIGINT) AS mentions, round(velocity, 6) AS velocity, round(sentiment, 6) AS sentiment,
  direction, round(confidence, 6) AS confidence, {iso('peak_time')} AS peak_time, related_keywords"""

ISSUES = f"""list_filter([
  CASE WHEN coalesce(title, '') = '' THEN 'Missing title' END,
  CASE WHEN body = '' THEN 'Missing content' END,
  CASE WHEN body <> '' AND {n_words('body')} < 10 THEN 'Content too short (< 10 words)' END,
  CASE WHEN length(body) > 10000 THEN 'Content too long (> 10000 chars)' END,
  CASE WHEN body <> '' AND {count_of('body', q('.'))} < 2 THEN 'Content lacks proper sentences' END,
  CASE WHEN coalesce(title, '') <> '' AND {n_words('title')} < 3 THEN 'Title too short' END,
  CASE WHEN length(coalesce(title, '')) > 200 THEN 'Title too long' END,
  CASE WHEN coalesce(url, '') <> '' AND NOT regexp_matches(url, '^https?://') THEN 'Invalid URL format' END
], lambda i: i IS NOT NULL)"""


def tokens(x: str) -> str:
    return rf"list_filter(string_split_regex(lower({x}), '[^\p{{L}}\p{{N}}_'']+'), lambda t: t <> '')"


LEX = "lex(word, polarity, subjectivity, intensity) AS (VALUES " + ", ".join(
    f"({q(w)}, {p}::DOUBLE, {s}::DOUBLE, {i}::DOUBLE)" for w, p, s, i in LEXICON
) + ")"
SENTIMENT = f"""{LEX},
tok AS (SELECT ingest_seq, unnest({tokens('body')}) AS word, generate_subscripts({tokens('body')}, 1) AS pos FROM posts),
tok2 AS (SELECT *, lag(word) OVER (PARTITION BY ingest_seq ORDER BY pos) AS previous FROM tok),
hits AS (
  SELECT ingest_seq, l.subjectivity,
    greatest(-1, least(1, l.polarity * CASE WHEN list_contains({lst(NEGATIONS)}, previous) THEN -0.5 ELSE 1 END * coalesce(b.intensity, 1))) AS s
  FROM tok2 t JOIN lex l ON t.word = l.word LEFT JOIN lex b ON b.word = t.previous),
scores AS (
  SELECT p.ingest_seq, round(coalesce(avg(s), 0.0), 9) AS pol, round(coalesce(avg(subjectivity), 0.0), 9) AS sub
  FROM posts p LEFT JOIN hits USING (ingest_seq) GROUP BY ALL)"""


def mean_of_scores(x: str = "sentiment_polarity") -> str:
    """Mean of scores of four places to six, in whole numbers, so that a mean between two results is rounded as it is."""
    total, n = f"CAST(sum(CAST(round({x} * 10000) AS BIGINT)) AS BIGINT)", f"count({x})"
    return f"sign({total}) * ((200 * abs({total}) + {n}) // (2 * {n})) / 1e6"


def label(p: str) -> str:
    return f"CASE WHEN {p} > 0.1 THEN 'positive' WHEN {p} < -0.1 THEN 'negative' ELSE 'neutral' END"


def language(x: str) -> str:
    """Struct (hits, order, language) of the best profile."""
    options = ", ".join(
        f"{{'h': len(list_filter({tokens(x)}, lambda w: list_contains({lst(words_)}, w))), 'o': {-i}, 'l': {q(name)}}}"
        for i, (name, words_) in enumerate(C.LANGUAGE_PROFILES.items())
    )
    return f"list_max([{options}])"


STAMP = "CAST(epoch(now) AS BIGINT)"
NULLS = "NULL::VARCHAR"


def fixed(name: str, figure: str | None = None, title_figure: str | None = None, schedule: str = NULLS) -> str:
    """Select list of a fixed recommendation, without rank columns."""
    kind, content, title, priority, urgency, reason, audience, estimate, tags, strategy, action = C.RECOMMENDATIONS[name]

    def fill(text: str, value: str | None) -> str:
        return q(text) if value is None else f"replace({q(text)}, '{{}}', {value})"

    return f"""'{name}_' || {STAMP} AS id, {q(kind)} AS type, {q(content)} AS content_type, {fill(title, title_figure)} AS title,
      {NULLS} AS topic, {priority} AS priority, {q(urgency)} AS urgency, {fill(reason, figure)} AS reasoning,
      {q(audience)} AS target_audience, {fill(estimate, figure)} AS estimated_engagement, {q(strategy)} AS strategy,
      {q(action) if action else NULLS} AS action_required, {schedule} AS schedule_for, NULL::DOUBLE AS trend_confidence,
      {q(' '.join(tags)) if tags else NULLS} AS hashtags"""


def trend_recommendations() -> str:
    hot = "direction = 'rising' AND velocity > 2"
    pick = "CAST(('0x' || substr(md5(topic), 1, 8))::BIGINT % 5 AS INTEGER) + 1"
    titles = " ".join(f"WHEN {q(k)} THEN {lst(v)}[{pick}]" for k, v in C.TITLE_TEMPLATES.items())
    return f"""SELECT part, CAST(rank AS INTEGER) AS ord, 'trend_' || replace(topic, ' ', '_') || '_' || {STAMP} AS id, 'trend_based' AS type, ct AS content_type,
      replace(CASE ct {titles} END, '{{topic}}', topic) AS title, topic, pr AS priority,
      CASE WHEN {hot} THEN 'high' WHEN direction = 'rising' THEN 'medium' ELSE 'low' END AS urgency,
      'Trending topic with ' || CAST(mentions AS BIGINT) || ' mentions, ' || direction || ' trend' AS reasoning, 'general' AS target_audience,
      CASE WHEN pr + velocity * 2 >= 12 THEN 'very_high' WHEN pr + velocity * 2 >= 9 THEN 'high' WHEN pr + velocity * 2 >= 6 THEN 'medium' ELSE 'low' END AS estimated_engagement,
      {NULLS} AS strategy, {NULLS} AS action_required, {NULLS} AS schedule_for, confidence AS trend_confidence,
      '#' || replace(topic, ' ', '') || ' #trending #tech' AS hashtags
    FROM (SELECT *, CASE WHEN {hot} THEN 'news' WHEN direction = 'rising' THEN 'discussion' ELSE 'tutorial' END AS ct,
            CASE WHEN {hot} THEN 9 WHEN direction = 'rising' THEN 8 ELSE 6 END AS pr FROM trends), clock
    WHERE rank <= 5"""


def distribution(part: str) -> str:
    return f"""mood AS (
  SELECT {part} AS part, avg(s) AS overall_sentiment, coalesce(avg(CAST(s > 0.1 AS DOUBLE)), 0.0) AS positive,
    coalesce(avg(CAST(s < -0.1 AS DOUBLE)), 0.0) AS negative, coalesce(avg(CAST(abs(s) <= 0.1 AS DOUBLE)), 1.0) AS neutral
  FROM (SELECT *, CASE WHEN dated IS NOT NULL THEN nullif(sentiment_polarity, 0) END AS s FROM posts) GROUP BY ALL)"""


def figures(part: str) -> str:
    return f"""figures AS (SELECT {part} AS part, count(*) AS total, count(DISTINCT coalesce(source, 'Unknown')) AS groups FROM posts GROUP BY ALL)"""


SENTIMENT_RECS = f"""SELECT part, 10 AS ord, {fixed('sentiment_negative', "printf('%.1f%%', negative * 100)")} FROM mood, clock WHERE negative > 0.4
  UNION ALL SELECT part, 10, {fixed('sentiment_positive', "printf('%.1f%%', positive * 100)")} FROM mood, clock WHERE negative <= 0.4 AND positive > 0.7"""
ENGAGEMENT_RECS = f"""SELECT part, 20 AS ord, {fixed('engagement_high_activity', 'CAST(total AS VARCHAR)')} FROM figures, clock WHERE total > 50
  UNION ALL SELECT part, 21, {fixed('engagement_diverse_sources', 'CAST(groups AS VARCHAR)')} FROM figures, clock WHERE groups > 5"""
SLOTS = "slots(o, hour, boost) AS (VALUES " + ", ".join(f"({i}, {h}, {b})" for i, (_, h, b) in enumerate(C.POSTING_SLOTS)) + """),
slot AS (SELECT *, CASE WHEN hour > h THEN hour - h ELSE 24 - h + hour END AS wait FROM slots, (SELECT CAST(hour(now) AS INTEGER) AS h FROM clock)
  WHERE CASE WHEN hour > h THEN hour - h ELSE 24 - h + hour END <= 12 ORDER BY boost DESC, o LIMIT 1)"""
TIMING_RECS = f"""SELECT part, 30 AS ord, {fixed('timing_optimal', "printf('%.1f', CAST(boost AS DOUBLE))", 'CAST(hour AS VARCHAR)', iso('now + to_hours(wait)'))} FROM figures, clock, slot"""
CONTENT_RECS = f"""SELECT part, 40 AS ord, {fixed('content_educational')} FROM figures, clock UNION ALL SELECT part, 41, {fixed('content_interactive')} FROM figures, clock"""


def all_recommendations(part: str) -> str:
    return ", ".join([
        trend_ctes(part), distribution(part), figures(part), SLOTS,
        f"recs AS ({trend_recommendations()} UNION ALL {SENTIMENT_RECS} UNION ALL {ENGAGEMENT_RECS} UNION ALL {TIMING_RECS} UNION ALL {CONTENT_RECS})",
        f"""ranked AS (SELECT recs.*, row_number() OVER (PARTITION BY part ORDER BY priority DESC, ord) AS rank, {iso('now')} AS generated_at,
          least(0.95, 0.7 + CASE WHEN total > 100 THEN 0.2 WHEN total > 50 THEN 0.1 ELSE 0 END
            + CASE WHEN type = 'trend_based' AND trend_confidence > 0.8 THEN 0.1 ELSE 0 END) AS confidence_score
          FROM recs JOIN figures USING (part), clock QUALIFY rank <= 15)""",
    ])


REC = """id, type, content_type, title, topic, priority, urgency, reasoning, target_audience, estimated_engagement, strategy,
  action_required, schedule_for, round(trend_confidence, 6) AS trend_confidence, hashtags"""

INSIGHT_PARTS = """
ins_fig AS (SELECT count(*) AS total, count(DISTINCT source) AS sources, avg(nullif(sentiment_polarity, 0)) AS mood, avg(nullif(word_count, 0)) AS w FROM {source}),
ins_src AS (SELECT source, count(*) AS n FROM {source} WHERE source IS NOT NULL GROUP BY source ORDER BY n DESC, min(ingest_seq) LIMIT 1),
ins_hour AS (SELECT hour(dated) AS h FROM {source} WHERE dated IS NOT NULL GROUP BY h ORDER BY count(*) DESC, min(ingest_seq) LIMIT 1),
ins_dated AS (SELECT count(dated) AS n FROM {source}),
lines AS (SELECT list_filter([
  'Analyzed ' || total || ' articles from ' || sources || ' different sources',
  coalesce((SELECT 'Top trending topic: ''' || topic || ''' with ' || CAST(mentions AS BIGINT) || ' mentions and ' || direction || ' trend' FROM {trends} WHERE rank = 1),
    'No significant trends detected in current dataset'),
  (SELECT 'Rising trends: ' || string_agg(topic, ', ' ORDER BY rank) FROM (SELECT * FROM {trends} WHERE rank <= 5 AND direction = 'rising' ORDER BY rank LIMIT 3)),
  (SELECT CASE WHEN count(*) > 0 THEN 'High-velocity topics generating significant discussion: ' || count(*) || ' topics' END FROM {trends} WHERE rank <= 10 AND velocity > 0.5),
  CASE WHEN mood > 0.2 THEN 'Overall sentiment is positive - good engagement opportunity' WHEN mood < -0.2 THEN 'Overall sentiment is negative - may need attention'
    WHEN mood IS NOT NULL THEN 'Sentiment is neutral - opportunity for engagement' END,
  (SELECT 'Primary source: ' || source || ' (' || n || ' articles)' FROM ins_src),
  (SELECT CASE WHEN n > 5 THEN 'Peak activity around ' || h || ':00 - optimal time for engagement' END FROM ins_hour, ins_dated),
  CASE WHEN w > 100 THEN 'Long-form content dominates - detailed discussions preferred' WHEN w IS NOT NULL THEN 'Short-form content prevalent - quick updates and news' END
], lambda x: x IS NOT NULL) AS l FROM ins_fig)"""


def insight_ctes(source: str = "counted", trends: str = "trends") -> str:
    return INSIGHT_PARTS.format(source=source, trends=trends)


PERIOD = """recent AS (SELECT p.* FROM counted p, clock WHERE date IS NULL OR dated >= now - INTERVAL 24 HOUR),
chosen AS (SELECT * FROM recent UNION ALL SELECT * FROM counted WHERE NOT EXISTS (SELECT 1 FROM recent))"""

TAGGED = f"""tagged AS (SELECT e.ts AS event_time, ['#' || event_type, '#t' || (user_id % 25)] AS hashtags, {PLATFORM} AS platform,
  round(least(1.0, (value - 50) / 100), 4) AS s, CAST(json_extract_string(props, '$.k') AS DOUBLE) / 1000 AS er, c_nationkey AS country
  FROM events e LEFT JOIN customer ON user_id = c_custkey),
tclock AS (SELECT date_trunc('hour', max(ts)) + INTERVAL 1 HOUR AS now FROM events),
tags AS (SELECT unnest(hashtags) AS hashtag, event_time >= now - INTERVAL 24 HOUR AS cur, platform, s, er, country FROM tagged, tclock
  WHERE event_time >= now - INTERVAL 48 HOUR AND event_time < now),
tagsum AS (SELECT hashtag, count(*) FILTER (cur) AS c, count(*) FILTER (NOT cur) AS p,
  coalesce(string_agg(DISTINCT platform, ',' ORDER BY platform) FILTER (cur), '') AS platforms, count(DISTINCT platform) FILTER (cur) AS np,
  coalesce(avg(s) FILTER (cur), 0.0) AS mood, coalesce(avg(er) FILTER (cur), 0.0) AS rate, count(DISTINCT country) FILTER (cur) AS spread FROM tags GROUP BY hashtag),
taggrow AS (SELECT *, (c - p) / greatest(p, 1) * 100 AS g FROM tagsum),
hashtags AS (SELECT *, greatest(0.0, least(100.0, g * 0.3 + least(c / 1000, 10.0) * 0.2 + rate * 20 + (mood + 1) * 0.5 + np * 0.2 + least(spread / 10, 5.0) * 0.1)) AS score,
  CASE WHEN g > 200 THEN 'explosive' WHEN g > 50 THEN 'rapid' WHEN g > 10 THEN 'moderate' WHEN g > 0 THEN 'slow' ELSE 'declining' END AS velocity,
  CASE WHEN g > 30 AND rate > 0.05 AND mood > 0.2 THEN 'rising' WHEN g < -10 OR mood < -0.3 THEN 'declining' WHEN g > 5 THEN 'stable_growth' ELSE 'stable' END AS prediction
  FROM taggrow),
tagrank AS (SELECT *, row_number() OVER (ORDER BY score DESC, c DESC, hashtag) AS rank FROM hashtags)"""

_FOUND = " UNION ALL ".join(
    f"SELECT ingest_seq, {i} AS head, unnest(m) AS word, generate_subscripts(m, 1) AS pos FROM "
    rf"(SELECT ingest_seq, regexp_extract_all(t, '({W}+){SP}+{h}(?:[^\p{{L}}\p{{N}}_]|$)', 1) AS m FROM ttext)"
    for i, h in enumerate(HEADS)
)


def category(x: str) -> str:
    cases = " ".join(
        f"WHEN {' OR '.join(f'contains(lower({x}), {q(p)})' for p in parts)} THEN {q(name)}" for name, parts in C.TOPIC_CATEGORIES
    )
    return f"CASE {cases} ELSE {q(C.DEFAULT_TOPIC_CATEGORY)} END"


TOPICS = f"""ttext AS (SELECT ingest_seq, lower(coalesce(content, '') || ' ' || coalesce(title, '')) AS t FROM posts),
found AS ({_FOUND}),
tcount AS (SELECT word, count(*) AS n, min(head * 1000000000000 + ingest_seq * 100000 + pos) AS f FROM found GROUP BY word),
ttop AS (SELECT *, row_number() OVER (ORDER BY n DESC, f) AS rank FROM tcount QUALIFY rank <= 10),
topics AS (SELECT rank, upper(word[1]) || word[2:] || ' Technology' AS topic, word, n, least(n / 20, 1.0) AS conf FROM ttop WHERE n >= 3 AND length(word) > 3)"""

VELOCITY = """vdays AS (SELECT date_trunc('day', created) AS day, count(*) AS n FROM posts GROUP BY day),
vd AS (SELECT *, row_number() OVER (ORDER BY day) AS up, row_number() OVER (ORDER BY day DESC) AS down FROM vdays),
vtrend AS (SELECT CASE WHEN count(*) < 2 THEN 'insufficient_data' WHEN count(*) < 4 THEN 'stable'
   WHEN avg(n) FILTER (down <= 2) > avg(n) FILTER (up <= 2) * 1.2 THEN 'increasing' WHEN avg(n) FILTER (down <= 2) < avg(n) FILTER (up <= 2) * 0.8 THEN 'decreasing'
   ELSE 'stable' END AS velocity_trend FROM vd),
vhours AS (SELECT strftime(created, '%Y-%m-%d-%H') AS hour, count(*) AS n, min(ingest_seq) AS f FROM posts GROUP BY hour),
vpeak AS (SELECT hour, n FROM vhours ORDER BY n DESC, f LIMIT 1),
velocity AS (SELECT (SELECT count(*) FROM posts) AS content_count, (SELECT CAST(sum(likes + comments + shares) AS BIGINT) FROM posts) AS total_engagement,
  (SELECT sum(likes + comments + shares) / count(*) FROM posts) AS avg_engagement_per_post, (SELECT avg(n) FROM vhours) AS avg_hourly_posting_rate,
  (SELECT avg(n) FROM vdays) AS avg_daily_posting_rate, (SELECT hour FROM vpeak) AS peak_hour, (SELECT n FROM vpeak) AS peak_hour_posts,
  (SELECT min(hour) FROM vhours) AS period_start, (SELECT max(hour) FROM vhours) AS period_end, (SELECT velocity_trend FROM vtrend) AS velocity_trend)"""

DOCTAGS = """dw AS (SELECT unnest(string_split_regex(lower(text), '[^a-z]+')) AS word FROM documents),
doctags AS (SELECT word, '#' || upper(word) AS hashtag, count(*) AS uses FROM dw WHERE word <> '' GROUP BY word)"""
TAG_CATEGORY = {}
for _name, _tags in C.HASHTAG_CATEGORIES.items():
    for _tag in _tags:
        TAG_CATEGORY.setdefault(_tag, _name)


def case_of(x: str, mapping: dict, default: str, as_list: bool = False) -> str:
    show = lst if as_list else q
    return f"CASE {x} " + " ".join(f"WHEN {q(k)} THEN {show(v)}" for k, v in mapping.items()) + f" ELSE {default} END"


ANALYSES = "analyses AS (SELECT 'analysis_' || part AS analysis_id, now AS timestamp, part FROM figures, clock)"
HOURLY = "hourly AS (SELECT date_trunc('hour', event_time) AS hour, count(*) AS n FROM posts GROUP BY hour)"
REACTIONS = "likes + comments + shares"
ARTICLE = r"regexp_extract(html, '(?s)<article>(.*?)</article>', 1)"
UNTAG = r"regexp_replace({x}, '\s*<[^>]*>\s*', '', 'g')"


def unescape(x: str) -> str:
    for ref, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        x = f"replace({x}, {q(ref)}, {q(char)})"
    return x


def oracle_queries() -> dict[str, str]:
    rounded_mood = "round(overall_sentiment, 6) AS overall_sentiment, round(positive, 6) AS positive, round(negative, 6) AS negative, round(neutral, 6) AS neutral"
    basic = f"""count(*) AS total_articles, coalesce({iso('min(dated)')}, 'Unknown') AS date_start, coalesce({iso('max(dated)')}, 'Unknown') AS date_end,
      round(avg(length(body)), 6) AS avg_content_length, count(DISTINCT source) AS total_unique_sources FROM posts"""

    def top_posts(part: str) -> str:
        extra = f"{part} AS platform, " if part != "''" else ""
        return with_posts(f"""SELECT {extra}ingest_seq, left(body, 100) || '...' AS excerpt, likes + comments * 2 + shares * 3 AS score,
          coalesce(source, 'unknown') AS source, likes, comments, shares,
          row_number() OVER (PARTITION BY {part} ORDER BY likes + comments * 2 + shares * 3 DESC, ingest_seq) AS rank FROM posts QUALIFY rank <= 10""")

    entities = " UNION ALL ".join(
        f"SELECT ingest_seq, '{k}' AS kind, generate_subscripts(m, 1) - 1 AS position, coalesce(unnest(m), '') AS value FROM (SELECT ingest_seq, regexp_extract_all(body, '{p}', {g}) AS m FROM posts)"
        for k, p, g in (
            ("mentions", C.MENTION_PATTERN, 0), ("hashtags", C.HASHTAG_PATTERN, 0), ("urls", URL, 0),
            ("emails", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", 0), ("phones", C.PHONE_PATTERN, 1),
        )
    )
    n_entities = {k: f"len(regexp_extract_all(body, '{p}'))" for k, p in (
        ("mentions", C.MENTION_PATTERN), ("hashtags", C.HASHTAG_PATTERN), ("urls", URL),
        ("emails", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"), ("phones", C.PHONE_PATTERN),
    )}
    stats_of = f"""{n_words('body')} AS word_count, length(body) AS char_count, {n_sentences('body')} AS sentence_count,
      round(coalesce({letters('body')} / nullif({n_words('body')}, 0), 0.0), 6) AS avg_word_length"""
    doc_title = f"array_to_string({words('text')}[1:8], ' ')"
    summary = with_posts(f"""
      SELECT 'total_hashtags_analyzed' AS section, 1 AS position, {NULLS} AS item, CAST(count(*) AS DOUBLE) AS value FROM hashtags
      UNION ALL SELECT 'total_emerging_topics', 1, NULL, count(*) FROM topics
      UNION ALL SELECT 'top_trending_hashtags', rank, hashtag || ' ' || velocity, round(score, 6) FROM tagrank WHERE rank <= 5
      UNION ALL SELECT 'high_confidence_emerging_topics', row_number() OVER (ORDER BY rank), topic, round(conf, 6) FROM topics WHERE conf > 0.7
      UNION ALL SELECT 'velocity_insights', row_number() OVER (ORDER BY o), t, NULL FROM (
        SELECT 1 AS o, CASE velocity_trend WHEN 'increasing' THEN 'Content velocity is increasing - good time for active engagement'
          WHEN 'decreasing' THEN 'Content velocity is decreasing - may need to boost content creation' END AS t FROM velocity
        UNION ALL SELECT 2, CASE WHEN avg_engagement_per_post > 50 THEN 'High engagement rate detected - content resonating well'
          WHEN avg_engagement_per_post < 10 THEN 'Low engagement rate - consider content strategy adjustment' END FROM velocity) WHERE t IS NOT NULL""",
        TAGGED, TOPICS, VELOCITY)
    advice = with_posts("""SELECT row_number() OVER (ORDER BY o) AS position, t AS advice FROM (
        SELECT 1 AS o, CASE velocity WHEN 'explosive' THEN 'Capitalize on explosive trend: ' || hashtag || ' - create content immediately'
           WHEN 'rapid' THEN 'Join trending conversation: ' || hashtag || ' - high engagement potential' END AS t FROM tagrank WHERE rank = 1
        UNION ALL (SELECT 2, 'Early mover advantage: Create content about ''' || topic || ''' - high confidence emerging trend' FROM topics WHERE conf > 0.8 ORDER BY rank LIMIT 1)
        UNION ALL SELECT 3, CASE velocity_trend WHEN 'increasing' THEN 'Content velocity increasing - scale up posting schedule to match momentum'
           WHEN 'decreasing' THEN 'Content velocity decreasing - focus on quality over quantity, boost engagement tactics' END FROM velocity
        UNION ALL VALUES (4, 'Monitor trend velocity daily for rapid response opportunities'), (5, 'Cross-reference hashtag trends with emerging topics for content synergy'),
          (6, 'Prepare content templates for quick deployment during trend spikes')) WHERE t IS NOT NULL QUALIFY position <= 5""", TAGGED, TOPICS, VELOCITY)
    scored = with_posts("""
      SELECT part AS platform, row_number() OVER (PARTITION BY part ORDER BY priority DESC) AS rank, priority, type, title, description, action FROM (
        SELECT part, 8 AS priority, 'positive_sentiment' AS type, 'Strong Positive Sentiment' AS title,
          printf('Community shows %.1f%% positive sentiment. Great opportunity for engagement.', positive * 100) AS description,
          'Amplify positive content and engage with enthusiastic users' AS action FROM mood WHERE positive * 100 > 70
        UNION ALL SELECT part, 9, 'negative_sentiment', 'Negative Sentiment Alert', printf('High negative sentiment detected (%.1f%%). Requires attention.', negative * 100),
          'Address concerns, provide support, and improve communication' FROM mood WHERE positive * 100 <= 70 AND negative * 100 > 40
        UNION ALL SELECT part, 7, 'trending_topic', 'Trending: "' || topic || '"', 'Most discussed topic with ' || CAST(mentions AS BIGINT) || ' mentions.',
          'Create content around "' || topic || '" to ride the trend' FROM trends WHERE rank = 1
        UNION ALL SELECT part, 6, 'optimal_timing', 'Peak Activity at ' || h || ':00', 'Highest engagement occurs around ' || h || ':00.',
          'Schedule important posts around ' || h || ':00 for maximum reach' FROM peak)""",
        trend_ctes("platform"), distribution("platform"),
        """peak AS (SELECT platform AS part, hour(created) AS h FROM posts GROUP BY part, h QUALIFY row_number() OVER (PARTITION BY part ORDER BY count(*) DESC, min(ingest_seq)) = 1)""")
    cycle_filter = f"""valid AS (SELECT * FROM (SELECT *, {n_words('body')} AS word_count FROM posts WHERE body <> ''
        QUALIFY row_number() OVER (PARTITION BY {chash('body')} ORDER BY ingest_seq) = 1) WHERE len({ISSUES}) = 0)"""
    cycle_scores = SENTIMENT.replace(lst(NEGATIONS), lst(C.NEGATIONS))
    scored_filter = cycle_filter.replace("valid AS (SELECT * FROM (", "valid AS (SELECT v.* REPLACE (pol AS sentiment_polarity) FROM (", 1).replace(
        f") WHERE len({ISSUES}) = 0)", f") v JOIN scores USING (ingest_seq) WHERE len({ISSUES}) = 0)")
    queries = {
        "normalize_dates": with_posts(f"""SELECT ingest_seq, CASE ingest_seq % 11 WHEN 1 THEN strftime(event_time, '%Y/%m/%d %H:%M:%S') WHEN 2 THEN strftime(event_time, '%b %-d, %Y')
              WHEN 3 THEN strftime(event_time, '%a %b %d %H:%M:%S +0000 %Y') WHEN 4 THEN strftime(event_time, '%B %-d, %Y %H:%M')
              WHEN 5 THEN strftime(event_time, '%m/%d/%Y %H:%M:%S') ELSE date END AS date,
            {iso("""CASE ingest_seq % 11 WHEN 1 THEN event_time WHEN 2 THEN date_trunc('day', event_time) WHEN 3 THEN event_time
              WHEN 4 THEN date_trunc('minute', event_time) WHEN 5 THEN event_time ELSE dated END""")} AS normalized FROM posts"""),
        "event_hour": with_posts("SELECT ingest_seq, strftime(created, '%Y-%m-%d-%H') AS hour_key, strftime(created, '%Y-%m-%d-%H') AS written_hour_key FROM posts"),
        "clean_text": with_posts(f"SELECT ingest_seq, lower({clean('content', True)}) AS clean, lower({clean('content', False)}) AS plain FROM posts"),
        "extract_entities": with_posts(entities),
        "content_hash": f"SELECT doc_id AS ingest_seq, {chash('text')} AS content_hash FROM documents",
        "validate_posts": with_posts(f"SELECT ingest_seq, len(i) = 0 AS is_valid, coalesce(array_to_string(i, '; '), '') AS issues FROM (SELECT *, {ISSUES} AS i FROM posts)"),
        "rejection_reasons": with_posts(f"SELECT issue, count(*) AS n FROM (SELECT unnest({ISSUES}) AS issue FROM posts) GROUP BY issue"),
        "sentiment_label": with_posts(f"SELECT ingest_seq, {label('sentiment_polarity')} AS sentiment_label FROM posts"),
        "readability": with_posts(f"SELECT ingest_seq, round({readability('body')}, 6) AS readability_score FROM posts"),
        "text_stats": with_posts(f"SELECT ingest_seq, {stats_of} FROM posts"),
        "lexicon_sentiment": with_posts(f"SELECT ingest_seq, round(pol, 6) AS sentiment_polarity, round(sub, 6) AS sentiment_subjectivity, {label('pol')} AS sentiment_label FROM scores", SENTIMENT),
        "detect_language": f"""SELECT ingest_seq, CASE WHEN b.h > 0 THEN b.l ELSE 'unknown' END AS language,
            round(CASE WHEN b.h > 0 THEN least(1.0, n / 200) ELSE 0.0 END, 6) AS language_confidence
            FROM (SELECT doc_id AS ingest_seq, length(text) AS n, {language('text')} AS b FROM documents)""",
        "enrich_posts": with_posts(f"""SELECT p.ingest_seq, lower({clean('title', True)}) AS title, md5(lower({clean('content', True)})) AS content_md5, {stats_of},
            {', '.join(f'{c} AS n_{k}' for k, c in n_entities.items())}, {' + '.join(n_entities.values())} > 0 AS has_entities,
            round({readability('body')}, 6) AS readability_score, round(pol, 6) AS sentiment_polarity, round(sub, 6) AS sentiment_subjectivity,
            {label('pol')} AS sentiment_label, CASE WHEN b.h > 0 THEN b.l ELSE 'unknown' END AS language,
            round(CASE WHEN b.h > 0 THEN least(1.0, length(body) / 200) ELSE 0.0 END, 6) AS language_confidence, {chash('body')} AS content_hash
            FROM (SELECT *, {language('body')} AS b FROM posts WHERE len({ISSUES}) = 0) p JOIN scores USING (ingest_seq)""", SENTIMENT),
        "extract_keywords": with_posts("SELECT ingest_seq, keyword, CAST(hits AS BIGINT) AS hits, rk AS rank FROM kw", keyword_ctes(top=20)),
        "text_items": with_posts("SELECT ingest_seq FROM posts WHERE body <> '' OR coalesce(title, '') <> ''"),
        "period_filter": with_posts("SELECT ingest_seq FROM chosen", PERIOD),
        "hashtag_category": f"WITH {DOCTAGS} SELECT {case_of('hashtag', TAG_CATEGORY, q(C.OTHER_CATEGORY))} AS category, count(*) AS tags, CAST(sum(uses) AS BIGINT) AS uses FROM doctags GROUP BY category",
        "hashtag_related": f"""WITH {DOCTAGS} SELECT related, count(*) AS tags, CAST(sum(uses) AS BIGINT) AS uses
            FROM (SELECT unnest({case_of('hashtag', C.HASHTAG_KEYWORDS, lst(C.DEFAULT_HASHTAG_KEYWORDS), True)}) AS related, uses FROM doctags) GROUP BY related""",
        "topic_category": f"WITH {DOCTAGS} SELECT {category('word')} AS category, count(*) AS topics, CAST(sum(uses) AS BIGINT) AS uses FROM doctags GROUP BY category",
        "url_site": r"""SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]*)', 1) AS site,
            CASE WHEN page_id % 2 = 0 THEN rtrim(url, '/') || '/item/' || page_id ELSE 'http://x.org/' || page_id END AS link,
            regexp_extract(url, '^[a-z]+://([^/]*)', 1) AS subreddit FROM pages""",
        "dedupe_exact": f"SELECT min(doc_id) AS ingest_seq FROM documents WHERE text <> '' GROUP BY {chash('text')}",
        "clean_frame": f"""WITH f AS (SELECT doc_id, {clean('text', True)} AS c, {clean(doc_title, True)} AS t FROM documents WHERE doc_id % 29 <> 4 AND doc_id % 31 <> 6),
            k AS (SELECT * FROM f WHERE length(c) > 10 QUALIFY row_number() OVER (PARTITION BY c ORDER BY doc_id) = 1)
            SELECT doc_id AS ingest_seq, lower(t) AS title, {n_words('c')} AS word_count, round({readability('c')}, 6) AS readability_score FROM k""",
        "basic_stats": with_posts(f"SELECT {basic}"),
        "basic_stats_by_platform": with_posts(f"SELECT platform, {basic} GROUP BY platform"),
        "source_counts": with_posts("SELECT coalesce(source, 'Unknown') AS source, count(*) AS n FROM posts GROUP BY 1"),
        "category_counts": with_posts("SELECT coalesce(category, 'General') AS category, count(*) AS n FROM posts GROUP BY 1"),
        "word_count_stats": with_posts("SELECT round(avg(word_count), 6) AS mean, round(CAST(median(word_count) AS DOUBLE), 6) AS median, round(stddev_samp(word_count), 6) AS std, min(word_count) AS min, max(word_count) AS max FROM counted"),
        "sentiment_stats": with_posts("""SELECT round(avg(sentiment_polarity), 6) AS avg_sentiment, round(avg(CAST(sentiment_polarity > 0.1 AS DOUBLE)), 6) AS positive_ratio,
            round(avg(CAST(sentiment_polarity < -0.1 AS DOUBLE)), 6) AS negative_ratio, round(avg(CAST(abs(sentiment_polarity) <= 0.1 AS DOUBLE)), 6) AS neutral_ratio FROM posts"""),
        "hourly_sentiment": with_posts(f"""SELECT {iso("date_trunc('hour', dated)")} AS hour, {mean_of_scores()} AS avg_sentiment, count(*) AS article_count,
            round(coalesce(stddev_samp(sentiment_polarity), 0.0), 6) AS sentiment_volatility FROM posts WHERE sentiment_polarity <> 0 AND dated IS NOT NULL GROUP BY 1"""),
        "sentiment_distribution": with_posts(f"SELECT part AS platform, {rounded_mood} FROM mood", distribution("platform")),
        "sentiment_by_source": with_posts("""SELECT source, sign(s) * ((200 * abs(s) + n) // (2 * n)) / 1e6 AS avg_sentiment, n AS article_count FROM (
            SELECT coalesce(source, 'Unknown') AS source, CAST(sum(CAST(round(sentiment_polarity * 10000) AS BIGINT)) AS BIGINT) AS s, count(*) AS n
            FROM posts WHERE sentiment_polarity <> 0 AND dated IS NOT NULL GROUP BY 1)"""),
        # in millionths and whole numbers, so that a score between two results is rounded as it is
        "engagement_score": with_posts("""SELECT source, (2 * ((40000 * least(n, 10) + 150000) * n + 600 * least(w, 500 * n) + 15 * s) + n) // (2 * n) / 1e6 AS engagement_score FROM (
            SELECT coalesce(source, 'Unknown') AS source, count(*) AS n, CAST(sum(word_count) AS BIGINT) AS w,
                CAST(sum(CAST(round(sentiment_polarity * 10000) AS BIGINT)) AS BIGINT) AS s FROM counted GROUP BY 1)"""),
        "peak_hour_of_day": with_posts("""SELECT h AS peak_hour, n AS posts_in_hour, CAST(total AS BIGINT) AS dated_posts FROM (
            SELECT hour(dated) AS h, count(*) AS n, min(ingest_seq) AS f, sum(count(*)) OVER () AS total FROM posts WHERE dated IS NOT NULL GROUP BY h)
            WHERE total > 5 ORDER BY n DESC, f LIMIT 1"""),
        "storage_stats": with_posts(f"""SELECT 'total_raw_records' AS statistic, {NULLS} AS source, count(*) AS n FROM posts
            UNION ALL SELECT 'records_by_source', coalesce(source, 'Unknown'), count(*) FROM posts GROUP BY 2
            UNION ALL SELECT 'total_analyses', NULL, count(*) FROM figures
            UNION ALL SELECT 'total_recommendations', NULL, count(*) FROM ({ENGAGEMENT_RECS})""", figures("platform")),
        "community_health": with_posts(f"""SELECT platform, round(e, 6) AS engagement_rate, round(s, 6) AS sentiment_score,
            CASE WHEN n > 100 THEN 'high' WHEN n > 50 THEN 'medium' ELSE 'low' END AS activity_level,
            round(least(e / 10, 40) + (s + 1) * 15 + least(n / 10, 30), 6) AS health_score FROM (
            SELECT platform, count(*) AS n, avg({REACTIONS}) AS e, coalesce(avg(sentiment_polarity) FILTER (body <> ''), 0.0) AS s FROM posts GROUP BY platform)"""),
        "length_buckets": with_posts(f"""SELECT b.name AS length_range, round(coalesce(avg({REACTIONS}), 0.0), 6) AS average_score, count(ingest_seq) AS count
            FROM (VALUES ('short (0-100)', 0, 100), ('medium (101-300)', 101, 300), ('long (301+)', 301, 1000000000)) AS b(name, lo, hi)
            LEFT JOIN posts ON length(body) BETWEEN lo AND hi GROUP BY 1"""),
        "hashtag_performance": with_posts(f"SELECT hashtag, round(avg(e), 6) AS average_score, count(*) AS usage_count, CAST(sum(e) AS BIGINT) AS total_score FROM (SELECT unnest(hashtags) AS hashtag, {REACTIONS} AS e FROM posts) GROUP BY hashtag"),
        "unique_users": with_posts("SELECT count(DISTINCT coalesce(username, author)) AS total_unique_users FROM posts WHERE coalesce(username, author) <> 'anonymous'"),
        "top_users": with_posts("""SELECT u AS user, n AS posts, row_number() OVER (ORDER BY n DESC, f) AS rank FROM (
            SELECT coalesce(username, author) AS u, count(*) AS n, min(ingest_seq) AS f FROM posts GROUP BY u) WHERE u <> 'anonymous' QUALIFY rank <= 10"""),
        "peak_hours": with_posts("SELECT hour(created) AS hour, count(*) AS posts, row_number() OVER (ORDER BY count(*) DESC, min(ingest_seq)) AS rank FROM posts GROUP BY 1 QUALIFY rank <= 5"),
        "peak_days": with_posts("SELECT dayname(created) AS weekday, count(*) AS posts, row_number() OVER (ORDER BY count(*) DESC, min(ingest_seq)) AS rank FROM posts GROUP BY 1"),
        "top_content": top_posts("''"),
        "top_content_by_platform": top_posts("platform"),
        "activity_spikes": """WITH h AS (SELECT strftime(ts, '%Y-%m-%d-%H') AS hour, count(*) AS n FROM events GROUP BY hour), s AS (SELECT avg(n) AS m, stddev_pop(n) AS sd FROM h)
            SELECT hour, n AS count, round(n - m, 6) AS deviation, k AS deviations FROM h, s, (SELECT unnest([1.5::DOUBLE, 2.0::DOUBLE]) AS k) WHERE n > m + k * sd""",
        "sentiment_anomalies": with_posts("""SELECT ingest_seq, left(body, 100) || '...' AS excerpt, round(sentiment_polarity, 6) AS sentiment, created_at AS posted, k AS deviations
            FROM posts, (SELECT avg(sentiment_polarity) AS m, stddev_pop(sentiment_polarity) AS sd FROM posts WHERE body <> ''), (SELECT unnest([1.5::DOUBLE, 2.0::DOUBLE]) AS k)
            WHERE body <> '' AND abs(sentiment_polarity - m) > k * sd"""),
        "topic_predictions": with_posts(rf"""SELECT row_number() OVER (ORDER BY n DESC, f) AS rank, w AS topic, n AS mentions, CASE WHEN n > 5 THEN 'increasing' ELSE 'stable' END AS predicted_growth
            FROM (SELECT w, count(*) AS n, min(ingest_seq * 1000000 + pos) AS f FROM (
              SELECT ingest_seq, unnest(l) AS w, generate_subscripts(l, 1) AS pos FROM (SELECT ingest_seq, string_split_regex(lower(body), '[^\p{{L}}\p{{N}}_]+') AS l FROM posts))
            WHERE regexp_full_match(w, '[a-z]{{4,}}') GROUP BY w) WHERE n >= 3 QUALIFY rank <= 10"""),
        "engagement_forecast": with_posts(f"SELECT platform, round(avg({REACTIONS}), 6) AS average_current, round(avg({REACTIONS}) * 1.1, 6) AS predicted_next_period, 'medium' AS confidence FROM posts GROUP BY platform"),
        "competitor_mentions": with_posts(f"""SELECT c AS competitor, CAST(sum(n) AS BIGINT) AS mentions FROM (
            SELECT c, {count_of('lower(body)', 'c')} AS n FROM posts, (SELECT unnest({lst(NAMES)}) AS c)) GROUP BY c HAVING sum(n) > 0"""),
        "competitor_contexts": f"""WITH t AS (SELECT conv_id * 1000 + turn AS ingest_seq, {words('lower(text)')} AS w FROM conversations),
            p AS (SELECT ingest_seq, w, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM t),
            names AS (SELECT unnest({lst(NAMES)}) AS competitor, generate_subscripts({lst(NAMES)}, 1) AS o)
            SELECT row_number() OVER (ORDER BY ingest_seq, o, pos) AS rank, ingest_seq, competitor, array_to_string(w[greatest(pos - 3, 1):pos + 3], ' ') AS context
            FROM p JOIN names ON contains(word, competitor) QUALIFY rank <= 20""",
        "keyword_trends": with_posts(f"SELECT {TREND_COLUMNS} FROM trends", trend_ctes()),
        "keyword_trends_by_platform": with_posts(f"SELECT part AS platform, {TREND_COLUMNS} FROM trends", trend_ctes("platform")),
        "trend_peak_hour": with_posts(f"SELECT topic, {iso('peak_time')} AS peak_time FROM trends", trend_ctes()),
        "related_keywords": f"""WITH t AS (SELECT {words('lower(text)')} AS w FROM documents), p AS (SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS k FROM t),
            top AS (SELECT k, row_number() OVER (ORDER BY count(*) DESC, k) AS rank FROM p GROUP BY k QUALIFY rank <= 30),
            r AS (SELECT a.k, b.k AS other, row_number() OVER (PARTITION BY a.k ORDER BY b.rank) AS o FROM top a JOIN top b ON b.rank <= 15 AND a.k <> b.k
              AND len(list_intersect(string_split(a.k, ' '), string_split(b.k, ' '))) > 0)
            SELECT top.rank, top.k AS keyword, coalesce(string_agg(other, ', ' ORDER BY o) FILTER (o <= 3), '') AS related_keywords FROM top LEFT JOIN r USING (k) GROUP BY ALL""",
        "hashtag_trends": f"""WITH {TAGGED} SELECT hashtag, c AS current_mentions, p AS previous_mentions, round(g, 8) AS growth_rate, platforms, round(mood, 8) AS sentiment_score,
            round(rate, 8) AS engagement_rate, spread AS geographic_spread, round(score, 8) AS trend_score, velocity, prediction,
            {case_of('hashtag', TAG_CATEGORY, q(C.OTHER_CATEGORY))} AS category, '{','.join(C.DEFAULT_HASHTAG_KEYWORDS)}' AS related_keywords FROM hashtags""",
        "emerging_topics": with_posts(f"SELECT rank, topic, 'Emerging technology trend related to ' || word AS description, n AS mention_count, round(conf, 6) AS confidence_score, {category('word')} AS trend_category FROM topics", TOPICS),
        "content_velocity": with_posts("SELECT * REPLACE (round(avg_engagement_per_post, 6) AS avg_engagement_per_post, round(avg_hourly_posting_rate, 6) AS avg_hourly_posting_rate, round(avg_daily_posting_rate, 6) AS avg_daily_posting_rate) FROM velocity", VELOCITY),
        "velocity_trend": """WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY day), r AS (SELECT *, row_number() OVER (ORDER BY day) AS up, row_number() OVER (ORDER BY day DESC) AS down FROM d)
            SELECT CASE WHEN count(*) < 2 THEN 'insufficient_data' WHEN count(*) < 4 THEN 'stable' WHEN avg(n) FILTER (down <= 2) > avg(n) FILTER (up <= 2) * 1.2 THEN 'increasing'
            WHEN avg(n) FILTER (down <= 2) < avg(n) FILTER (up <= 2) * 0.8 THEN 'decreasing' ELSE 'stable' END AS velocity_trend FROM r""",
        "trend_summary": summary,
        "trend_advice": advice,
        "trend_run": f"""WITH s AS ({summary}), a AS ({advice}), h AS (WITH {TAGGED} SELECT count(*) AS n FROM hashtags), t AS ({with_posts('SELECT count(*) AS n FROM topics', TOPICS)})
            SELECT 'hashtag_trends' AS section, n AS rows FROM h UNION ALL SELECT 'emerging_topics', n FROM t WHERE n > 0 UNION ALL SELECT 'content_velocity', 1
            UNION ALL SELECT 'trend_summary', count(*) FROM s UNION ALL SELECT 'key_recommendations', count(*) FROM a""",
        "insights": with_posts("SELECT generate_subscripts(l, 1) AS insight_no, unnest(l) AS insight FROM lines", trend_ctes(), insight_ctes()),
        "scored_insights": scored,
        "analytics_report": with_posts(f"""SELECT {iso('now - INTERVAL 24 HOUR')} AS period_start, {iso('now')} AS period_end, (SELECT count(*) FROM chosen) AS total_articles,
            (SELECT CAST(coalesce(sum(mentions), 0) AS BIGINT) FROM ptrends) AS total_mentions, (SELECT string_agg(topic, ',' ORDER BY rank) FROM ptrends WHERE rank <= 10) AS topics,
            (SELECT round(coalesce(avg(CAST(sentiment_polarity > 0.1 AS DOUBLE)), 0), 6) FROM chosen WHERE sentiment_polarity <> 0 AND dated IS NOT NULL) AS positive,
            (SELECT round(coalesce(avg(CAST(sentiment_polarity < -0.1 AS DOUBLE)), 0), 6) FROM chosen WHERE sentiment_polarity <> 0 AND dated IS NOT NULL) AS negative,
            (SELECT round(coalesce(avg(CAST(abs(sentiment_polarity) <= 0.1 AS DOUBLE)), 1), 6) FROM chosen WHERE sentiment_polarity <> 0 AND dated IS NOT NULL) AS neutral,
            (SELECT string_agg(s || '=' || n, ',' ORDER BY s) FROM (SELECT coalesce(source, 'Unknown') AS s, count(*) AS n FROM chosen GROUP BY s)) AS sources,
            (SELECT array_to_string(l, ' | ') FROM lines) AS insights FROM clock""", PERIOD, trend_ctes(source="chosen", name="ptrends"), insight_ctes("chosen", "ptrends")),
        "report_json": with_posts(f"""SELECT {iso('now - INTERVAL 24 HOUR')} AS period_start, CAST((SELECT count(*) FROM chosen) AS VARCHAR) AS total_articles,
            CAST((SELECT CAST(coalesce(sum(mentions), 0) AS BIGINT) FROM ptrends) AS VARCHAR) AS total_mentions, (SELECT topic FROM ptrends WHERE rank = 1) AS first_topic,
            (SELECT l[1] FROM lines) AS first_insight FROM clock""", PERIOD, trend_ctes(source="chosen", name="ptrends"), insight_ctes("chosen", "ptrends")),
        "recommend_trends": with_posts(f"SELECT {REC} FROM ({trend_recommendations()})", trend_ctes()),
        "recommend_sentiment": with_posts(f"SELECT part AS platform, {REC} FROM ({SENTIMENT_RECS})", distribution("platform")),
        "recommend_engagement": with_posts(f"SELECT part AS platform, {REC} FROM ({ENGAGEMENT_RECS})", figures("platform")),
        "recommend_timing": with_posts(f"SELECT part AS platform, {REC} FROM ({TIMING_RECS})", figures("platform"), SLOTS),
        "recommend_fallback": with_posts(f"""SELECT part AS source, ord AS rank, {REC}, {iso('now')} AS generated_at, 0.6::DOUBLE AS confidence_score FROM (
            SELECT part, 1 AS ord, {fixed('fallback_welcome')} FROM without, clock UNION ALL SELECT part, 2, {fixed('fallback_tips')} FROM without, clock
            UNION ALL SELECT part, 3, {fixed('fallback_showcase')} FROM without, clock), clock""",
            "without AS (SELECT DISTINCT source AS part FROM documents WHERE source NOT IN (SELECT source FROM posts WHERE shares = 6 AND likes > 100 AND source IS NOT NULL))"),
        "recommend_all": with_posts(f"SELECT rank, {REC}, generated_at, round(CAST(confidence_score AS DOUBLE), 6) AS confidence_score FROM ranked", all_recommendations("''")),
        "recommend_all_by_platform": with_posts(f"SELECT part AS platform, rank, {REC}, generated_at, round(CAST(confidence_score AS DOUBLE), 6) AS confidence_score FROM ranked", all_recommendations("platform")),
        "recommendation_bands": with_posts("""SELECT part AS platform, count(*) AS total_recommendations, count(*) FILTER (confidence_score > 0.8) AS high,
            count(*) FILTER (confidence_score BETWEEN 0.6 AND 0.8) AS medium, count(*) FILTER (confidence_score < 0.6) AS low FROM ranked GROUP BY part""", all_recommendations("platform")),
        "recommendations_by_analysis": with_posts(f"SELECT analysis_id, type AS recommendation_type, priority, {iso('timestamp')} AS analyzed_at FROM ({ENGAGEMENT_RECS}) JOIN analyses USING (part)", figures("platform"), ANALYSES),
        "ingest_reddit": with_posts(f"""SELECT ingest_seq, post_id, title, md5(CASE WHEN ingest_seq % 3 = 0 OR body = '' THEN title ELSE body END) AS content_md5,
            'https://reddit.com/r/x/' || post_id AS permalink, CASE WHEN ingest_seq % 10 = 9 THEN '[deleted]' ELSE author END AS author, platform AS subreddit, likes AS score,
            comments AS num_comments, {iso('created')} AS created_at, CASE WHEN ingest_seq % 2 = 0 THEN 'self_post' ELSE 'link_post' END AS post_type,
            least(5, {n_words('body')}) AS n_comments, CASE WHEN {n_words('body')} > 0 THEN '[deleted]' END AS first_comment_author FROM posts"""),
        "ingest_stackoverflow": with_posts(f"""SELECT post_id, coalesce(title, '') AS title, md5(c) AS content_md5, length(c) AS content_length,
            CASE WHEN ingest_seq % 10 = 9 THEN 'Anonymous' ELSE author END AS author, comments AS author_reputation, likes AS score, 0 AS view_count, {iso('created')} AS created_at,
            array_to_string(hashtags, ',') AS tags, ingest_seq % 2 = 0 AS is_answered, platform AS keyword_searched
            FROM (SELECT *, CASE WHEN content IS NULL THEN '' ELSE left({unescape("regexp_replace(content || ' &lt;b&gt;', '<[^>]*>', '', 'g')")}, 1000) END AS c FROM posts)"""),
        "ingest_hackernews": with_posts(f"""SELECT post_id, coalesce(title, '') AS title, md5(body) AS content_md5, 'https://news.ycombinator.com/item?id=' || post_id AS permalink,
            CASE WHEN ingest_seq % 10 = 9 THEN 'Anonymous' ELSE author END AS author, likes AS score, CASE WHEN ingest_seq % 4 = 0 THEN 0 ELSE comments END AS comment_count,
            {iso('created')} AS created_at, 'story' AS story_type FROM posts"""),
        "ingest_tweets": with_posts("""SELECT post_id, md5(content) AS content_md5, author AS username, comments AS user_followers, created_at, likes, shares AS retweets,
            CASE WHEN ingest_seq % 3 = 0 THEN comments ELSE 0 END AS replies, array_to_string(hashtags, ',') AS hashtags, author AS mentions, url AS urls,
            ingest_seq % 5 = 0 AS is_retweet, CASE WHEN ingest_seq % 2 = 1 THEN platform END AS location, category AS keyword_searched FROM posts"""),
        "ingest_rss": with_posts(rf"""SELECT n AS ingest_seq, i AS position, 'Entry ' || i AS title, md5(left(trim(s[i + 1]), 1000)) AS content_md5, 'https://ex.org/' || i AS url, source,
            'Unknown' AS author, strftime(now, '%Y-%m-%d %H:%M:%S') AS date, 'RSS Feed' AS category FROM (
            SELECT n, source, s, unnest(range(least(10, len(s)))) AS i FROM (SELECT doc_id AS n, source,
              list_filter(string_split(regexp_replace(text, '[^\p{{L}}\p{{N}} .&<]', ' ', 'g'), '.'), lambda x: regexp_matches(x, '{NSP}')) AS s FROM documents)), clock"""),
        "ingest_trending": f"""SELECT ingest_seq, i AS rank, '#' || w[i] AS name, '' AS url, CASE WHEN length(w[i]) % 2 = 0 THEN length(w[i]) ELSE 0 END AS tweet_volume, 'Twitter Trends' AS source
            FROM (SELECT doc_id AS ingest_seq, w, unnest(range(1, least(20, len(w)) + 1)) AS i FROM (SELECT doc_id, {words('text')} AS w FROM documents))""",
        "extract_articles": f"""WITH a AS (SELECT page_id, url, {ARTICLE} AS a FROM pages WHERE contains(html, '<article>')),
            b AS (SELECT *, regexp_extract(a, '(?s)<h1[^>]*>(.*?)</h1>', 1) AS h, regexp_extract(a, '(?s)<p[^>]*>(.*)$', 1) AS after_p FROM a),
            c AS (SELECT *, CASE WHEN position('</p>' IN after_p) = 0 THEN after_p WHEN position('<p>' IN after_p) = 0 OR position('</p>' IN after_p) < position('<p>' IN after_p)
               THEN regexp_extract(after_p, '(?s)^(.*?)</p>', 1) ELSE after_p END AS p FROM b)
            SELECT page_id, 0 AS position, {unescape('trim(' + UNTAG.format(x='h') + ')')} AS title, {unescape('trim(' + UNTAG.format(x='p') + ')')} AS content,
            '' AS url, regexp_extract(url, '^[a-z]+://([^/]*)', 1) AS source, {NULLS} AS author, 'General' AS category FROM c WHERE length({unescape('trim(' + UNTAG.format(x='h') + ')')}) >= 10""",
        "keyword_search": with_posts(f"""SELECT k AS keyword_searched, row_number() OVER (PARTITION BY k ORDER BY dated DESC NULLS LAST, ingest_seq) AS rank, ingest_seq, k AS keywords_matched
            FROM posts, (SELECT unnest({lst(TERMS)}) AS k) WHERE contains(lower(coalesce(title, '') || ' ' || body), k) QUALIFY rank <= 15"""),
        "raw_envelope": with_posts(f"SELECT ingest_seq AS id, coalesce(source, 'Unknown') AS source, 'posts' AS type, md5(body) AS content_md5, title, likes, {iso('event_time')} AS timestamp, false AS processed FROM posts"),
        "load_raw": with_posts(f"SELECT ingest_seq AS id, source, {iso('event_time')} AS timestamp FROM posts WHERE source = 'src3' ORDER BY event_time DESC, ingest_seq LIMIT 1000"),
        "load_latest_analysis": with_posts(f"SELECT strftime(hour, 'analysis_%Y%m%d_%H') AS analysis_id, n AS total_items, {iso('hour')} AS timestamp FROM hourly ORDER BY hour DESC LIMIT 1", HOURLY),
        "upsert_analysis": with_posts("SELECT strftime(hour, '%Y%m%d_%H') AS analysis_id, n + CASE WHEN hour(hour) % 2 = 0 THEN 1 ELSE 0 END AS total_items FROM hourly", HOURLY),
        "export_csv": with_posts("""SELECT ingest_seq, source, platform, likes, '["' || array_to_string(hashtags, '","') || '"]' AS hashtags, url FROM posts"""),
        "unified_by_family": with_posts(f"""SELECT 'news' AS family, source, count(*) AS posts, count(*) AS titles FROM documents GROUP BY source
            UNION ALL SELECT CASE WHEN platform IN ('reddit', 'quora') THEN 'forums' ELSE 'social' END,
              CASE platform WHEN 'reddit' THEN 'Reddit' WHEN 'quora' THEN 'Quora' WHEN 'twitter' THEN 'Twitter' ELSE 'LinkedIn' END, count(*),
              CASE WHEN platform IN ('reddit', 'quora') THEN count(title) ELSE 0 END FROM posts GROUP BY platform"""),
        "unified_posts": with_posts(f"""SELECT platform, count(*) AS posts, CAST(sum({n_words('body')}) AS BIGINT) AS words FROM (SELECT *, NULL AS url FROM (
              SELECT doc_id AS o, 'news' AS platform, text AS body, {doc_title} AS title FROM documents
              UNION ALL SELECT CASE platform WHEN 'twitter' THEN 1 WHEN 'linkedin' THEN 2 WHEN 'reddit' THEN 3 ELSE 4 END * 1000000000::BIGINT + ingest_seq, platform, body,
                CASE WHEN platform IN ('reddit', 'quora') THEN title END FROM posts)
            WHERE body <> '' QUALIFY row_number() OVER (PARTITION BY {chash('body')} ORDER BY o) = 1) WHERE len({ISSUES}) = 0 GROUP BY platform"""),
        "cycle_analysis": with_posts(f"""
            SELECT 'total_items' AS section, 1 AS position, {iso('min(dated)')} || ' - ' || {iso('max(dated)')} AS label, CAST(count(*) AS DOUBLE) AS value FROM posts
            UNION ALL SELECT 'unique_sources', 1, 'sources', count(DISTINCT source) FROM posts
            UNION ALL SELECT 'trend', rank, topic || ' ' || direction, round(velocity * confidence, 6) FROM ctrends WHERE rank <= 10
            UNION ALL SELECT 'positive', 1, 'ratio', round(positive, 6) FROM mood UNION ALL SELECT 'negative', 1, 'ratio', round(negative, 6) FROM mood
            UNION ALL SELECT 'hourly_sentiment', count(*), {iso("date_trunc('hour', dated)")}, {mean_of_scores()} FROM texts WHERE sentiment_polarity <> 0 AND dated IS NOT NULL GROUP BY date_trunc('hour', dated)
            UNION ALL SELECT 'source', 1, coalesce(source, 'Unknown'), count(*) FROM posts GROUP BY 3
            UNION ALL SELECT 'source_sentiment', count(*), coalesce(source, 'Unknown'), {mean_of_scores()} FROM texts WHERE sentiment_polarity <> 0 AND dated IS NOT NULL GROUP BY 3
            UNION ALL SELECT 'insight', generate_subscripts(l, 1), unnest(l), 5 FROM lines""",
            "texts AS (SELECT * FROM counted WHERE body <> '' OR coalesce(title, '') <> '')", trend_ctes(source="texts", name="ctrends", least=3),
            distribution("''").replace("FROM posts)", "FROM texts)"), insight_ctes("texts", "ctrends")),
        "cycle_summary": with_posts(f"""SELECT strftime(now, 'cycle_%Y%m%d_%H%M%S') AS cycle_id, (SELECT count(*) FROM valid) AS total_items_collected,
            (SELECT count(DISTINCT coalesce(source, 'Unknown')) FROM valid) AS sources_accessed, (SELECT len(l) FROM lines) AS total_insights,
            (SELECT least(5, count(*)) FROM vtrends WHERE rank <= 10) + (SELECT CAST(positive > 0.7 OR negative > 0.4 AS INTEGER) FROM vmood)
              + (SELECT CAST(count(*) > 50 AS INTEGER) + CAST(count(DISTINCT coalesce(source, 'Unknown')) > 5 AS INTEGER) FROM valid) + 3 AS total_recommendations,
            (SELECT count(*) > 0 FROM valid) AS analysis_success FROM clock""", cycle_scores, scored_filter, trend_ctes(source="valid", name="vtrends", least=3), insight_ctes("valid", "vtrends"),
            distribution("''").replace("mood AS", "vmood AS", 1).replace("FROM posts)", "FROM valid)")),
        "stream_hourly": f"""WITH s AS (SELECT ts, round(least(1.0, (value - 50) / 100), 4) AS p FROM documents JOIN events ON doc_id = event_id)
            SELECT {iso("date_trunc('hour', ts)")} AS hour, count(*) AS posts, {mean_of_scores("nullif(p, 0)")} AS avg_sentiment FROM s
            WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM s) GROUP BY date_trunc('hour', ts)""",
        "quarantined_records": """SELECT doc_id, CASE WHEN doc_id % 10 NOT IN (3, 7) THEN CAST(doc_id AS VARCHAR) END AS post_id,
            CASE WHEN doc_id % 10 NOT IN (3, 7) THEN lang END AS title, CASE WHEN doc_id % 10 NOT IN (3, 7) THEN n_chars END AS score,
            CASE doc_id % 10 WHEN 3 THEN 'malformed' WHEN 7 THEN 'wrong type' END AS reason FROM documents""",
        "stream_dedupe": f"SELECT DISTINCT {chash('text')} AS content_hash FROM documents WHERE text <> ''",
        "stream_cycle": f"""WITH v AS (SELECT * FROM (SELECT doc_id, source, text AS body, {doc_title} AS title, NULL AS url FROM documents WHERE text <> ''
              QUALIFY row_number() OVER (PARTITION BY {chash('text')} ORDER BY doc_id) = 1) WHERE len({ISSUES}) = 0)
            SELECT 'analysis_batch_0' AS analysis_id, count(*) AS total_items_collected, count(DISTINCT source) AS sources_accessed FROM v""",
    }
    queries["cycle_stored"] = f"SELECT 'analysis_1' AS analysis_id, * FROM ({queries['cycle_analysis']})"
    return queries
