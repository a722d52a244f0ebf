"""Quality rules: base measures of a text, a hashed n-gram log-likelihood ratio, and n-grams that tell toxic texts.

All of it is DataFrame operations. A text's units are its runs of letters and digits and its runs of other marks; its n-grams are the units and the
pairs of neighbouring units. They are hashed into buckets, whose number follows the length of the corpus (``CHARS_A_BUCKET``). The raw corpus gives one
multinomial, from every document; trusted documents (labelled good and not toxic) give the other. A text's score is the mean over its
n-grams of log(p_trusted / p_raw), so it doesn't depend on the length. The weights are whole thousandths of two bytes, in pages of ``PAGE`` buckets. Up to
``IN_ROW_BUCKETS`` of them (64 MB, the counts of some 34 GB of text) are read in the row as one scalar, and n-grams are never shuffled; beyond, their table is
joined to the n-grams, with the same result. Documents under the threshold are rejected.

The mean hides a few insults in a long text. So each n-gram, by its whole hash, that stands in ``MIN_TOXIC`` toxic documents also has the log of its share of toxic documents to its share of
the others; a text is judged by its worst n-gram as well, and rejected where that is over a second threshold. Every document
is judged by the same thresholds, fixed before the judging.

The labelled rows used are a bounded sample: of each kind (good, bad, toxic) the ``SAMPLE`` rows with the least hash of their id, at most. The counts of the raw
corpus cover all documents. Half of the sample is counted; the other half, which the counts have not seen (and the bad rows, which only stand among
the others for toxic n-grams), sets the thresholds, first the one on the worst n-gram, by good and toxic rows, then the one on the mean, by the rows that are left, toxic
ones as bad. Each is the score that parts the two best, a lost good one weighing ``CLEAN_WEIGHT`` times a kept bad one,
read from a histogram in steps of ``STEP``; among equals the least, so that clean documents stay. Without labels of both kinds nothing but
the base rules rejects.

A null or empty text has no words and fails the base rules. Repeated rows are judged alike. Labels that contradict each other count as
bad; labels without a document and null ids are not used. Other columns of the documents are kept by ``judge`` and ``keep_good``;
columns that it adds start with ``q_``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.shared import load, materialize, session, text_or_empty

BUCKETS = 8192  # at least
CHARS_A_BUCKET = 1024
SCALE = 1_000  # weights are summed as whole numbers, so that the order doesn't matter; a log ratio of up to 32 fits two bytes
IN_ROW_BUCKETS = 1 << 25
PAGE = 4096  # buckets a page; BUCKETS is a multiple
SAMPLE = 5_000
STEP = 0.01
MIN_TOXIC = 2  # toxic documents that hold an n-gram; one is no evidence of its kind
SMOOTHING = 1.0
CLEAN_WEIGHT = 20  # a share of good documents lost counts as that many times the share of bad ones kept
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW = 8
SPACES = r"[ \t-\r]+"
UNIT = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def repeated_words(codes: Column) -> Column:
    """Words in windows of eight that occur twice or more; codes are hashes of the words.

    Windows are hashed. Only a text with equal windows goes on to sort (hash, position) and to measure what the repeated
    windows cover together.
    """

    def covered(windows: Column) -> Column:
        marked = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = lambda m, x, j: F.coalesce(x.h == F.get(m, j).h, F.lit(False))
        twice = let(marked, lambda m: F.filter(m, lambda x, j: same(m, x, j - 1) | same(m, x, j + 1)))
        return F.aggregate(
            F.array_sort(F.transform(twice, lambda x: x.i)),
            F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda s, i: F.struct((s.n + F.least(F.lit(WINDOW), i - s.last)).alias("n"), i.alias("last")),
            lambda s: s.n,
        )

    def hashed(c: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(c) - WINDOW)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(c, i + k) for k in range(WINDOW)]))

    some = lambda w: F.size(F.array_distinct(w)) < F.size(w)
    count = let(let(codes, hashed), lambda w: F.when(some(w), covered(w)).otherwise(0))
    return F.when(F.size(codes) <= WINDOW, 0).otherwise(count).cast("long")


def grams(codes: Column) -> Column:
    """Hashes of the units and of the pairs of neighbours."""

    def both(c: Column) -> Column:
        pairs = F.transform(c, lambda x, i: F.xxhash64(x, F.get(c, i - 1)))
        return F.concat(c, F.slice(pairs, F.lit(2), F.greatest(F.size(c) - 1, F.lit(0))))

    return let(codes, both)


def gram_rows(docs: DataFrame, *keep: str | Column) -> DataFrame:
    """A row for each n-gram, as q_gram: the same hashes as ``grams`` has, but the pairs are hashed after the units are rows."""
    units = F.col("q_units")
    neighbours = F.arrays_zip(units, F.slice(units, F.lit(2), F.greatest(F.size(units) - 1, F.lit(0))))
    rows = docs.select(*keep, F.inline(neighbours).alias("q_unit", "q_next"))
    both = F.array("q_unit", F.when(F.col("q_next").isNotNull(), F.xxhash64("q_next", "q_unit")))
    return rows.withColumn("q_gram", F.explode(both)).drop("q_unit", "q_next").filter("q_gram is not null")


def with_units(docs: DataFrame) -> DataFrame:
    """The documents with ``q_units``, a hash of each unit."""
    units = F.regexp_extract_all(text_or_empty("text"), F.lit(UNIT), F.lit(0))
    return docs.withColumn("q_units", F.transform(units, lambda w: F.xxhash64(w)))


def labelled_sample(labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """q_id, q_good, q_toxic, q_counted of at most ``size`` rows of each kind, those with the least hash of their id; neither good nor toxic is bad."""
    good = (F.min("quality") == 1) & (F.max("toxic") == 0)
    toxic = F.coalesce(F.max("toxic") == 1, F.lit(False))
    bad = F.min("quality") == 0
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("q_id")).agg(good.alias("q_good"), toxic.alias("q_toxic"), bad.alias("bad"))
    order = [F.xxhash64("q_id"), F.col("q_id")]
    kinds = [known.filter(k).orderBy(*order).limit(size) for k in ("q_good", "q_toxic", "bad and not q_toxic")]
    sample = kinds[0].unionByName(kinds[1]).unionByName(kinds[2])
    return sample.select("q_id", F.coalesce("q_good", F.lit(False)).alias("q_good"), "q_toxic", (F.pmod(F.xxhash64("q_id", F.lit(1)), F.lit(2)) == 0).alias("q_counted"))


class Model:
    """Weights of the buckets, the threshold of their mean, and the n-grams that reject; the same for every document."""

    def __init__(
        self, weights: DataFrame | list[float], threshold: float | None, buckets: int = BUCKETS, unseen: int = 0, toxic: list[int] = (),
        in_row: int = IN_ROW_BUCKETS,
    ):
        self.weights, self.threshold, self.buckets, self.unseen, self.toxic = weights, threshold, buckets, unseen, list(toxic)
        self.in_row, self.stored = buckets <= in_row, None

    def pages(self) -> DataFrame:
        """One row: the weights by bucket as pages of two-byte numbers."""
        if self.stored is None:
            every = self.weights.sparkSession.range(self.buckets).select(F.col("id").cast("int").alias("bucket"))
            filled = every.join(self.weights, "bucket", "left").select("bucket", F.coalesce("weight", F.lit(self.unseen)).cast("short").alias("weight"))
            paged = filled.groupBy(F.expr(f"bucket div {PAGE}").alias("page")).agg(
                F.transform(F.array_sort(F.collect_list(F.struct("bucket", "weight"))), lambda x: x.weight).alias("weights")
            )
            whole = paged.agg(F.transform(F.array_sort(F.collect_list(F.struct("page", "weights"))), lambda x: x.weights).alias("pages"))
            self.stored = materialize(whole, "quality-pages")
        return self.stored

    def weighed(self, found: DataFrame) -> DataFrame:
        """The rows of n-grams (column q_gram) with q_weight, in parts of 1 / ``SCALE``."""
        rows = found.withColumn("q_bucket", F.pmod("q_gram", F.lit(self.buckets)).cast("int")).drop("q_gram")
        if self.in_row:
            pages = self.pages().scalar()
            weight = F.get(F.get(pages, F.expr(f"q_bucket div {PAGE}").cast("int")), F.col("q_bucket") % PAGE)
            return rows.withColumn("q_weight", weight.cast("long")).drop("q_bucket")
        weights = self.weights.select(F.col("bucket").alias("q_bucket"), F.col("weight").alias("q_known"))
        return rows.join(weights, "q_bucket", "left").withColumn("q_weight", F.coalesce("q_known", F.lit(self.unseen))).drop("q_bucket", "q_known")

    def rejected(self, docs: DataFrame) -> DataFrame | None:
        """The texts that the model rejects, as two hashes of the text; None where it rejects nothing."""
        if self.threshold is None and not self.toxic:
            return None
        keyed = with_units(docs.select("text")).select(*text_key("x", "y"), "q_units")  # hashed before the texts' n-grams are rows
        found = gram_rows(keyed, "q_x", "q_y")
        found = found.withColumn("q_toxic", F.col("q_gram").isin(self.toxic) if self.toxic else F.lit(False))
        is_toxic = F.max("q_toxic")
        if self.threshold is None:
            return found.groupBy("q_x", "q_y").agg(is_toxic.alias("out")).filter("out").select("q_x", "q_y")
        # a text that stands in several rows is summed as often as it is counted, which leaves its mean as it is
        low = F.round(mean_weight(), 6) < self.threshold
        return self.weighed(found).groupBy("q_x", "q_y").agg((low | is_toxic).alias("out")).filter("out").select("q_x", "q_y")


def text_key(*names: str) -> list[Column]:
    """Two hashes of the text, together 96 bits."""
    return [h(text_or_empty("text")).alias(f"q_{n}") for h, n in zip((F.xxhash64, F.hash), names, strict=True)]


def mean_weight() -> Column:
    return F.sum("q_weight") / F.count("*") / SCALE


def bucket_count(docs: DataFrame) -> int:
    """A power of two that follows the length of all texts."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    return max(BUCKETS, 1 << max(0, math.ceil(chars / CHARS_A_BUCKET) - 1).bit_length())


def toxic_odds(sample: DataFrame) -> DataFrame | None:
    """q_gram, q_odds of the n-grams that are more frequent in toxic documents of the counted sample; sample: q_toxic, q_units."""
    kinds = {r.q_toxic: r["count"] for r in sample.groupBy("q_toxic").count().collect()}
    toxic, others = kinds.get(True, 0), kinds.get(False, 0)
    if not toxic or not others:
        return None
    held = sample.select("q_toxic", F.explode(F.array_distinct(grams(F.col("q_units")))).alias("q_gram"))
    counted = held.groupBy("q_gram").agg(F.count_if("q_toxic").alias("t"), F.count_if(~F.col("q_toxic")).alias("o"))
    odds = F.log((F.col("t") + SMOOTHING) / (toxic + 2 * SMOOTHING)) - F.log((F.col("o") + SMOOTHING) / (others + 2 * SMOOTHING))
    return materialize(counted.filter(F.col("t") >= MIN_TOXIC).select("q_gram", odds.alias("q_odds")).filter("q_odds > 0"), "quality-toxic")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, in_row: int = IN_ROW_BUCKETS) -> Model:
    """Count all documents, the trusted and the toxic ones, then set the thresholds on the labelled sample."""
    # the sample has a size bound, so sending it to all tasks is safe at any scale
    marks = F.broadcast(materialize(labelled_sample(labels, sample), "quality-labels"))
    texts = docs.select("doc_id", "text")
    buckets = bucket_count(texts)
    marked = with_units(texts.join(marks, F.col("doc_id") == F.col("q_id"), "left"))
    counted = materialize(
        gram_rows(marked, (F.col("q_good") & F.col("q_counted")).alias("trusted"))
        .groupBy(F.pmod("q_gram", F.lit(buckets)).alias("bucket"))
        .agg(F.count("*").alias("raw"), F.count_if("trusted").alias("trusted")),
        "quality-counts",
    )
    raw, trusted = counted.agg(F.sum("raw"), F.sum("trusted")).first()
    n_raw, n_trusted = (raw or 0) + SMOOTHING * buckets, (trusted or 0) + SMOOTHING * buckets
    weight = F.log((F.col("trusted") + SMOOTHING) / n_trusted) - F.log((F.col("raw") + SMOOTHING) / n_raw)
    weights = counted.select(F.col("bucket").cast("int").alias("bucket"), F.round(weight * SCALE).cast("long").alias("weight"))
    model = Model(weights, None, buckets, round(math.log(n_raw / n_trusted) * SCALE), in_row=in_row)
    some = texts.join(marks, F.col("doc_id") == F.col("q_id")).drop("doc_id")
    odds = toxic_odds(with_units(some.filter("q_counted")).drop("text"))
    unseen = with_units(some.filter("not q_counted or not q_good and not q_toxic")).select("q_id", "q_good", "q_toxic", *text_key("x", "y"), "q_units")
    found = gram_rows(unseen, "q_id", "q_good", "q_toxic", "q_x", "q_y")
    # the table is as large as the sample's n-grams at most
    found = found.join(F.broadcast(odds), "q_gram", "left") if odds is not None else found.withColumn("q_odds", F.lit(0.0))
    scored = model.weighed(found).groupBy("q_id", "q_x", "q_y", "q_good", "q_toxic").agg(
        F.floor(mean_weight() / STEP).alias("step"), F.floor(-F.coalesce(F.max("q_odds"), F.lit(0.0)) / STEP).alias("worst")
    )
    rows = scored.select("q_good", "q_toxic", "step", "worst").collect()  # at most the sample's rows
    least = best_step(histogram((r.worst, r.q_good) for r in rows if r.q_good or r.q_toxic))
    if least is not None:
        worst = round(least / STEP)
        model.toxic = [r.q_gram for r in odds.filter(F.floor(-F.col("q_odds") / STEP) < worst).select("q_gram").collect()]  # of the sample's n-grams
        rows = [r for r in rows if r.worst >= worst]
    if trusted:
        model.threshold = best_step(histogram((r.step, r.q_good) for r in rows))
    return model


def histogram(rows: Iterable[tuple[int, bool]]) -> list[tuple[int, int, int]]:
    """(step, good, bad) in order of the steps, from a (step, is good) of each row."""
    steps: dict[int, list[int]] = {}
    for step, good in rows:
        steps.setdefault(step, [0, 0])[not good] += 1
    return [(step, *steps[step]) for step in sorted(steps)]


def best_step(steps: list[tuple[int, int, int]]) -> float | None:
    """The lower edge of the first step to keep, by the weighted shares of good lost and bad kept; the least of equals."""
    good, bad = sum(s[1] for s in steps), sum(s[2] for s in steps)
    if not good or not bad:
        return None
    lost, kept, least, at = 0.0, 1.0, 1.0, None
    for step, g, b in steps:
        if CLEAN_WEIGHT * lost + kept < least - 1e-12:
            least, at = CLEAN_WEIGHT * lost + kept, step * STEP
        lost, kept = lost + g / good, kept - b / bad
    return at


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with the base measures, base_failed and kept, as columns q_*."""
    text = text_or_empty("text")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^ \t-\r]"))
    codes = F.col("q_codes")
    measured = docs.withColumn("q_codes", F.transform(words_of(text), lambda w: F.xxhash64(w))).withColumns(
        {
            "q_n_words": F.size(codes).cast("long"),
            "q_word_chars": F.length(F.regexp_replace(text, SPACES, "")).cast("long"),
            "q_n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
            "q_n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "q_n_repeat_words": repeated_words(codes),
        }
    )
    failed = (F.col("q_n_words") < MIN_WORDS) | (100 * F.col("q_n_repeat_words") > MAX_REPEATED_PERCENT * F.col("q_n_words"))
    judged = measured.withColumn("q_base_failed", failed).drop("q_codes")
    rejected = model.rejected(docs)
    if rejected is None:
        return judged.withColumn("q_kept", ~F.col("q_base_failed"))
    # stored, so that few rejected texts are sent to the documents rather than the documents dealt out
    marks = materialize(rejected, "quality-rejected").select(F.col("q_x").alias("q_rx"), F.col("q_y").alias("q_ry"), F.lit(True).alias("q_out"))
    keyed = judged.withColumns(dict(zip(("q_x", "q_y"), text_key("x", "y"), strict=True)))
    joined = keyed.join(marks, (F.col("q_x") == F.col("q_rx")) & (F.col("q_y") == F.col("q_ry")), "left")
    return joined.withColumn("q_kept", ~F.col("q_base_failed") & F.col("q_out").isNull()).drop("q_x", "q_y", "q_rx", "q_ry", "q_out")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns."""
    return judge(docs, fit(docs, labels)).filter("q_kept").select(*docs.columns)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    session(spark)
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    judged = judge(docs, fit(docs, load(spark, sf_dir, "labels"))).drop("text")
    return judged.select("doc_id", *[F.col(c).alias(c[2:]) for c in judged.columns if c.startswith("q_")])
