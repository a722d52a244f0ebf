"""Hard-negative mining by threshold joins over an inverted index with norm bounds, after L2AP (Anastasiu, Karypis, ICDE 2014).

Anchors and vectors meet in blocks of bounded size: each block of vectors is indexed and asked by each block of anchors, so that no task sees more than
``ROWS`` vectors and ``ANCHORS`` anchors whatever the input, and a hot label or a vector with many copies is spread like any other. Work grows with anchors times
vectors, as an exact search of a stated query set does; what leaves a block is at most k rows for each window.

The index of a block has the dimensions in order of their spread, in segments of ``SEGMENT``. A vector's tail is left out from the segment on where
the norm of the tail times the norm of the same part of any asking anchor is under the anchor's threshold. Partial scores are accumulated over the indexed
segments, for all anchors at once; pairs whose partial score and the norms of what remains can't reach the threshold are dropped, and the
others go on segment by segment with the same test. A window (the k best partners of an anchor, or the k best under an upper score) that isn't
filled at its threshold is asked again at a lower one, down to its floor. Scores are whole numbers, so the result is exact; bounds carry a slack for rounding.

Defined results: a row with a null id, label or vector, or with a null or non-finite component, takes no part, nor one whose squared length doesn't fit a long, so that
every score does. Vectors of different lengths count as filled up with zeros. Of rows that share an id the one with the least (label, vector) counts. Ties go to the
smaller id. An anchor without a partner of its label, and a positive without a negative in its window, have no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.shared import load, materialize, session

ROWS = 4096  # vectors of a block
ANCHORS = 4096  # anchors of a block
BATCH = 64  # anchors that ask at once
SEGMENT = 8  # dimensions
START, LOWER = 0.5, 0.6  # of the largest possible score; factor from one threshold to the next
NEAR, FALL = 0.9, 0.8  # the same for windows under an upper score
SLACK = 1e-9
EXACT = float(1 << 52)  # whole numbers that doubles add without rounding


def usable(rows: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, v): the rows that take part, with whole-number components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    wide = F.transform("embedding", lambda x: F.lit(float(scale)) * x.cast("double"))
    length = F.aggregate(wide, F.lit(0.0), lambda s, x: s + x * x)
    taken = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", finite))
    return taken.filter(length < float(1 << 62)).select("vec_id", "label", F.transform(wide, lambda x: F.floor(x).cast("long")).alias("v"))


def noisy_labels(rows: DataFrame, every: int = 7, classes: int = 10) -> DataFrame:
    """The label of each ``every``-th id moved to the next class."""
    moved = F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % classes).otherwise(F.col("label"))
    return rows.withColumn("label", moved)


def matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def tails(v: np.ndarray, starts: list[int]) -> np.ndarray:
    """Norms of the parts from each start on; the last one is zero."""
    squares = np.cumsum((v.astype(np.float64) ** 2)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.column_stack([squares[:, s] if s < v.shape[1] else np.zeros(len(v)) for s in starts]))


class Index:
    """A block of vectors, asked by batches of anchors with a threshold each."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray, q: np.ndarray):
        exact = np.float64 if (np.abs(v).max(initial=0) * 1.0 * np.abs(q).max(initial=0) * max(1, v.shape[1])) < EXACT else np.int64
        self.order = np.argsort(-v.astype(np.float64).var(axis=0), kind="stable") if len(v) else np.arange(v.shape[1])
        self.ids, self.labels = ids, labels
        self.v = np.ascontiguousarray(v[:, self.order]).astype(exact)
        self.starts = [*range(0, v.shape[1], SEGMENT), v.shape[1]]
        self.tails = tails(self.v, self.starts)

    def query(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        q = np.ascontiguousarray(q[:, self.order]).astype(self.v.dtype)
        return q, tails(q, self.starts)

    def search(self, q: np.ndarray, qtails: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of all pairs whose score is at least the anchor's threshold."""
        segments = len(self.starts) - 1
        with np.errstate(divide="ignore", invalid="ignore"):
            need = np.where(least[:, None] > 0, least[:, None] / qtails[:, :-1], -np.inf)  # an anchor's empty tail needs an endless one
        need = np.where(np.isnan(need), np.inf, need).min(axis=0, initial=np.inf) * (1 - SLACK)
        indexed = (self.tails[:, :-1] >= need).sum(axis=1)  # segments in the index; tails fall and needs rise
        rows = np.argsort(-indexed, kind="stable")
        depth = indexed[rows]
        held = int((depth > 0).sum())
        rows, depth = rows[:held], depth[:held]
        v = self.v[rows]
        partial = np.zeros((len(q), held), dtype=v.dtype)
        for s in range(segments):
            n = int((depth > s).sum())
            if not n:
                break
            part = slice(self.starts[s], self.starts[s + 1])
            partial[:, :n] += q[:, part] @ v[:n, part].T
        rest = self.tails[rows, depth]
        reach = partial + qtails[:, depth] * rest
        i, j = np.nonzero(reach >= (least - SLACK * np.abs(least))[:, None])
        score, at = partial[i, j], depth[j]
        for s in range(int(at.min(initial=segments)), segments):
            part, on = slice(self.starts[s], self.starts[s + 1]), at <= s
            score[on] += np.einsum("nd,nd->n", q[i[on], part], v[j[on], part])
            bound = score + np.where(at <= s, qtails[i, s + 1] * self.tails[rows[j], s + 1], qtails[i, at] * self.tails[rows[j], at])
            good = bound >= least[i] - SLACK * np.abs(least[i])
            i, j, score, at = i[good], j[good], score[good], at[good]
        good = score >= least[i]
        return i[good], rows[j[good]], score[good].astype(np.int64)


def ranked(index: Index, found: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs by anchor, then from the best score, ties by id."""
    i, j, score = found
    by = np.lexsort((index.ids[j], -score, i))
    return i[by], j[by], score[by]


def best_partners(index: Index, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, k: int) -> list[tuple]:
    """(anchor, partner, score): the k best other rows of the anchor's label in this block."""
    out = []
    q, qtails = index.query(q)
    ceiling = qtails[:, 0] * index.tails[:, 0].max(initial=0)
    share = np.full(len(q), START)
    open_ = np.arange(len(q))
    while len(open_):
        least = np.where(share[open_] > 0.01, share[open_] * ceiling[open_], -np.inf)
        i, j, score = ranked(index, index.search(q[open_], qtails[open_], least))
        good = (index.labels[j] == labels[open_[i]]) & (index.ids[j] != ids[open_[i]])
        i, j, score = i[good], j[good], score[good]
        edges = np.searchsorted(i, np.arange(len(open_) + 1))
        still = []
        for a, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if hi - lo >= k or least[a] == -np.inf:
                out += [(ids[open_[a]], index.ids[x], s) for x, s in zip(j[lo : min(hi, lo + k)], score[lo : min(hi, lo + k)], strict=True)]
            else:
                still.append(open_[a])
        open_ = np.array(still, dtype=np.int64)
        share[open_] *= LOWER
    return out


def best_in_windows(index: Index, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, windows: list, k: int, low: int, high: int) -> list[tuple]:
    """(anchor, positive, row, positive score, score): the k best rows of other labels in each positive's window of scores.

    windows: for each anchor its (positive, score); a window holds the scores s with low * score <= 100 * s <= high * score.
    """
    out = []
    q, qtails = index.query(q)
    waiting = {a: [(p, int(s), -(-low * int(s) // 100), high * int(s) // 100) for p, s in w if s >= 0] for a, w in enumerate(windows)}
    waiting = {a: w for a, w in waiting.items() if w}
    share = NEAR
    while waiting:
        open_ = np.array(sorted(waiting), dtype=np.int64)
        at = {a: [max(float(lo), share * hi) for _, _, lo, hi in waiting[a]] for a in waiting}
        least = np.array([min(at[a]) for a in open_.tolist()])
        i, j, score = ranked(index, index.search(q[open_], qtails[open_], least))
        good = index.labels[j] != labels[open_[i]]
        i, j, score = i[good], j[good], score[good]
        edges = np.searchsorted(i, np.arange(len(open_) + 1))
        for n, a in enumerate(open_.tolist()):
            found, rows = score[edges[n] : edges[n + 1]], j[edges[n] : edges[n + 1]]
            still = []
            for (p, s, lo, hi), t in zip(waiting[a], at[a], strict=True):
                first = np.searchsorted(-found, -hi)
                last = np.searchsorted(-found, -max(t, least[n]), side="right")
                if last - first >= k or t <= lo:
                    out += [(ids[a], p, index.ids[r], s, x) for r, x in zip(rows[first : min(last, first + k)], found[first : min(last, first + k)], strict=True)]
                else:
                    still.append((p, s, lo, hi))
            waiting[a] = still
        waiting = {a: w for a, w in waiting.items() if w}
        share *= FALL
    return out


def once(block: pd.DataFrame) -> pd.DataFrame:
    """Of rows that share an id the one with the least (label, vector)."""
    if block["vec_id"].is_unique:
        return block
    keyed = sorted(range(len(block)), key=lambda i: (block["vec_id"].iat[i], block["label"].iat[i], list(block["v"].iat[i])))
    return block.iloc[keyed].drop_duplicates("vec_id")


def ask(anchors: pd.DataFrame, rows: pd.DataFrame, use) -> list[tuple]:
    """use(index, ids, labels, vectors, batch) for the anchors in batches over the rows of a block."""
    if not len(anchors) or not len(rows):
        return []
    anchors, rows = once(anchors), once(rows)
    width = max(max(map(len, anchors["v"])), max(map(len, rows["v"])), 1)
    q = matrix(anchors["v"], width)
    index = Index(rows["vec_id"].to_numpy(), rows["label"].to_numpy(), matrix(rows["v"], width), q)
    out = []
    for lo in range(0, len(anchors), BATCH):
        batch = anchors.iloc[lo : lo + BATCH]
        out += use(index, batch["vec_id"].to_numpy(), batch["label"].to_numpy(), q[lo : lo + BATCH], batch)
    return out


def frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names).astype("int64")


def in_blocks(anchors: DataFrame, rows: DataFrame, row_blocks: int, anchor_blocks: int, use, names: list[str]) -> DataFrame:
    """Each block of anchors over each block of rows."""
    place = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumns({"qb": place(anchor_blocks), "rb": each(row_blocks)})
    right = rows.withColumns({"rb": place(row_blocks), "qb": each(anchor_blocks)})
    return left.groupBy("rb", "qb").cogroup(right.groupBy("rb", "qb")).applyInPandas(lambda a, r: frame(ask(a, r, use), names), ", ".join(f"{n} long" for n in names))


def first_by(df: DataFrame, keys: list[str], order: list, k: int) -> DataFrame:
    """The first k rows of each key, numbered; Spark cuts each task to k rows a key before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)


def mine(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, row_block: int = ROWS, anchor_block: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of usable rows (vec_id, label, v).

    Anchors are the rows whose id is divisible by ``every``.
    """
    rows = materialize(rows, "negatives-rows")
    anchors = rows.filter(F.col("vec_id") % every == 0).select(*[F.col(c).alias(c) for c in rows.columns])  # columns of their own
    n, m = rows.count(), anchors.count()
    blocks = max(1, -(-n // row_block)), max(1, -(-m // anchor_block))

    def partners(index, ids, labels, q, batch):
        return best_partners(index, ids, labels, q, positives)

    found = in_blocks(anchors, rows, *blocks, partners, ["anchor_id", "positive_id", "positive_score"])
    chosen = materialize(first_by(found, ["anchor_id"], [F.desc("positive_score"), F.asc("positive_id")], positives), "negatives-positives")
    windows = chosen.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list("positive_id").alias("p"), F.collect_list("positive_score").alias("s"))
    asking = anchors.join(windows, "vec_id")

    def windowed(index, ids, labels, q, batch):
        given = [list(zip(p, s, strict=True)) for p, s in zip(batch["p"], batch["s"], strict=True)]
        return best_in_windows(index, ids, labels, q, given, negatives, low, high)

    names = ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"]
    hard = in_blocks(asking, rows, *blocks, windowed, names)
    best = first_by(hard, ["anchor_id", "positive_id"], [F.desc("negative_score"), F.asc("negative_id")], negatives)
    return best.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive, over all vectors."""
    session(spark)
    return mine(noisy_labels(usable(load(spark, sf_dir, "embeddings"))))


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other)::INTEGER AS rank,
       s.other AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other) <= 10
"""
