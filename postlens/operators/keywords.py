"""Keywords of single texts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens import constants as C
from postlens.functions import text as X

def _ranked(min_length: int, top_n: int, stop_words: Sequence[str], terms: Sequence[str], lower: bool = False):
    """The best keywords of lower-case texts with their hits, by hits and then by first place; terms come after words.

    With ``lower`` the texts are those of ``settle_case`` and are put in lower case first.
    """
    stopped = frozenset(stop_words)

    def counted(word: str) -> bool:
        return len(word) >= min_length and word not in stopped

    @F.arrow_udf("keywords array<string>, hits array<long>")
    def ranked(texts: pa.Array) -> pa.Array:
        names, hits, ends = [], [], [0]
        for text in texts.to_pylist():
            if text is None:
                ends.append(len(names))
                continue
            text = X.plain(text.lower() if lower else text)
            # A counter keeps the order in which words first came, and so does the sort among equal hits.
            # Words are ranked by their hits alone and looked at from the first one, until enough of them count.
            counts, added = Counter(text.split()), set()
            for term in terms:
                if n := text.count(term):
                    known = counts[term] if term in added or counted(term) else 0
                    if not known:
                        counts.pop(term, None)  # a word that doesn't count gives no place to the term
                    counts[term] = known + n
                    added.add(term)
            # Most words come once; they are in order already.
            often = sorted((w for w, n in counts.items() if n > 1), key=counts.get, reverse=True)
            ranking = chain(often, (w for w, n in counts.items() if n == 1))
            best = list(islice((w for w in ranking if w in added or counted(w)), top_n))
            names.extend(best)
            hits.extend(map(counts.get, best))
            ends.append(len(names))
        lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, t)) for v, t in ((names, pa.string()), (hits, pa.int64()))]
        return pa.StructArray.from_arrays(lists, ["keywords", "hits"])

    return ranked


def ranked_keywords(
    text: Column,
    min_length: int = 3,
    top_n: int = 20,
    stop_words: Sequence[str] = tuple(C.KEYWORD_STOP_WORDS),
    terms: Sequence[str] = tuple(C.TECH_KEYWORDS),
) -> Column:
    """Arrays of the keywords of a text and of their hits, best first; a blank text does not travel to Python."""
    return _ranked(min_length, top_n, stop_words, terms, lower=True)(X.settle_case(F.when(F.trim(text) != "", text)))


def placed_keywords(posts: DataFrame, ranked: str, keys: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Rows (keys, carry, keyword, hits, rank) of posts with a column of ``ranked_keywords``."""
    pairs = F.posexplode(F.arrays_zip(F.col(ranked)["keywords"], F.col(ranked)["hits"])).alias("_place", "_entry")
    return posts.select(*keys, *carry, pairs).select(
        *keys, *carry, F.col("_entry.keywords").alias("keyword"), F.col("_entry.hits").alias("hits"),
        (F.col("_place") + 1).alias("rank"),
    )


def extract_keywords(
    posts: DataFrame,
    text: Column,
    keys: Sequence[str] = ("ingest_seq",),
    carry: Sequence[str] = (),
    min_length: int = 3,
    top_n: int = 20,
    stop_words: Sequence[str] = tuple(C.KEYWORD_STOP_WORDS),
    terms: Sequence[str] = tuple(C.TECH_KEYWORDS),
) -> DataFrame:
    """Rows (keys, carry, keyword, hits, rank): the ``top_n`` keywords of each text.

    A post's words are counted and ranked where it lies, in Arrow batches;
    nothing is shuffled. Ties go to the earlier word, then to the order of
    ``terms``. Keywords beyond ``top_n`` are not counted in later totals. A
    post without a text does not travel to Python.
    """
    located = posts.where(F.trim(text) != "").select(*keys, *carry, text.alias("_text"))
    best = ranked_keywords(F.col("_text"), min_length, top_n, stop_words, terms)
    return placed_keywords(located.select(*keys, *carry, best.alias("_best")), "_best", keys, carry)


def post_text() -> Column:
    """Content and title as one text, as the trend operators read a post."""
    return F.concat_ws(" ", F.coalesce("content", F.lit("")), F.coalesce("title", F.lit("")))
