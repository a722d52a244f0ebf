"""Text expressions. All run in the JVM but Unicode decomposition, the count of words and plain words."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens import constants as C


@F.pandas_udf(T.StringType())
def _nfkd(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFKD", t), na_action="ignore")


def decompose(text: Column) -> Column:
    """NFKD form. Only texts with a non-ASCII letter travel to Python."""
    return F.coalesce(_nfkd(F.when(text.rlike(r"[^\x00-\x7F]"), text)), text)


def words(text: Column) -> Column:
    return F.filter(F.split(text, C.SPACE + "+"), lambda w: w != "")


def first_words(text: Column, n: int) -> Column:
    """The first ``n`` words; the rest of the text is neither split nor copied."""
    head = F.regexp_extract(text, rf"^(?:{C.SPACE}*+{C.NOT_SPACE}++){{0,{n}}}", 0)
    return F.slice(F.filter(F.split(head, C.SPACE + "+", n + 2), lambda w: w != ""), 1, n)


_SPACED = bytes(32 if chr(i).isspace() else 120 for i in range(256))


def count_words(text: str) -> int:
    """``len(text.split())``; the words of a text of one-byte characters are not made for it."""
    try:
        shape = text.encode("latin-1").translate(_SPACED)
    except UnicodeEncodeError:
        return len(text.split())
    return shape.count(b" x") + shape.startswith(b"x")


@F.arrow_udf(T.IntegerType())
def _count_words(texts: pa.Array) -> pa.Array:
    return pa.array([count_words(t) if t else 0 for t in texts.to_pylist()], pa.int32())


def word_count(text: Column) -> Column:
    """Number of words, counted in Arrow batches; an absent text has none. Python's white space is that of ``words``."""
    return F.coalesce(_count_words(F.nullif(text, F.lit(""))), F.lit(0))


# Up to these code points Unicode has given out no letter or digit since version 6, so Java and Python agree on them.
_SETTLED = r"\x00-\u085f\u2000-\u20cf"
# The same without the one capital whose lower case depends on its neighbours.
_SETTLED_CASE = r"\x00-\u03a2\u03a4-\u085f\u2000-\u20cf"


def _only(text: Column, chars: str) -> Column:
    return (F.octet_length(text) == F.length(text)) | text.rlike(rf"\A[{chars}]*\z")


def _unmarked(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\p{L}\p{N}_\t-\r\x1c-\x20\x85\p{Z}]", " ")


def settle(text: Column) -> Column:
    """A text for ``plain``: one with a character on which Java and Python may differ has its marks replaced here."""
    return F.when(_only(text, _SETTLED), text).otherwise(_unmarked(text))


def settle_case(text: Column) -> Column:
    """A text for ``plain`` of its lower case in a worker: lowered here only where Java and Python may differ."""
    return F.when(_only(text, _SETTLED_CASE), text).otherwise(_unmarked(F.lower(text)))


def _is_mark(char: str) -> bool:
    return unicodedata.category(char)[0] not in "LN" and char != "_" and not char.isspace()


_MARKS = [c for c in map(chr, [*range(0x860), *range(0x2000, 0x20D0)]) if _is_mark(c)]
_BYTES = bytes(32 if chr(i) in _MARKS else i for i in range(256))
_ANY_MARK = re.compile("[" + re.escape("".join(_MARKS)) + "]")


def plain(text: str) -> str:
    """A text of ``settle`` in a worker: blanks for all that is no letter, digit, underscore or white space."""
    try:
        return text.encode("latin-1").translate(_BYTES).decode("latin-1")
    except UnicodeEncodeError:
        return _ANY_MARK.sub(" ", text)


def sentences(text: Column) -> Column:
    """Pieces between full stops that hold more than white space."""
    return F.filter(F.split(text, r"\."), lambda s: s.rlike(C.NOT_SPACE))


def calm_capitals(text: Column) -> Column:
    """Runs of four or more capitals keep two and go on in lower case."""
    runs = F.split(text, r"(?<=[A-Z])(?![A-Z])|(?<![A-Z])(?=[A-Z])")
    calmed = F.transform(
        runs,
        lambda r: F.when(
            (F.length(r) > 3) & r.rlike("^[A-Z]"), F.concat(F.substring(r, 1, 2), F.lower(F.substring(r, 3, 1 << 30)))
        ).otherwise(r),
    )
    return F.when(text.rlike("[A-Z]{4}"), F.array_join(calmed, "")).otherwise(text)  # most texts have no such run


def clean_text(text: Column, preserve_entities: bool = True) -> Column:
    t = F.regexp_replace(F.coalesce(text, F.lit("")), "<[^>]+>", " ")
    t = decompose(t)
    t = F.regexp_replace(t, "([.!?]){3,}", "$1$1$1")
    t = calm_capitals(t)
    t = F.trim(F.regexp_replace(t, C.WIDE_SPACE, " "))
    if preserve_entities:
        t = F.regexp_replace(t, r"[^\p{L}\p{N}_ .,!?@#\-:/]", "")
    else:
        t = F.regexp_replace(t, C.URL_PATTERN, "")
        t = F.regexp_replace(t, r"[^\p{L}\p{N}_ .,!?\-]", "")
    return F.trim(t)


def content_hash(text: Column, stop_words: Sequence[str] = tuple(C.HASH_STOP_WORDS)) -> Column:
    """MD5 over the lower-cased clean words that are not stop words."""
    pieces = F.split(F.lower(clean_text(text, preserve_entities=False)), " ")  # clean text has no other white space
    kept = F.filter(pieces, lambda w: ~w.isin("", *stop_words))
    return F.md5(F.array_join(kept, " "))


def entities(text: Column) -> dict[str, Column]:
    """Entity arrays by name; a phone is given by its country prefix only."""
    t = F.coalesce(text, F.lit(""))
    return {
        "mentions": F.regexp_extract_all(t, F.lit(C.MENTION_PATTERN), F.lit(0)),
        "hashtags": F.regexp_extract_all(t, F.lit(C.HASHTAG_PATTERN), F.lit(0)),
        "urls": F.regexp_extract_all(t, F.lit(C.URL_PATTERN), F.lit(0)),
        "emails": F.regexp_extract_all(t, F.lit(C.EMAIL_PATTERN), F.lit(0)),
        "phones": F.regexp_extract_all(t, F.lit(C.PHONE_PATTERN), F.lit(1)),
    }


def text_stats(text: Column) -> dict[str, Column]:
    n_words = F.size(words(text))
    letters = F.length(F.regexp_replace(text, C.SPACE, ""))
    return {
        "word_count": n_words,
        "char_count": F.length(text),
        "sentence_count": F.size(sentences(text)),
        "avg_word_length": F.coalesce(F.try_divide(letters, n_words), F.lit(0.0)),
    }


def readability(text: Column) -> Column:
    """100 for short words in short sentences, down to 0."""
    t = F.coalesce(text, F.lit(""))
    n_words, n_sentences = F.size(words(t)), F.size(sentences(t))
    letters = F.length(F.regexp_replace(t, C.SPACE, ""))
    load = F.try_divide(n_words, n_sentences) * 0.6 + F.try_divide(letters, n_words) * 0.4
    return F.coalesce(F.greatest(F.lit(0.0), F.lit(100.0) - F.least(F.lit(100.0), load * 5)), F.lit(0.0))


def occurrences(text: Column, term: Column) -> Column:
    """Non-overlapping occurrences of a term, also inside words."""
    removed = F.length(text) - F.length(F.replace(text, term, F.lit("")))
    return (removed / F.length(term)).cast("int")


def issues(title: Column, content: Column, url: Column) -> Column:
    """What keeps a post out, as an array of messages; empty for a valid post."""
    t, c, u = (F.coalesce(x, F.lit("")) for x in (title, content, url))
    checks = [
        (t == "", "Missing title"),
        (c == "", "Missing content"),
        ((c != "") & (F.size(words(c)) < 10), "Content too short (< 10 words)"),
        ((c != "") & (F.length(c) > 10000), "Content too long (> 10000 chars)"),
        ((c != "") & (occurrences(c, F.lit(".")) < 2), "Content lacks proper sentences"),
        ((t != "") & (F.size(words(t)) < 3), "Title too short"),
        ((t != "") & (F.length(t) > 200), "Title too long"),
        ((u != "") & ~u.rlike("^https?://"), "Invalid URL format"),
    ]
    return F.array_compact(F.array(*[F.when(bad, F.lit(message)) for bad, message in checks]))


def excerpt(text: Column, length: int = 100) -> Column:
    return F.concat(F.substring(F.coalesce(text, F.lit("")), 1, length), F.lit("..."))


def strip_tags(text: Column) -> Column:
    """Tags out, the five common character references decoded."""
    t = F.regexp_replace(text, "<[^>]*>", "")
    for reference, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(reference), F.lit(char))
    return t


def site_host(url: Column) -> Column:
    """Host part of a URL, port included."""
    return F.split_part(F.split_part(url, F.lit("//"), F.lit(2)), F.lit("/"), F.lit(1))


def bare_subreddit(name: Column) -> Column:
    return F.regexp_replace(name, "^r/", "")


def join_link(site: Column, link: Column) -> Column:
    """A relative link under its site; an absolute or empty one as it is."""
    joined = F.concat(F.regexp_replace(site, "/+$", ""), F.lit("/"), F.regexp_replace(link, "^/+", ""))
    return F.when((link == "") | link.startswith("http"), link).otherwise(joined)


def title_case(text: Column) -> Column:
    """Every run of letters starts with a capital."""
    return F.array_join(F.transform(F.split(text, r"(?<=[^\p{L}])(?=\p{L})"), F.initcap), "")
