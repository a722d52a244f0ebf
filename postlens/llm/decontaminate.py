"""Benchmark decontamination by pigeonhole pieces and Myers' bit-parallel distance.

Texts and test items are lower-cased and their white space is made one blank. An item of m characters may be met with
k = ``ERRORS`` of m edits, so one of k + 1 pieces of it stands unchanged in a text that holds it. An Aho-Corasick automaton finds the pieces
in each text; every hit names a place at which the item would lie, places of an item that are close are one window, and
the window is decided by the item's distance to the nearest part of it. The items go through in blocks of ``BLOCK_ITEMS`` rows,
which bounds what a task holds; each block meets all documents.

Null and empty texts and items match nothing; nor do items of under ``MIN_CHARS`` characters, which could stand in any text. An item without an id is looked for by ``keep_clean`` only. Repeated items
or documents give one row. Other columns of the documents are kept by ``keep_clean``.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.shared import load, packed, session, text_or_empty

ERRORS = 0.08
MIN_CHARS = 20
BLOCK_ITEMS = 20_000


def plain(text: str) -> str:
    return " ".join(text.lower().split())


class Item:
    """A test item: its pieces with their places, and the bit rows of its characters."""

    def __init__(self, item_id: int, text: str, errors: float):
        self.item_id, self.m, self.budget = item_id, len(text), int(errors * len(text))
        cuts = [self.m * i // (self.budget + 1) for i in range(self.budget + 2)]
        self.pieces = [(text[a:b], a) for a, b in zip(cuts, cuts[1:], strict=False)]
        self.rows: dict[str, int] = defaultdict(int)
        for i, c in enumerate(text):
            self.rows[c] |= 1 << i

    def distance(self, window: str) -> int:
        """Least edit distance of the whole item to any part of the window, or over the budget."""
        full, top, rows = (1 << self.m) - 1, 1 << (self.m - 1), self.rows
        up, down, score = full, 0, self.m
        best = score
        for c in window:
            eq = rows.get(c, 0)
            x = eq | down
            diagonal = ((((x & up) + up) ^ up) | x) & full
            plus, minus = down | (full & ~(diagonal | up)), up & diagonal
            if plus & top:
                score += 1
            elif minus & top:
                score -= 1
            plus, minus = (plus << 1) & full, (minus << 1) & full  # a match may begin anywhere: nothing comes in at the top
            up, down = minus | (full & ~(diagonal | plus)), plus & diagonal
            if score < best:
                best = score
        return best


class Matcher:
    """All items of a block."""

    def __init__(self, items: list[tuple[int, str]], errors: float, min_chars: int):
        import ahocorasick

        texts = [(i, plain(t)) for i, t in items]
        self.items = [Item(i, t, errors) for i, t in texts if len(t) >= min_chars]
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for n, item in enumerate(self.items):
            for piece, at in item.pieces:
                places[piece].append((n, at))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        if places:
            self.automaton.make_automaton()

    def find(self, text: str) -> dict[int, int]:
        """item_id to distance of the items that the text holds."""
        if not self.items or not text:
            return {}
        text = plain(text)
        starts: dict[int, set[int]] = defaultdict(set)
        for end, (size, places) in self.automaton.iter(text):
            for n, at in places:
                starts[n].add(end + 1 - size - at)
        found: dict[int, int] = {}
        for n, where in starts.items():
            item, best = self.items[n], None
            for low, high in windows(sorted(where), item.budget):
                window = text[max(0, low - item.budget) : high + item.m + item.budget]
                if len(window) >= item.m - item.budget and (d := item.distance(window)) <= item.budget:
                    best = d if best is None else min(best, d)
            if best is not None:
                found[item.item_id] = min(best, found.get(item.item_id, best))
        return found


def windows(starts: list[int], budget: int) -> Iterator[tuple[int, int]]:
    """Ranges of starts that lie within twice the budget of their neighbour."""
    low = high = starts[0]
    for s in starts[1:]:
        if s - high > 2 * budget:
            yield low, high
            low = s
        high = s
    yield low, high


def item_blocks(benchmark: DataFrame, size: int = BLOCK_ITEMS) -> Iterator[list[tuple[int | None, str]]]:
    """The items, at most ``size`` rows or so at a time on the driver."""
    items = benchmark.filter("text is not null").select("item_id", "text").distinct()
    blocks = max(1, math.ceil(items.count() / size))
    for b in range(blocks):
        yield [(r.item_id, r.text) for r in items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()]


_matchers: dict[int, Matcher] = {}


def matcher(items: list[tuple[int, str]], errors: float, min_chars: int) -> Matcher:
    """The worker's matcher of a block."""
    key = hash((tuple(items), errors, min_chars))
    if key not in _matchers:
        _matchers.clear()
        _matchers[key] = Matcher(items, errors, min_chars)
    return _matchers[key]


def leaks(docs: DataFrame, benchmark: DataFrame, errors: float = ERRORS, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, item_id, distance of every item that a document holds."""
    out = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int64())])
    texts, found = docs.select("doc_id", text_or_empty("text").alias("text")), None
    for block in item_blocks(benchmark.filter("item_id is not null")):

        def match(batches: Iterator[pa.RecordBatch], block: list = block) -> Iterator[pa.RecordBatch]:
            known = matcher(block, errors, min_chars)
            for batch in batches:
                rows: dict = {f.name: [] for f in out}
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    for item_id, distance in known.find(text).items():
                        for values, value in zip(rows.values(), (doc_id, item_id, distance), strict=True):
                            values.append(value)
                yield packed(rows, out)

        hits = texts.mapInArrow(match, "doc_id long, item_id long, distance long")
        found = hits if found is None else found.unionByName(hits)
    return found.groupBy("doc_id", "item_id").agg(F.min("distance").alias("distance"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, errors: float = ERRORS, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents that hold no item, in their own columns; decided row by row, without a shuffle."""
    for block in item_blocks(benchmark):

        def clean(batches: Iterator[pa.RecordBatch], block: list = block) -> Iterator[pa.RecordBatch]:
            known = matcher(block, errors, min_chars)
            for batch in batches:
                yield batch.filter(pa.array([not known.find(t or "") for t in batch.column("text").to_pylist()], type=pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items that they hold."""
    session(spark)
    return leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
