"""Removal of byte strings that occur elsewhere in the corpus, with suffix arrays over candidates.

Every byte covered by a ``LENGTH``-byte string that also starts elsewhere goes; strings are judged on the input.

1. Every window of LENGTH bytes names the place in it whose GRAM-byte hash is least (the last of equals). Equal windows name the same
   place in them, so they can only be found among windows whose named grams are equal. A stretch of neighbouring windows that name one place
   is a row: gram hash, digest of the stretch's bytes, text, start, number of windows.
2. Rows with one gram hash and digest are whole equal stretches: all their windows repeat. This is settled by sums that Spark
   makes before the shuffle, whatever the size of a group.
3. Gram hashes with several different stretches need the text: one stretch for each digest is cut from its document, stretches are dealt by
   their gram hash into shards of bounded size, and each shard is a suffix array. From its Burrows-Wheeler transform the
   intervals of common prefixes are extended to the left, breadth first, so that the prefix lengths come out by increasing value;
   the search ends at LENGTH, and neighbours without a value by then share LENGTH bytes or more.
4. A gram hash with over ``HOT`` different stretches would be too much for one shard. Its windows are hashed instead, equal ones within a
   task settled there, and one of each exchanged by hash, in packed arrays.

Hashes that decide equality have 128 bits together. Texts are told apart by a 64-bit hash. Equal texts are one text with a count: with
two rows or more all of it goes if it has LENGTH bytes. A null text is empty; texts under LENGTH bytes stay whole. Rows with one doc_id
are separate texts. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.shared import load, materialize, packed, session, text_or_empty

LENGTH, GRAM = 400, 64
HOT = 1000
SHARD_STRETCHES = 2500
BUCKET_WINDOWS = 200_000

_random = np.random.default_rng(5)
_VALUE = _random.integers(0, 1 << 64, (2, 256), dtype=np.uint64)
_BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_PLACE = np.uint64((1 << 32) - 1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Powers:
    """Powers of a base and of its inverse modulo 2**64, as far as asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << n.bit_length()
            self.up, self.down = (np.cumprod(np.append(np.uint64(1), np.full(size - 1, b, dtype=np.uint64)), dtype=np.uint64) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


_powers = tuple(Powers(b) for b in _BASE)


class Hashes:
    """Hashes of any substring of a text, from sums of its bytes' values."""

    def __init__(self, data: np.ndarray, which: int = 0):
        up, self.down = _powers[which].upto(len(data) + 1)
        self.sums = np.append(np.uint64(0), np.cumsum(_VALUE[which][data] * up[:-1], dtype=np.uint64))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def all(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return (self.sums[size:] - self.sums[:n]) * self.down[:n]


def least_in(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, from running minima of blocks to both sides."""
    n = len(values)
    rows = np.append(values, np.full(-n % width, np.iinfo(np.uint64).max, dtype=np.uint64)).reshape(-1, width)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def stretches(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """gram hash, digest, start and number of windows of the text's stretches."""
    width = LENGTH - GRAM + 1
    hashes = Hashes(data)
    grams = mixed(hashes.all(GRAM))
    ranked = (grams & ~_PLACE) | (_PLACE - np.arange(len(grams), dtype=np.uint64))
    place = (_PLACE - (least_in(ranked, width) & _PLACE)).astype(np.int64)
    start = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    number = np.append(start[1:], len(place)) - start
    at = place[start]
    digest = mixed(hashes.of(start, start + number - 1 + LENGTH)) + (at - start).astype(np.uint64)
    other = Hashes(data, 1).of(start, start + number - 1 + LENGTH)
    return grams[at].view(np.int64), mixed(digest + mixed(other + number.astype(np.uint64))).view(np.int64), start, number


_STRETCH = pa.schema([("k", pa.int64()), ("h", pa.int64()), ("c", pa.int64()), ("a", pa.int32()), ("w", pa.int32())])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = []
        for k, text in zip(batch.column("k").to_pylist(), batch.column("text").to_pylist(), strict=True):
            data = np.frombuffer(text.encode(), dtype=np.uint8)
            if len(data) >= LENGTH:
                found = stretches(data)
                parts.append((np.full(len(found[0]), k, dtype=np.int64), *found))
        if parts:
            columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c).cast(f.type) for c, f in zip(columns, _STRETCH, strict=True)], schema=_STRETCH)


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and its inverse by doubling; the text ends with a symbol that is nowhere else."""
    n = len(text)
    wide, depth = int(text.max()).bit_length() + 1, 1
    key = text.astype(np.int64)
    while depth * wide * 2 < 64:  # the first symbols fit into one number
        after = np.zeros(n, dtype=np.int64)
        after[: max(0, n - depth)] = key[depth:]
        key = (key << (wide * depth)) | after
        depth *= 2
    while True:
        order = np.argsort(key)
        ordered = key[order]
        new = np.append(0, np.cumsum(ordered[1:] != ordered[:-1]))
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order, rank
        key = rank * (n + 1)
        key[: max(0, n - depth)] += rank[depth:] + 1
        depth *= 2


def extended(text: np.ndarray, order: np.ndarray, rank: np.ndarray, least: int) -> np.ndarray:
    """Whether suffix i and the one before it in order share ``least`` symbols.

    ``before`` is the transform. An interval of suffixes with a common prefix of length l is extended by each symbol that stands
    before it; the suffix behind an extended interval gets the value l if it has none yet, and only then is the interval
    followed. All intervals of a length are worked on together.
    """
    n = len(text)
    before, back = text[order - 1], rank[order - 1]
    run = np.append(0, np.cumsum(before[1:] != before[:-1]))
    valued = np.zeros(n + 1, dtype=bool)
    valued[n] = valued[0] = True
    low, high, symbols = np.array([0]), np.array([n - 1]), int(text.max()) + 1
    for _ in range(least):
        if not len(low):
            break
        one = run[low] == run[high]
        lows, highs = [back[low[one]]], [back[high[one]]]
        a, b = low[~one], high[~one]
        if len(a):
            size = b - a + 1
            which = np.repeat(np.arange(len(a)), size)
            at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(a, size)
            key = np.sort((which * symbols + before[at]) * n + at)
            edge = np.flatnonzero(np.append(True, np.diff(key // n) != 0))
            lows.append(back[key[edge] % n])
            highs.append(back[key[np.append(edge[1:], len(key)) - 1] % n])
        low, high = np.concatenate(lows), np.concatenate(highs)
        new = ~valued[high + 1]
        low, high = low[new], high[new]
        valued[high + 1] = True
    return ~valued[:n]


def shard_repeats(ks: list[int], starts: list[int], parts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """(k, starts of windows that occur elsewhere too) from the stretches of a shard."""
    m = len(parts)
    pieces, base = [], []
    at = 0
    for i, part in enumerate(parts):
        base.append(at)
        pieces += [np.frombuffer(part, dtype=np.uint8).astype(np.int64) + m, np.array([i])]
        at += len(part) + 1
    text = np.concatenate(pieces)
    order, rank = suffix_array(text)
    same = extended(text, order, rank, LENGTH)
    if not same.any():
        return
    base_of = np.array(base)
    picked = np.flatnonzero(same | np.append(same[1:], False))
    part = np.searchsorted(base_of, order[picked], side="right") - 1
    begin = np.array(starts)[part] + order[picked] - base_of[part]
    names = np.unique(np.array(ks, dtype=np.int64), return_inverse=True)
    place = names[1][part].astype(np.int64) << 32 | begin
    edge = np.flatnonzero(~same[picked])  # a class of equal windows begins
    least, most = np.minimum.reduceat(place, edge), np.maximum.reduceat(place, edge)
    twice = np.repeat(least != most, np.diff(np.append(edge, len(picked))))  # stretches of a text overlap: the same place isn't another
    places = np.unique(place[twice])
    for name in np.unique(places >> 32):
        yield int(names[0][name]), places[places >> 32 == name] & ((1 << 32) - 1)


def ranges(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and number of each run of sorted distinct numbers."""
    edge = np.flatnonzero(np.append(True, np.diff(starts) != 1))
    return starts[edge], np.diff(np.append(edge, len(starts)))


_WINDOW = np.dtype([("x", "<u8"), ("y", "<u8"), ("k", "<i8"), ("at", "<i8")])
_CUT = pa.schema([("deal", pa.int64()), ("k", pa.int64()), ("a", pa.int32()), ("w", pa.int32()), ("data", pa.binary())])
_RANGE = pa.schema([("k", pa.int64()), ("a", pa.int32()), ("w", pa.int32())])


def settled(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of window records: those that have an equal at another place, and the first of each class."""
    found = found[np.lexsort((found["at"], found["k"], found["y"], found["x"]))]
    new = np.append(True, (found["x"][1:] != found["x"][:-1]) | (found["y"][1:] != found["y"][:-1]))
    edge = np.flatnonzero(new)
    last = np.append(edge[1:], len(found)) - 1
    differ = (found["k"][edge] != found["k"][last]) | (found["at"][edge] != found["at"][last])
    return found[np.repeat(differ, np.diff(np.append(edge, len(found))))], found[edge]


def range_rows(found: np.ndarray) -> dict:
    """Window records as rows (k, a, w)."""
    rows: dict = {"k": [], "a": [], "w": []}
    found = np.sort(found[["k", "at"]])
    for part in np.split(found, np.flatnonzero(np.diff(found["k"])) + 1):
        if len(part):
            for a, w in zip(*ranges(np.unique(part["at"])), strict=True):
                for values, value in zip(rows.values(), (int(part["k"][0]), int(a), int(w)), strict=True):
                    values.append(value)
    return rows


def cutter(shards: int, buckets: int, most: int):
    """Documents with wanted stretches to rows: deal >= 0 a shard's stretch, deal < -1 a bucket's packed windows, -1 a settled range."""

    def hot_rows(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        done, rest = settled(np.concatenate(held))
        rows = range_rows(done)
        if rows["k"]:
            yield packed(rows | {"deal": [-1] * len(rows["k"]), "data": [None] * len(rows["k"])}, _CUT)
        bucket = (rest["x"] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            if len(part):
                yield packed({"deal": [-2 - int(bucket[part[0]])], "k": [0], "a": [0], "w": [0], "data": [rest[part].tobytes()]}, _CUT)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            rows: dict = {f.name: [] for f in _CUT}
            for row in batch.to_pylist():
                raw = row["text"].encode()
                data, hashes = np.frombuffer(raw, dtype=np.uint8), None
                for want in row["wanted"]:
                    a, w = want["a"], want["w"]
                    if want["m"] > most:
                        hashes = hashes or (Hashes(data), Hashes(data, 1))
                        at = np.arange(a, a + w)
                        windows = np.empty(w, dtype=_WINDOW)
                        windows["x"], windows["y"] = (mixed(h.of(at, at + LENGTH)) for h in hashes)
                        windows["k"], windows["at"] = row["k"], at
                        held.append(windows)
                        n += w
                    else:
                        for values, value in zip(rows.values(), (want["h"] % shards, row["k"], a, w, raw[a : a + w - 1 + LENGTH]), strict=True):
                            values.append(value)
                if n > BUCKET_WINDOWS:
                    yield from hot_rows(held)
                    held, n = [], 0
            yield packed(rows, _CUT)
        if held:
            yield from hot_rows(held)

    return cut


def settle(table: pa.Table) -> pa.Table:
    """The ranges of repeated windows of a shard or a bucket."""
    deal = table.column("deal")[0].as_py()
    if deal == -1:
        return table.select(_RANGE.names)
    if deal < -1:
        records = [np.frombuffer(d, dtype=_WINDOW) for d in table.column("data").to_pylist()]
        return pa.table(range_rows(settled(np.concatenate(records))[0]), schema=_RANGE)
    once = {(k, a): d for k, a, d in zip(*(table.column(c).to_pylist() for c in ("k", "a", "data")), strict=True)}
    rows: dict = {"k": [], "a": [], "w": []}
    for k, starts in shard_repeats([k for k, _ in once], [a for _, a in once], list(once.values())):
        for a, w in zip(*ranges(starts), strict=True):
            for values, value in zip(rows.values(), (k, int(a), int(w)), strict=True):
                values.append(value)
    return pa.table(rows, schema=_RANGE)


def repeated_ranges(texts: DataFrame, most: int = HOT) -> DataFrame:
    """(k, a, w): in text k the w windows from a on occur elsewhere; texts: doc_id, k, text."""
    found = materialize(texts.select("k", "text").mapInArrow(_rows, "k long, h long, c long, a int, w int"), "stretches")
    place = F.struct("k", "a")
    classes = found.groupBy("h", "c").agg(F.min(F.struct("k", "a", "w")).alias("first"), F.max(place).alias("last"))
    grams = classes.groupBy("h").agg(F.count("*").alias("m"), F.min("first").alias("low"), F.max("last").alias("high"))
    repeated = grams.filter((F.col("low.k") != F.col("high.k")) | (F.col("low.a") != F.col("high.a"))).select("h", "m")
    known = materialize(classes.join(repeated, "h"), "stretch-classes")
    whole = known.filter((F.col("first.k") != F.col("last.k")) | (F.col("first.a") != F.col("last.a"))).select("h", "c")
    full = found.join(whole, ["h", "c"]).select("k", "a", "w")
    open_ = known.filter("m > 1")
    cold = open_.filter(F.col("m") <= most).count()
    hot = open_.filter(F.col("m") > most).agg(F.coalesce(F.sum("first.w"), F.lit(0))).first()[0]
    shards, buckets = max(1, math.ceil(cold / SHARD_STRETCHES)), max(1, math.ceil(hot / BUCKET_WINDOWS))
    wanted = open_.groupBy(F.col("first.k").alias("k")).agg(
        F.collect_list(F.struct(F.col("first.a").alias("a"), F.col("first.w").alias("w"), "h", "m")).alias("wanted")
    )
    one = texts.groupBy("k").agg(F.min("doc_id").alias("one_id"))
    wanted = wanted.join(one, "k").withColumnRenamed("k", "w_k")
    chosen = texts.join(wanted, (texts["k"] == wanted["w_k"]) & texts["doc_id"].eqNullSafe(wanted["one_id"])).select("k", "text", "wanted")
    cut = chosen.mapInArrow(cutter(shards, buckets, most), "deal long, k long, a int, w int, data binary")
    spread = F.when(F.col("deal") == -1, F.pmod(F.xxhash64("k", "a"), F.lit(shards))).otherwise(0)
    rest = cut.groupBy("deal", spread.alias("spread")).applyInArrow(settle, "k long, a int, w int")
    return full.unionByName(rest)


def remove_repeats(docs: DataFrame, keep_bytes: bool = False, most: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row, and the bytes that stay where asked for."""
    text = text_or_empty("text")
    texts = docs.select("doc_id", F.xxhash64(text).alias("k"), text.alias("text"))
    marks = repeated_ranges(texts, most).groupBy("k").agg(F.collect_list(F.struct("a", "w")).alias("ranges"))
    copies = texts.groupBy("k").agg(F.count("*").alias("n")).filter("n > 1").select("k", F.lit(True).alias("copied"))
    # a text of which there are copies goes as a whole, so its ranges aren't sent to each of them
    marks = marks.join(copies, "k", "full").withColumn("ranges", F.when(F.col("copied").isNull(), F.col("ranges")))
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    out = pa.schema(fields + [("kept", pa.binary())] * keep_bytes)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict = {f.name: [] for f in out}
            for row in batch.to_pylist():
                data = np.frombuffer(row["text"].encode(), dtype=np.uint8)
                change = np.zeros(len(data) + 1, dtype=np.int32)
                if row["copied"] and len(data) >= LENGTH:
                    change[0] = 1
                for r in row["ranges"] or ():
                    change[r["a"]] += 1
                    change[r["a"] + r["w"] - 1 + LENGTH] -= 1
                gone = np.cumsum(change[:-1]) > 0
                kept = data[~gone].tobytes()
                values = (row["doc_id"], len(data), int(gone.sum()), int((gone & ~np.append(False, gone[:-1])[: len(gone)]).sum()), hashlib.sha256(kept).hexdigest())
                for column, value in zip(rows.values(), (*values, kept), strict=False):
                    column.append(value)
            yield packed(rows, out)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes
    return texts.join(marks, "k", "left").select("doc_id", "text", "ranges", "copied").mapInArrow(remove, schema)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes removed from every document, and the digest of the rest."""
    session(spark)
    return remove_repeats(load(spark, sf_dir, "documents"))
