"""MinHash near-dedup with odd sketches, confirmed on full shingle sets.

A document's set holds its distinct two-word (or longer) shingles as 64-bit hashes; equal sets are one class. A class has ``BANDS * ROWS`` MinHash
samples, cut into bands, and an odd sketch of them: a bitmap in which every (sample, place) pair flips one bit, so that the
XOR of two sketches counts twice the samples in which they differ.

1. Classes that share a band are joined to the least of them, first within a task, then over tasks, so a band that very many share
   is one row from each task. The components of this graph hold every pair that shares a band.
2. Each class's set is sent to its candidate component once. Within it all pairs are measured by their sketches (XOR and bit count),
   most similar hubs first; a pair that could be similar and isn't connected yet is confirmed on the full sets. A large
   component is cut into blocks, and every pair of blocks is a task of bounded size.
3. The components of the confirmed links are the groups.

Two sets of similarity 0.8 share no band with a probability of 5e-7; the bound on the sketches' distance is over ten standard
deviations from what they have at 0.8. Class ids are 64 bits of a digest of the set.

A null or empty text has an empty set, is linked with nothing and is its own component. Rows with equal sets share a component, repeated ids
as well. The component id is the least id of it, null where it has no id; ``kept`` compares null with null as equal. An empty
table gives no row. Other columns of the documents are kept by ``keep_first``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.components import components
from postlens.llm.shared import LOWER, UPPER, load, materialize, packed, session, text_or_empty

BANDS, ROWS = 48, 6
SKETCH_BITS = 1024
# 288 samples at similarity 0.8 differ in 58 of them and 103 bits, with a standard deviation of about 12 bits.
FARTHEST = 230
PERCENT = 80
BLOCK = 2048
HELD = 1 << 20

_samples = BANDS * ROWS
_random = np.random.default_rng(20)
_XOR = _random.integers(0, 1 << 64, _samples, dtype=np.uint64)
_TIMES = _random.integers(0, 1 << 64, _samples, dtype=np.uint64) | np.uint64(1)
_FOLD = _random.integers(0, 1 << 64, (3, max(ROWS, 64)), dtype=np.uint64) | np.uint64(1)
_TABLE = bytes.maketrans(UPPER.encode(), LOWER.encode())
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a shorter text's words are one shingle."""
    found = [xxhash.xxh3_64_intdigest(w) for w in text.encode().translate(_TABLE).split()]
    if not found:
        return np.zeros(0, dtype=np.uint64)
    codes = np.array(found, dtype=np.uint64)
    n = min(words, len(codes))
    total = np.full(len(codes) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        total = mixed(total + codes[k : len(codes) - n + 1 + k] * _FOLD[0, k])
    return np.unique(total)


def samples(hashes: np.ndarray) -> np.ndarray:
    """MinHash samples of a set that isn't empty."""
    least = np.full(_samples, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 2048):
        np.minimum(least, ((hashes[None, at : at + 2048] ^ _XOR[:, None]) * _TIMES[:, None]).min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    keys = np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLDEN
    for k in range(ROWS):
        keys = mixed(keys + least.reshape(BANDS, ROWS)[:, k] * _FOLD[1, k])
    return keys


def odd_sketch(least: np.ndarray) -> bytes:
    bits = mixed(least + np.arange(1, _samples + 1, dtype=np.uint64) * _GOLDEN) % np.uint64(SKETCH_BITS)
    return np.packbits(np.bincount(bits.astype(np.int64), minlength=SKETCH_BITS).astype(np.uint8) & 1).tobytes()


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, text_hash, node, n_shingles, bands, sketch of every row; node is null for an empty set."""
    out = pa.schema(
        [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("node", pa.int64()), ("n_shingles", pa.int64()), ("bands", pa.binary()), ("sketch", pa.binary())]
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict = {f.name: [] for f in out}
            for doc_id, text_hash, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "text")), strict=True):
                hashes = shingles(text, words)
                node = bands = sketch = None
                if len(hashes):
                    node = int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)
                    least = samples(hashes)
                    bands, sketch = band_keys(least).tobytes(), odd_sketch(least)
                for values, value in zip(rows.values(), (doc_id, text_hash, node, len(hashes), bands, sketch), strict=True):
                    values.append(value)
            yield packed(rows, out)

    texts = docs.select("doc_id", F.xxhash64(text_or_empty("text")).alias("text_hash"), text_or_empty("text").alias("text"))
    return texts.mapInArrow(sign, "doc_id long, text_hash long, node long, n_shingles long, bands binary, sketch binary")


_STAR = pa.schema([("key", pa.int64()), ("u", pa.int64()), ("v", pa.int64())])


def _task_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bands of many classes to one row (key, least node) a key, and edges (u, v) to it from the others; an edge's key only deals it out."""

    def stars(held: list) -> pa.RecordBatch:
        keys, nodes = np.concatenate([k for k, _ in held]), np.concatenate([n for _, n in held])
        order = np.lexsort((nodes, keys))
        keys, nodes = keys[order], nodes[order]
        first = np.append(True, keys[1:] != keys[:-1])
        centre = nodes[np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))]
        rest = np.unique(np.stack([nodes[~first], centre[~first]]), axis=1)
        rest = rest[:, rest[0] != rest[1]]
        key = np.concatenate([keys[first], rest[0]])
        v = pa.array(np.concatenate([np.zeros(first.sum(), dtype=np.int64), rest[1]]), mask=np.arange(len(key)) < first.sum())
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.concatenate([nodes[first], rest[0]])), v], schema=_STAR)

    held, n = [], 0
    for batch in batches:
        nodes = batch.column("node").to_numpy(zero_copy_only=False)
        keys = np.frombuffer(b"".join(batch.column("bands").to_pylist()), dtype=np.int64)
        held.append((keys, np.repeat(nodes.astype(np.int64), BANDS)))
        n += len(keys)
        if n > HELD:
            yield stars(held)
            held, n = [], 0
    if n:
        yield stars(held)


def _all_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (key, u): edges to the first node of a key, and the edges that come along."""
    last_key, centre = None, None
    out = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    for batch in batches:
        keys, u = batch.column("key").to_numpy(), batch.column("u").to_numpy()
        edge = batch.column("v").is_valid().to_numpy(zero_copy_only=False)
        v = batch.column("v").fill_null(0).to_numpy()
        k, n = keys[~edge], u[~edge]
        pairs = [np.stack([u[edge], v[edge]])]
        if len(k):
            first = np.append(k[0] != last_key, k[1:] != k[:-1])
            at = np.maximum.accumulate(np.where(first, np.arange(len(k)), -1))
            centres = np.where(at >= 0, n[at], centre if centre is not None else 0)
            pairs.append(np.stack([n[~first], centres[~first]]))
            last_key, centre = k[-1], centres[-1]
        u, v = np.concatenate(pairs, axis=1)
        apart = u != v
        if apart.any():
            yield pa.RecordBatch.from_arrays([pa.array(u[apart]), pa.array(v[apart])], schema=out)


def candidate_edges(classes: DataFrame) -> DataFrame:
    """Distinct edges (u, v) that connect all classes that share a band."""
    local = classes.select("node", "bands").mapInArrow(_task_stars, "key long, u long, v long")
    dealt = local.repartition("key").sortWithinPartitions("key", "u")
    return dealt.mapInArrow(_all_stars, "u long, v long").distinct()


class Forest:
    """Union and find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        self.up[self.root(i)] = self.root(j)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def links(sets: list[np.ndarray], sketches: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Confirmed links that connect what similarity connects; with two sides, only pairs across them are looked at."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    two = side.min() != side.max()

    def near(i: int) -> tuple[np.ndarray, np.ndarray]:
        far = np.bitwise_count(sketches ^ sketches[i]).sum(axis=1, dtype=np.int64)
        fits = (far <= FARTHEST) & (100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i]))
        fits[i] = False
        if two:
            fits &= side != side[i]
        return np.flatnonzero(fits), far

    forest, found = Forest(n), []
    order = range(n)
    if n > 2:  # those with the most neighbours first: what they connect needs no other check
        closeness = [(-int((far[js] <= FARTHEST // 2).sum()), i) for i in range(n) for js, far in [near(i)]]
        order = [i for _, i in sorted(closeness)]
    for i in order:
        js, far = near(i)
        for j in js[np.argsort(far[js], kind="stable")].tolist():
            if forest.root(i) != forest.root(j) and similar(sets[i], sets[j], percent):
                forest.join(i, j)
                found.append((i, j))
    return found


def confirmed_edges(docs: DataFrame, members: DataFrame, words: int, percent: int) -> DataFrame:
    """Edges (u, v) of confirmed links within candidate components; members: node, component, doc_id, text_hash, sketch."""
    members = materialize(members, "near-members")
    sizes = members.groupBy("component").agg(F.count("*").alias("n"))
    total = members.count()
    small = max(1, math.ceil(2 * total / BLOCK))
    placed = members.join(sizes, "component").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = placed.withColumn("own", own)
    text = docs.select(
        F.col("doc_id").alias("t_id"), F.xxhash64(text_or_empty("text")).alias("t_hash"), text_or_empty("text").alias("text")
    )
    same = placed["doc_id"].eqNullSafe(text["t_id"]) & (placed["text_hash"] == text["t_hash"])
    out = pa.schema([("node", pa.int64()), ("component", pa.int64()), ("blocks", pa.int32()), ("own", pa.int32()), ("sketch", pa.binary()), ("hashes", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {c: batch.column(c).to_pylist() for c in out.names[:-1]}
            yield packed(rows | {"hashes": [shingles(t, words).tobytes() for t in batch.column("text").to_pylist()]}, out)

    sets = text.join(placed, same).select(*out.names[:-1], "text").mapInArrow(cut, "node long, component long, blocks int, own int, sketch binary, hashes binary")
    dealt = sets.withColumn("with", other).select(
        "node", "component", "own", "sketch", "hashes",
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(small))).otherwise(F.col("component")).alias("deal"),
        F.when(F.col("blocks") == 1, F.lit(-1)).otherwise(F.least("own", "with")).alias("low"),
        F.greatest("own", "with").alias("high"),
    )
    edge = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def confirm(table: pa.Table) -> pa.Table:
        columns = {c: table.column(c).to_pylist() for c in ("node", "component", "own", "sketch", "hashes")}
        by: dict[int, dict[int, int]] = {}
        for i, (component, node) in enumerate(zip(columns["component"], columns["node"], strict=True)):
            by.setdefault(component, {}).setdefault(node, i)  # a class is there once, also where its document's row is repeated
        rows: dict = {"u": [], "v": []}
        for own in by.values():
            at = list(own.values())
            sets = [np.frombuffer(columns["hashes"][i], dtype=np.uint64) for i in at]
            sketches = np.frombuffer(b"".join(columns["sketch"][i] for i in at), dtype=np.uint64).reshape(len(at), -1)
            for i, j in links(sets, sketches, np.array([columns["own"][i] for i in at]), percent):
                rows["u"].append(columns["node"][at[i]])
                rows["v"].append(columns["node"][at[j]])
        return pa.table(rows, schema=edge)

    return dealt.groupBy("deal", "low", "high").applyInArrow(confirm, "u long, v long")


def near_rows(docs: DataFrame, words: int, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_hash, n_shingles, node, group of every row of the documents; node and group are null for an empty set."""
    signed = materialize(signatures(docs, words), "near-signatures")
    some = signed.filter("node is not null")
    found = components(candidate_edges(some))
    member = some.join(found, "node").groupBy("node").agg(
        F.first("component").alias("component"),
        F.min_by(F.struct("doc_id", "text_hash"), F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("one"),
        F.first("sketch").alias("sketch"),
    )
    members = member.select("node", "component", "one.doc_id", "one.text_hash", "sketch")
    groups = components(confirmed_edges(docs, members, words, percent)).select("node", F.col("component").alias("group"))
    rows = signed.select("doc_id", "text_hash", "n_shingles", "node").join(groups, "node", "left")
    return rows.withColumn("group", F.coalesce("group", "node"))


def with_least(rows: DataFrame, least: Column) -> DataFrame:
    """The rows with ``least``, an aggregate over their group; null for those without one."""
    # by node, which has fewer rows in a group of copies than the group has
    of_group = rows.filter("node is not null").groupBy("group").agg(least.alias("least"))
    of_node = rows.filter("node is not null").select("node", "group").distinct().join(of_group, "group").select("node", "least")
    return rows.join(of_node, "node", "left")


def near_groups(docs: DataFrame, words: int, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id of every row of the documents."""
    rows = with_least(near_rows(docs, words, percent), F.min("doc_id"))
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return rows.select("doc_id", "text_hash", "n_shingles", own.alias("component_id"))


def keep_first(docs: DataFrame, words: int, percent: int = PERCENT) -> DataFrame:
    """One document of each group of similar ones: the row with the least id (null after all others), then hash of the text.

    Of rows with the same id and text one stays, that with the least hash of all columns. Texts without words are similar to nothing, so only repeated rows of one
    id go; without an id they all stay.
    """
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    rows = materialize(with_least(near_rows(docs, words, percent), F.min(order)), "near-rows")
    judged = rows.groupBy(F.col("doc_id").alias("n_id"), F.col("text_hash").alias("n_hash")).agg(
        F.count("*").alias("n"), F.first("node").alias("node"), F.first("least").alias("least")
    )
    first = F.col("node").isNull() | F.col("n_id").eqNullSafe(F.col("least.doc_id")) & (F.col("n_hash") == F.col("least.text_hash"))
    again = (F.col("n") > 1) & (F.col("node").isNotNull() | F.col("n_id").isNotNull())
    marks = materialize(judged.select("n_id", "n_hash", first.alias("n_first"), again.alias("n_again")).filter("not n_first or n_again"), "near-marks")

    def same(marked: DataFrame) -> Column:
        return docs["doc_id"].eqNullSafe(marked["n_id"]) & (F.xxhash64(text_or_empty(docs["text"])) == marked["n_hash"])

    alone = docs.join(marks, same(marks), "left_anti")
    repeated = marks.filter("n_first")
    if repeated.isEmpty():
        return alone
    least = F.min_by(F.struct(*docs.columns), F.xxhash64(F.to_json(F.struct(*docs.columns)))).alias("row")
    return alone.unionByName(docs.join(repeated, same(repeated)).groupBy("n_id", "n_hash").agg(least).select("row.*"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size, component and verdict of every document."""
    session(spark)
    groups = near_groups(load(spark, sf_dir, "documents"), words=2)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return groups.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[ \t-\r]+'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
        ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= {PERCENT} * (a.n + b.n - c)),
u AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
r AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT u.y, r.c FROM r JOIN u ON u.x = r.doc_id)
SELECT doc_id, coalesce(max(n.n), 0) AS n_shingles, min(c) AS component_id, doc_id = min(c) AS kept FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""
