"""Line dedup: lines that several documents share stay in the first document only.

A pair of Bloom filters tells which line hashes may occur in two documents or more. Tasks send each distinct line hash of
their documents once to the task of its filter block (blocks are by hash, so a common line is one hash from each task). There the hash
is set in the block's once-seen filter and, if its bits were set already, in the twice-seen filter. The twice-seen blocks go to the
shared folder; all of them have ``BLOCKS * BLOCK_BITS`` bits, 32 MB, whatever the input, and every worker reads them once. Lines whose
hash is in the twice-seen filter are suspects, and only they are shuffled: by their text, for the exact confirmation and the
choice of the first document. A fuller filter gives more suspects, never a wrong result; a larger corpus takes more blocks.

A line's key is the line without white space ``[\\x20\\x09-\\x0D]`` at its ends, A-Z lower-cased; keys under ``MIN_CHARS`` code points
always stay. A null or empty text is one empty line. Rows with one doc_id count as one document, and null ids as one document after all others.
Lines repeated within one document only are kept. Other columns of the documents are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.shared import LOWER, UPPER, ascii_lower, filesystem, load, materialize, ordered_id, packed, session, text_or_empty, work_folder

MIN_CHARS = 10
BLOCKS, BLOCK_BITS, PROBES = 64, 1 << 22, 4
HELD = 1 << 20
ENDS = " \t\n\x0b\x0c\r"


def keys_of(text: Column) -> Column:
    """The key of every line."""
    return F.transform(F.split(text, "\n"), lambda line: ascii_lower(F.trim(line, F.lit(ENDS))))


def blocks_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(58)).astype(np.int32) % BLOCKS


def bits_of(hashes: np.ndarray) -> np.ndarray:
    """Places of the hashes' bits in their block, PROBES columns."""
    step = (hashes >> np.uint64(29)) | np.uint64(1)
    return (hashes[:, None] + np.arange(PROBES, dtype=np.uint64) * step[:, None]) % np.uint64(BLOCK_BITS)


class FilterPair:
    """Once-seen and twice-seen filter of one block, a byte for a bit while they are built."""

    def __init__(self):
        self.once, self.twice = np.zeros(BLOCK_BITS, dtype=bool), np.zeros(BLOCK_BITS, dtype=bool)

    def add(self, hashes: np.ndarray, repeated: np.ndarray) -> None:
        """Distinct hashes of one sender, and those it has seen in two documents itself."""
        bits = bits_of(hashes)
        seen = self.once[bits].all(axis=1)
        self.twice[bits[seen]] = True
        self.once[bits] = True
        self.twice[bits_of(repeated)] = True


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Line hashes of documents to rows (block, hashes, those seen in two documents), HELD hashes at a time."""
    out = pa.schema([("block", pa.int32()), ("hashes", pa.binary()), ("repeated", pa.binary())])

    def send(held: list[np.ndarray]) -> pa.RecordBatch:
        hashes, counts = np.unique(np.concatenate(held), return_counts=True)
        block = blocks_of(hashes)
        rows: dict = {"block": [], "hashes": [], "repeated": []}
        for b in np.unique(block):
            mine = block == b
            rows["block"].append(int(b))
            rows["hashes"].append(hashes[mine].tobytes())
            rows["repeated"].append(hashes[mine & (counts > 1)].tobytes())
        return packed(rows, out)

    held, n = [], 0
    for batch in batches:
        lists = batch.column("hashes")
        held.append(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
        n += len(held[-1])
        if n > HELD:
            yield send(held)
            held, n = [], 0
    if n:
        yield send(held)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Twice-seen filters of the blocks that come to this task; memory is two filters for each, however many rows come."""
    pairs: dict[int, FilterPair] = {}
    for batch in batches:
        for block, hashes, repeated in zip(*(batch.column(c).to_pylist() for c in ("block", "hashes", "repeated")), strict=True):
            pairs.setdefault(block, FilterPair()).add(np.frombuffer(hashes, dtype=np.uint64), np.frombuffer(repeated, dtype=np.uint64))
    out = pa.schema([("block", pa.int32()), ("bits", pa.binary())])
    for block, pair in pairs.items():
        yield packed({"block": [block], "bits": [np.packbits(pair.twice).tobytes()]}, out)


_filters: dict[str, np.ndarray] = {}


def twice_filter(path: str) -> np.ndarray:
    """All blocks as one array of bits, read once by each worker."""
    if path not in _filters:
        import pyarrow.dataset as ds

        _filters.clear()
        store, folder = filesystem(path)
        bits = np.zeros((BLOCKS, BLOCK_BITS // 8), dtype=np.uint8)
        for batch in ds.dataset(folder, filesystem=store, format="parquet").to_batches():
            for block, data in zip(batch.column("block").to_pylist(), batch.column("bits").to_pylist(), strict=True):
                bits[block] = np.frombuffer(data, dtype=np.uint8)
        _filters[path] = bits
    return _filters[path]


def suspected(path: str) -> Column:
    """Whether a line hash may occur in two documents."""

    @F.pandas_udf("boolean")
    def test(hashes: pd.Series) -> pd.Series:
        bits, values = twice_filter(path), hashes.to_numpy().astype(np.int64).view(np.uint64)
        places = bits_of(values)
        found = bits[blocks_of(values)[:, None], places >> np.uint64(3)] >> (np.uint64(7) - (places & np.uint64(7))).astype(np.uint8)
        return pd.Series((found & 1).all(axis=1))

    return test


def shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(o, key) of the lines to drop: document order and line key, once each."""
    spark = docs.sparkSession
    lines = docs.select(
        ordered_id().alias("o"), F.array_distinct(F.filter(keys_of(text_or_empty("text")), lambda k: F.length(k) >= min_chars)).alias("keys")
    )
    hashes = lines.select(F.transform("keys", lambda k: F.xxhash64(k)).alias("hashes"))
    path = work_folder(spark, "line-filters")
    built = hashes.mapInArrow(_distinct, "block int, hashes binary, repeated binary").repartition("block").mapInArrow(_build, "block int, bits binary")
    built.write.parquet(path)
    rows = lines.select("o", F.explode("keys").alias("key"))
    suspects = materialize(rows.filter(suspected(path)(F.xxhash64("key"))), "line-suspects")
    first = suspects.groupBy("key").agg(F.min("o").alias("first"), F.max("o").alias("last")).filter("first < last")
    return suspects.join(first, "key").filter("o > first").select("o", "key")


def _without(texts: pd.Series, drops: pd.Series) -> pd.DataFrame:
    table = str.maketrans(UPPER, LOWER)
    kept, dropped = [], []
    for text, keys in zip(texts, drops, strict=True):
        if text is None or keys is None:
            kept.append(None)
            dropped.append(0)
            continue
        keys, lines = set(keys), text.split("\n")
        stay = [line for line in lines if line.strip(ENDS).translate(table) not in keys]
        kept.append("\n".join(stay))
        dropped.append(len(lines) - len(stay))
    return pd.DataFrame({"kept": kept, "dropped": dropped})


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents with l_text, l_n_lines and l_n_dropped; a document's own keys to drop are as many as its lines at most."""
    drops = shared_lines(docs, min_chars).groupBy(F.col("o").alias("l_o")).agg(F.collect_set("key").alias("l_drops"))
    text = text_or_empty("text")
    joined = docs.join(drops, ordered_id() == drops["l_o"], "left").drop("l_o")
    cut = joined.withColumn("l_cut", F.pandas_udf(_without, "struct<kept:string,dropped:long>")(F.when(F.col("l_drops").isNotNull(), text), F.col("l_drops")))
    return cut.withColumns(
        {
            "l_text": F.coalesce(F.col("l_cut.kept"), text),
            "l_n_lines": F.size(F.split(text, "\n")).cast("long"),
            "l_n_dropped": F.coalesce(F.col("l_cut.dropped"), F.lit(0)),
        }
    ).drop("l_cut", "l_drops")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines before, lines dropped and the digest of the rest, of every document."""
    session(spark)
    done = dedup_lines(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select(
        "doc_id", F.col("l_n_lines").alias("n_lines"), F.col("l_n_dropped").alias("n_dropped"), F.sha2("l_text", 256).alias("kept_sha256")
    )


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS o, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, o, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM l),
f AS (SELECT key, min(o) AS first FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING min(o) < max(o)),
m AS (SELECT r, line, pos, coalesce(o > first, false) AS gone FROM k LEFT JOIN f USING (key)),
g AS (SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept FROM m GROUP BY r)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM d JOIN g USING (r)
"""
