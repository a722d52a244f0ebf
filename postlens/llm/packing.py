"""Best-fit decreasing packing of token pieces into sequences.

``pieces`` encodes each text, ends it with one id and cuts only what is longer than a sequence. ``pack`` deals the pieces by a hash
into groups of about ``GROUP`` pieces, the number of groups following their count, and places each group on its own: longest
first, each piece into the open sequence with the least room that still holds it. The rooms are the leaves of a segment tree, so
that sequence is found in steps of the logarithm of the sequence length, however many are open. A group is large enough
that what is left open at its end is a vanishing part of it; pieces of a source or of equal length spread over all groups.

A null text is empty and gives one piece, the end id. Repeated rows give repeated pieces. An empty table gives no row; null ids are
kept. Other columns of the documents are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.shared import load, materialize, packed, session, text_or_empty
from postlens.llm.tokens import encoder

VOCABULARY, END_ID = "word_bpe_49k.json", 0
SEQUENCE_LENGTH = 2048
GROUP = 50_000
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Rooms:
    """Segment tree over the rooms 0..length: whether a sequence with that room is open, and which ones are."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.open = [0] * (2 * self.leaves)
        self.having: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.having[room].append(sequence)
        node = room + self.leaves
        while node:
            self.open[node] += 1
            node >>= 1

    def take(self, room: int) -> int:
        node = room + self.leaves
        while node:
            self.open[node] -= 1
            node >>= 1
        return self.having[room].pop()

    def tightest(self, need: int) -> int:
        """The least room of at least ``need`` that an open sequence has, or -1."""
        node = need + self.leaves
        if self.open[node]:
            return need
        while node > 1:
            if not node & 1 and self.open[node + 1]:
                node += 1
                break
            node >>= 1
        if node <= 1:
            return -1
        while node < self.leaves:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit(lengths: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; the pieces come longest first."""
    rooms, sequences, offsets, used = Rooms(length), [], [], 0
    for need in lengths.tolist():
        room = rooms.tightest(need)
        if room < 0:
            sequence, room = used, length
            used += 1
        else:
            sequence = rooms.take(room)
        sequences.append(sequence)
        offsets.append(length - room)
        if room > need:
            rooms.add(room - need, sequence)
    return np.array(sequences, dtype=np.int64), np.array(offsets, dtype=np.int64)


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID, length: int = SEQUENCE_LENGTH, keep_ids: bool = False) -> DataFrame:
    """The pieces of all documents, with their ids where asked for."""
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    out = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * keep_ids)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(vocabulary)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            rows: dict = {f.name: [] for f in out}
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), codec.ids(batch.column("text").to_pylist()), strict=True):
                raw += end
                for k, at in enumerate(range(0, len(raw), 4 * length)):
                    part = raw[at : at + 4 * length]
                    for name, value in zip(rows, (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)), strict=False):
                        rows[name].append(value)
                    if keep_ids:
                        rows["ids"].append(np.frombuffer(part, dtype="<u4").astype(np.int32))
            yield packed(rows, out)

    return docs.select("doc_id", text_or_empty("text").alias("text")).mapInArrow(cut, PIECE + ", ids array<int>" * keep_ids)


def pack(cut: DataFrame, length: int = SEQUENCE_LENGTH, group: int = GROUP) -> DataFrame:
    """The pieces with sequence_id and offset; the pieces should be a stored table, since they are counted first."""
    groups = max(1, math.ceil(cut.count() / group))

    def place(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        ids = [table.column(c).to_numpy(zero_copy_only=False) for c in ("ids_crc32", "piece")]
        order = np.lexsort((ids[1], ids[0], -lengths))  # ties by content, so that a repeated run packs alike
        sequences, offsets = best_fit(lengths[order], length)
        number = table.column("pack_group")[0].as_py() << 32
        done = table.take(pa.array(order)).drop_columns("pack_group")
        return done.append_column("sequence_id", pa.array(sequences + number)).append_column("offset", pa.array(offsets))

    dealt = cut.withColumn("pack_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"
    return dealt.groupBy("pack_group").applyInArrow(place, schema)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    session(spark)
    return pack(materialize(pieces(load(spark, sf_dir, "documents")), "pieces"))
