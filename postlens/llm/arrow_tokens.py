"""Token ids as Arrow files of equal-length sequences, and their reading by random access.

``write_tokens`` orders the documents by id (a range shuffle, so that the files follow one another), encodes them, ends each with
one id, and cuts the stream of a task into sequences of fixed length. A file is in the Arrow IPC file format: record batches of
fixed-size lists, ``ids`` and ``mask`` (false in the filling after the last id), uncompressed, so that a reader maps the file and
takes any range of ids without decoding. The manifest names each document's file and place in it.
A file holds the documents of one task, the filling is less than one sequence a file. Ids are stored in the narrowest unsigned
type that holds the vocabulary.

``read_tokens`` gives the manifest's documents back from the files: their place in the whole stream, their number of ids and a
checksum, or the ids. It deals out documents, not files, so a long file is read by several tasks.

A null text is empty and has the end id only. Documents with one id stand in the order of a hash of their text; null ids
come last. An empty table has an empty manifest. Other columns of the documents are not read.
Failed and repeated attempts of a task write files under names of their own, which no manifest lists.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.shared import filesystem, load, materialize, ordered_id, packed, session, text_or_empty, unique_name, work_folder
from postlens.llm.tokens import encoder

VOCABULARY, END_ID = "byte_bpe_50k.json", 2
SEQUENCE_LENGTH = 2048
BATCH_SEQUENCES = 64
MANIFEST = "doc_id long, file string, start_in_file long, n_tokens long"


class SequenceWriter:
    """Cuts a stream of ids into batches of fixed-size lists of one file."""

    def __init__(self, folder: str, length: int, wide: bool):
        self.type = pa.uint32() if wide else pa.uint16()
        self.dtype = np.uint32 if wide else np.uint16
        self.length = length
        self.schema = pa.schema([("ids", pa.list_(self.type, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.name = unique_name("tokens", ".arrow")
        store, path = filesystem(f"{folder}/{self.name}")
        store.create_dir(path.rpartition("/")[0], recursive=True)
        self.sink = store.open_output_stream(path)
        self.file = pa.ipc.new_file(self.sink, self.schema)
        self.held: list[np.ndarray] = []
        self.n_held = self.n = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids.astype(self.dtype))
        self.n_held += len(ids)
        self.n += len(ids)
        full = self.length * BATCH_SEQUENCES
        if self.n_held >= full:
            ids = np.concatenate(self.held)
            cut = len(ids) // full * full
            for at in range(0, cut, full):
                self.put(ids[at : at + full], full)
            self.held, self.n_held = [ids[cut:]], len(ids) - cut

    def put(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x, type=t), self.length) for x, t in ((ids, self.type), (mask, pa.bool_()))]
        self.file.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        if self.n_held:
            ids = np.concatenate(self.held)
            self.put(np.append(ids, np.zeros(-len(ids) % self.length, dtype=self.dtype)), len(ids))
        self.file.close()
        self.sink.close()


def write_tokens(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, end_id: int = END_ID, length: int = SEQUENCE_LENGTH) -> DataFrame:
    """Write the documents' ids under the folder; returns the manifest, one row per document, itself stored."""
    out = pa.schema([("doc_id", pa.int64()), ("file", pa.string()), ("start_in_file", pa.int64()), ("n_tokens", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, codec = None, encoder(vocabulary)
        wide = max(codec.tokenizer.get_vocab_size() - 1, end_id) > 0xFFFF
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            rows: dict = {f.name: [] for f in out}
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), codec.ids(batch.column("text").to_pylist()), strict=True):
                writer = writer or SequenceWriter(folder, length, wide)
                ids = np.frombuffer(raw + end, dtype="<u4")
                for column, value in zip(rows.values(), (doc_id, writer.name, writer.n, len(ids)), strict=True):
                    column.append(value)
                writer.add(ids)
            yield packed(rows, out)
        if writer:
            writer.close()

    texts = docs.select("doc_id", text_or_empty("text").alias("text"))
    order = [ordered_id(), F.xxhash64("text")]
    ordered = texts.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(ordered.mapInArrow(write, MANIFEST), "token-manifest")


def placed(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``, the number of ids of all documents before each; only one row a file is ordered as a whole."""
    files = manifest.groupBy("file").agg(F.min(ordered_id()).alias("first"), F.max(ordered_id()).alias("last"), F.sum("n_tokens").alias("n"))
    before = Window.orderBy("first", "last", "file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return manifest.join(files, "file").withColumn("start", F.col("base") + F.col("start_in_file")).drop("base")


class SequenceReader:
    """Ranges of ids of one file, mapped where the store allows it; batches are read when first used."""

    def __init__(self, folder: str, name: str):
        store, path = filesystem(f"{folder}/{name}")
        self.source = pa.memory_map(path) if store.type_name == "local" else store.open_input_file(path)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("ids").type.list_size
        self.at, self.batch = -1, (None, None)

    def values(self, k: int) -> tuple[np.ndarray, pa.Array]:
        if k != self.at:
            batch = self.file.get_batch(k)
            self.at, self.batch = k, (batch.column("ids").flatten().to_numpy(zero_copy_only=True), batch.column("mask").flatten())
        return self.batch

    def ids(self, start: int, n: int) -> np.ndarray:
        size, parts = self.length * BATCH_SEQUENCES, []
        while n:
            ids, mask = self.values(start // size)
            at = start % size
            take = min(n, size - at)
            part = ids[at : at + take]
            if len(part) < take or mask.slice(at, take).false_count:
                raise ValueError("the manifest names ids that the file does not hold")
            parts.append(part)
            start, n = start + take, n - take
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32)

    def close(self) -> None:
        self.at, self.batch, self.file = -1, (None, None), None
        self.source.close()


def read_tokens(manifest: DataFrame, folder: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, and its ids where asked for, from the files."""
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    out = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * keep_ids)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, name = None, None
        for batch in batches:
            rows: dict = {f.name: [] for f in out}
            for row in batch.to_pylist():
                if row["file"] != name:
                    if reader:
                        reader.close()
                    name, reader = row["file"], SequenceReader(folder, row["file"])
                ids = reader.ids(row["start_in_file"], row["n_tokens"])
                rows["doc_id"].append(row["doc_id"])
                rows["start"].append(row["start"])
                rows["n_tokens"].append(len(ids))
                rows["ids_crc32"].append(zlib.crc32(ids.astype("<u4").tobytes()))
                if keep_ids:
                    rows["ids"].append(ids.astype(np.int32))
            yield packed(rows, out)
        if reader:
            reader.close()

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * keep_ids
    rows = placed(manifest).repartitionByRange("file", "start_in_file").sortWithinPartitions("file", "start_in_file")
    return rows.mapInArrow(read, schema)


def op2_arrow_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents to Arrow files of token ids and back."""
    session(spark)
    folder = work_folder(spark, "arrow-tokens")
    manifest = write_tokens(load(spark, sf_dir, "documents"), folder)
    return read_tokens(manifest, folder)
