"""Alignment of two tokenizers over the same texts, with corpus-wide counts of token pairs behind minimal perfect hashes.

A is a byte-level BPE, given the text after one space; B a BPE of pieces with byte fallback, which adds that space itself. Both cut the same bytes, so tokens are aligned
by their byte ends: ends of both cut the text into groups, and a pair of tokens is linked where their byte ranges overlap. Each cell between two neighbouring ends (of either side) belongs to
one A and one B token and no two cells to the same pair, so the cells are the links.

1.  Texts are encoded once, and stored as chunks: one row holds the ids of as many whole documents as fit ``CHUNK`` ids (a longer document is a row of its own). Rows have a number, so that
    repeated documents or null ids are no key.
2.  Each chunk gives its distinct id pairs and, for each, the number of its documents that hold it. The distinct pairs of the corpus are dealt into shards of about ``SHARD`` pairs by hash; each shard
    gets a minimal perfect hash (levels of bits, one set where just one key falls; a pair's place is the rank of its bit) and the keys in that order, against which each look-up is verified.
3.  Counts of ``FAN`` chunks at a time are added into dense vectors, indexed by that hash, and the vectors are summed as a tree, ``FAN`` at a time, until each shard has one. No vector is longer than its
    shard, whatever the corpus. The highest count of each A id is a list as long as A's vocabulary.
4.  The second pass aligns the stored chunks again. The pairs of a chunk meet the shards, come back with their counts, and every link of its documents is looked up among them.

Defined results: texts that are null, empty, or whose joined A or B bytes differ from space and text have no tokens, zeros and an empty digest. Repeated rows each count as a document. Ids may be null or repeated.
Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.shared import load, materialize, session

CHUNK = 200_000  # ids of either side in a row
SHARD = 1 << 18  # pairs of a shard
FAN = 32  # chunks or vectors that are summed at once
ROOM = 2  # bits for each key of a level
WORDS = 150_000  # words kept in either half of the cache
A_FILE, B_FILE = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
MARK = "▁"


# ---- tokens


class Vocabulary:
    """Both tokenizers, the bytes of their tokens, and a bounded cache of words.

    No token of either side reaches over white space into a word but for the one blank before it, so the ids of a text whose white space is single blanks and line ends between words are those of
    its words. The new words of a batch are encoded in one go and cut apart by their bytes. Any other text is encoded whole.
    """

    def __init__(self) -> None:
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(public_tokenizers.path(A_FILE), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.a = tiktoken.Encoding("aligned", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(B_FILE))
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.b_bytes = [self.piece_bytes(i) for i in range(self.b.get_piece_size())]
        self.a_length = np.array([len(x) for x in self.a_bytes])
        self.b_length = np.array([len(x) for x in self.b_bytes])
        self.blank = self.b.piece_to_id(MARK)
        self.cache: dict[str, tuple[bytes, bytes]] = {}
        self.older: dict[str, tuple[bytes, bytes]] = {}
        self.unproven: set[str] = set()  # words whose ids were not held against their bytes

    def piece_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(MARK, " ").encode()

    def whole(self, text: str) -> tuple[bytes, bytes]:
        clean = text.encode("utf-8", "replace").decode()
        a = np.array(self.a.encode_ordinary(" " + clean), dtype=np.uint16)
        return a.tobytes(), np.array(self.b.encode(clean), dtype=np.uint16).tobytes()

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """The ids of each text, or none where they don't stand for its bytes."""
        split: list = []
        for text in texts:
            regular = text and MARK not in text and " ".join(text.split()) == text.replace("\n", " ")
            split.append(text.replace("\n", " \n").split(" ") if regular else None)
        self.learn({w for words in split if words for w in words})
        cache, out = self.cache, []
        for text, words in zip(texts, split, strict=True):
            if not text:
                out.append((b"", b""))
                continue
            if words:
                found = [cache[w] for w in words]
                a, b = b"".join([x[0] for x in found]), b"".join([x[1] for x in found])
                proven = self.unproven.isdisjoint(words)
            else:
                a, b = self.whole(text)
                proven = False
            out.append((a, b) if proven or self.stands_for(a, b, text) else (b"", b""))
        if len(cache) > WORDS:
            self.cache, self.older = {}, cache
            self.unproven &= cache.keys()
        return out

    def stands_for(self, a: bytes, b: bytes, text: str) -> bool:
        try:
            want = (" " + text).encode()
        except UnicodeEncodeError:  # half a pair
            return False
        joined = lambda ids, table: b"".join([table[i] for i in np.frombuffer(ids, np.uint16).tolist()])
        return joined(a, self.a_bytes) == want and joined(b, self.b_bytes) == want

    def learn(self, words: set[str]) -> None:
        """Put words into the cache: those after a blank as one text, those after a line end one by one lines."""
        new = []
        for w in words:
            if w not in self.cache:
                if w in self.older:
                    self.cache[w] = self.older[w]
                else:
                    new.append(w)
        plain = sorted(w for w in new if w[0] != "\n")
        lines = sorted(w for w in new if w[0] == "\n")
        for some, text in ((plain, " ".join(plain)), (lines, "".join(lines))):
            if some:
                self.cut(some, text, 1 if some is plain else 0)

    def cut(self, words: list[str], text: str, blank: int) -> None:
        a, b = self.whole(text)
        proven = self.stands_for(a, b, text)
        if not blank:  # the blank before the first line end
            first = self.a.encode_ordinary(" ")
            a = a[2 * len(first) :]
            b = b[2:] if b[:2] == np.uint16(self.blank).tobytes() else b""
        ids_a, ids_b = np.frombuffer(a, np.uint16), np.frombuffer(b, np.uint16)
        ends = np.cumsum([len(w.encode("utf-8", "replace")) + blank for w in words])
        at_a, good_a = places(np.cumsum(self.a_length[ids_a]), ends)
        at_b, good_b = places(np.cumsum(self.b_length[ids_b]), ends)
        before_a, before_b, sound = 0, 0, True
        for w, i, j, good in zip(words, at_a.tolist(), at_b.tolist(), (good_a & good_b).tolist(), strict=True):
            if not (proven and sound and good):
                self.unproven.add(w)
            if sound and good:
                self.cache[w] = a[2 * before_a : 2 * i], b[2 * before_b : 2 * j]
            else:  # not cut at its ends here: by itself
                alone = self.whole(w)
                self.cache[w] = alone if blank else (alone[0][2 * len(self.a.encode_ordinary(" ")) :], alone[1][2:])
            before_a, before_b, sound = i, j, good


def places(token_ends: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens end up to each of the ends, and whether one ends there."""
    at = np.searchsorted(token_ends, ends, side="right")
    return at, (at > 0) & (token_ends[np.maximum(at, 1) - 1] == ends) if len(token_ends) else np.zeros(len(ends), bool)


_vocabulary: list[Vocabulary] = []


def vocabulary() -> Vocabulary:
    """The worker's tokenizers."""
    if not _vocabulary:
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        _vocabulary.append(Vocabulary())
    return _vocabulary[0]


def squeezed(ids: bytes) -> bytes:
    """Ids as a plane of low bytes and one of high bytes, compressed."""
    return pa.compress(np.frombuffer(ids, np.uint8).reshape(-1, 2).T.tobytes(), codec="zstd", asbytes=True) if ids else b""


def restored(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint16)
    planes = np.frombuffer(pa.decompress(data, 2 * n, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(2, n).T).view(np.uint16)[:, 0]


CHUNKS = pa.schema([("doc_ids", pa.list_(pa.int64())), ("a", pa.binary()), ("b", pa.binary()), ("n_a", pa.list_(pa.int64())), ("n_b", pa.list_(pa.int64()))])


def encode_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids: list = []
    tokens: list[tuple[bytes, bytes]] = []
    size = 0

    def row() -> pa.RecordBatch:
        columns = [[ids], [squeezed(b"".join([t[0] for t in tokens]))], [squeezed(b"".join([t[1] for t in tokens]))], [[len(t[0]) // 2 for t in tokens]], [[len(t[1]) // 2 for t in tokens]]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, CHUNKS, strict=True)], schema=CHUNKS)

    for batch in batches:
        found = vocabulary().encode([t or "" for t in batch.column("text").to_pylist()])
        for i, t in zip(batch.column("doc_id").to_pylist(), found, strict=True):
            n = max(len(t[0]), len(t[1])) // 2
            if ids and size + n > CHUNK:
                yield row()
                ids, tokens, size = [], [], 0
            ids.append(i)
            tokens.append(t)
            size += n
    if ids:
        yield row()


# ---- alignment


class Aligned:
    """The links of a chunk's documents: ``pair`` (A id, B id as one number), ``doc`` (place in the chunk), and what groups need."""

    def __init__(self, a: bytes, b: bytes, n_a: np.ndarray, n_b: np.ndarray):
        v = vocabulary()
        self.n_a, self.n_b = np.asarray(n_a, np.int64), np.asarray(n_b, np.int64)
        self.a, self.b = restored(a, int(self.n_a.sum())), restored(b, int(self.n_b.sum()))
        # both sides of every document have the same bytes, so running ends are comparable over the whole chunk
        self.ends_a, self.ends_b = np.cumsum(v.a_length[self.a]), np.cumsum(v.b_length[self.b])
        self.common = np.intersect1d(self.ends_a, self.ends_b, assume_unique=True)
        cells = np.union1d(self.ends_a, self.ends_b)
        of_a, of_b = np.searchsorted(self.ends_a, cells), np.searchsorted(self.ends_b, cells)
        self.pair = (self.a[of_a].astype(np.uint32) << np.uint32(16)) | self.b[of_b]
        self.last_a = np.cumsum(self.n_a)
        self.doc = np.searchsorted(self.last_a, of_a, side="right")

    def held(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct pairs and the number of documents that hold each."""
        once = np.unique((self.doc.astype(np.uint64) << np.uint64(32)) | self.pair)
        return np.unique((once & np.uint64(0xFFFFFFFF)).astype(np.uint32), return_counts=True)

    def groups(self) -> tuple[np.ndarray, list[str]]:
        """The number of groups of each document and their text."""
        group_a, group_b = np.searchsorted(self.common, self.ends_a), np.searchsorted(self.common, self.ends_b)
        side = np.concatenate([group_a * 2, group_b * 2 + 1])
        order = np.argsort(side, kind="stable")
        kind = side[order]
        ends = np.append(kind[1:] != kind[:-1], True) if len(kind) else np.zeros(0, bool)
        mark = np.where(ends, 1 + (kind & 1), 0)  # within a side, after A, after B
        ids = np.concatenate([self.a, self.b])[order].astype(np.int64)
        written = [names()[k] for k in (ids * 3 + mark).tolist()]
        n = self.n_a + self.n_b
        bounds = np.concatenate([[0], np.cumsum(n)])  # groups follow documents, so a document's tokens stay together
        texts = ["".join(written[lo:hi])[:-1] for lo, hi in itertools.pairwise(bounds.tolist())]
        last = np.concatenate([[0], self.ends_a[self.last_a - 1] * (self.last_a > 0)]) if len(self.a) else np.zeros(len(n) + 1, np.int64)
        return np.diff(np.searchsorted(self.common, last, side="right")), texts


_names: list[str] = []


def names() -> list[str]:
    """Every id with the mark that may follow it."""
    if not _names:
        v = vocabulary()
        _names.extend(f"{i}{mark}" for i in range(max(len(v.a_bytes), len(v.b_bytes))) for mark in ",|;")
    return _names


# ---- minimal perfect hashes


def mixed(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys.astype(np.uint64) + np.uint64((level * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Distinct keys to 0 .. n-1: at each level a key whose bit no other key shares has its place; the others go on to the next."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # bits as bytes of 0 and 1
        self.ranks = []
        total = 0
        for bits in levels:
            self.ranks.append(total + np.cumsum(bits, dtype=np.int64) - bits)
            total += int(bits.sum())

    @staticmethod
    def of(keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left):
            at = (mixed(left, len(levels)) % np.uint64(ROOM * len(left) + 1)).astype(np.int64)
            count = np.bincount(at, minlength=ROOM * len(left) + 1)
            levels.append((count == 1).astype(np.uint8))
            left = left[count[at] != 1]
        return PerfectHash(levels)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key; of a key that was not given, any place or -1."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = (mixed(keys[left], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at] == 1
            out[left[hit]] = ranks[at[hit]]
            left = left[~hit]
        return out

    def pack(self) -> tuple[list[int], bytes]:
        return [len(x) for x in self.levels], b"".join(np.packbits(x).tobytes() for x in self.levels)

    @staticmethod
    def unpack(sizes: list[int], data: bytes) -> PerfectHash:
        levels, at = [], 0
        for n in sizes:
            held = (n + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(data[at : at + held], np.uint8), count=n))
            at += held
        return PerfectHash(levels)


def verified(hashed: PerfectHash, keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Places of asked keys, each checked against the key that is held there."""
    at = hashed.places(asked)
    if len(at) and ((at < 0).any() or (keys[at] != asked).any()):
        raise ValueError("a pair that the hash was not built for")
    return at


def shard_of(pairs: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(pairs, 64) % np.uint64(shards)).astype(np.int64)


def dealt(chunk: int, pairs: np.ndarray, counts: np.ndarray, shards: int) -> list[tuple]:
    """(chunk, shard, pairs, counts) of a chunk for every shard that it meets."""
    at = shard_of(pairs, shards)
    order = np.argsort(at, kind="stable")
    pairs, counts, at = pairs[order], counts[order], at[order]
    edges = np.searchsorted(at, np.arange(shards + 1))
    return [(chunk, s, pairs[lo:hi].tobytes(), counts[lo:hi].astype(np.int64).tobytes()) for s, (lo, hi) in enumerate(itertools.pairwise(edges.tolist())) if hi > lo]


def u32(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint32)


def i64(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64)


def count_pairs(chunks: DataFrame, shard: int = SHARD, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """Pairs of each chunk by shard, and each shard's hash (sizes, bits), keys, counts and whether a count is its A id's highest."""
    spark = chunks.sparkSession

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_pylist():
                pairs, counts = Aligned(row["a"], row["b"], row["n_a"], row["n_b"]).held()
                out = pd.DataFrame({"chunk": [row["chunk"]], "pairs": [pairs.tobytes()], "counts": [counts.astype(np.int64).tobytes()]})
                yield pa.RecordBatch.from_pandas(out, schema=pa.schema([("chunk", pa.int64()), ("pairs", pa.binary()), ("counts", pa.binary())]), preserve_index=False)

    by_chunk = materialize(chunks.mapInArrow(held, "chunk long, pairs binary, counts binary"), "align-pairs")

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = np.zeros(0, np.uint32)
        for batch in batches:  # what a task has told already it doesn't tell again, as long as the list is short
            for data in batch["pairs"]:
                new = np.setdiff1d(u32(data), known, assume_unique=True)
                known = np.union1d(known, new) if len(known) < 1 << 22 else new
                yield pd.DataFrame({"pair": new.astype(np.int64)})

    pairs = materialize(by_chunk.select("pairs").mapInPandas(listed, "pair long").distinct(), "align-distinct")
    shards = max(1, -(-pairs.count() // shard))

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        keys = np.sort(group["pair"].to_numpy()).astype(np.uint32)
        hashed = PerfectHash.of(keys)
        placed = np.empty(len(keys), np.uint32)
        placed[hashed.places(keys)] = keys
        sizes, bits = hashed.pack()
        return pd.DataFrame({"shard": [key[0]], "sizes": [sizes], "bits": [bits], "keys": [placed.tobytes()]})

    def with_shard(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(shard=shard_of(batch["pair"].to_numpy().astype(np.uint32), shards))

    table = "shard long, sizes array<int>, bits binary, keys binary"
    hashes = materialize(pairs.mapInPandas(with_shard, "pair long, shard long").groupBy("shard").applyInPandas(build, table), "align-hashes")

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk, p, c in zip(batch["chunk"], batch["pairs"], batch["counts"], strict=True):
                yield pd.DataFrame(dealt(chunk, u32(p), i64(c), shards), columns=["chunk", "shard", "pairs", "counts"])

    by_shard = materialize(by_chunk.mapInPandas(deal, "chunk long, shard long, pairs binary, counts binary"), "align-shards")
    n = chunks.count()
    groups = max(1, -(-n // fan))
    each = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    leaf = F.pmod(F.xxhash64("chunk"), F.lit(groups)).cast("int")

    def add(key: tuple, hashed: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(held):
            return pd.DataFrame({"shard": [], "leaf": [], "vector": []})
        keys = u32(hashed["keys"].iat[0])
        index = PerfectHash.unpack(list(hashed["sizes"].iat[0]), hashed["bits"].iat[0])
        vector = np.zeros(len(keys), np.int64)
        for p, c in zip(held["pairs"], held["counts"], strict=True):
            vector[verified(index, keys, u32(p))] += i64(c)  # a chunk holds a pair once
        return pd.DataFrame({"shard": [key[0]], "leaf": [key[1]], "vector": [vector.tobytes()]})

    left = hashes.select("shard", "sizes", "bits", "keys", each.alias("leaf")).groupBy("shard", "leaf")
    vectors = left.cogroup(by_shard.withColumn("leaf", leaf).groupBy("shard", "leaf")).applyInPandas(add, "shard long, leaf int, vector binary")

    def total(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        vector = np.zeros(len(group["vector"].iat[0]) // 8, np.int64)
        for data in group["vector"]:
            vector += i64(data)
        return pd.DataFrame({"shard": [key[0]], "leaf": [key[1]], "vector": [vector.tobytes()]})

    while groups > 1:
        groups = -(-groups // fan)
        vectors = vectors.withColumn("leaf", F.col("leaf") % groups).groupBy("shard", "leaf").applyInPandas(total, "shard long, leaf int, vector binary")
    counted = materialize(hashes.join(vectors.select("shard", "vector"), "shard"), "align-counts")

    def highest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for keys, vector in zip(batch["keys"], batch["vector"], strict=True):
                top = np.zeros(1 << 16, np.int64)
                np.maximum.at(top, u32(keys) >> np.uint32(16), i64(vector))
                used = np.nonzero(top)[0]
                yield pd.DataFrame({"a": used, "top": top[used]})

    # one row for each A id at most: bounded by the vocabulary
    found = counted.mapInPandas(highest, "a long, top long").groupBy("a").agg(F.max("top").alias("top")).collect()
    top = np.zeros(1 << 16, np.int64)
    for r in found:
        top[r.a] = r.top

    def flag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["best"] = [(i64(v) == top[u32(k) >> np.uint32(16)]).astype(np.uint8).tobytes() for k, v in zip(batch["keys"], batch["vector"], strict=True)]
            yield batch

    return by_shard, counted.mapInPandas(flag, f"{table}, vector binary, best binary")


def look_up(by_shard: DataFrame, counted: DataFrame, groups: int) -> DataFrame:
    """(chunk, pairs, counts, best) of every chunk and shard, from the shards' vectors."""
    each = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    leaf = F.pmod(F.xxhash64("chunk"), F.lit(groups)).cast("int")

    def answer(key: tuple, hashed: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked):
            keys, vector = u32(hashed["keys"].iat[0]), i64(hashed["vector"].iat[0])
            best = np.frombuffer(hashed["best"].iat[0], np.uint8)
            index = PerfectHash.unpack(list(hashed["sizes"].iat[0]), hashed["bits"].iat[0])
            for chunk, p in zip(asked["chunk"], asked["pairs"], strict=True):
                at = verified(index, keys, u32(p))
                out.append((chunk, p, vector[at].tobytes(), best[at].tobytes()))
        return pd.DataFrame(out, columns=["chunk", "pairs", "counts", "best"])

    left = counted.withColumn("leaf", each).groupBy("shard", "leaf")
    right = by_shard.select("chunk", "shard", "pairs", leaf.alias("leaf")).groupBy("shard", "leaf")
    return left.cogroup(right).applyInPandas(answer, "chunk long, pairs binary, counts binary, best binary")


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def align(docs: DataFrame, shard: int = SHARD, fan: int = FAN) -> DataFrame:
    """The digest of every document's alignment and the counts of its links."""
    encoded = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode_chunks, "doc_ids array<long>, a binary, b binary, n_a array<long>, n_b array<long>")
    # numbered before it is stored, so the numbers don't change when a later task is run again
    chunks = materialize(encoded.withColumn("chunk", F.monotonically_increasing_id()), "align-chunks")
    by_shard, counted = count_pairs(chunks, shard, fan)
    found = look_up(by_shard, materialize(counted, "align-best"), max(1, -(-chunks.count() // fan)))
    fields = [(f.split()[0], {"long": pa.int64(), "string": pa.string()}[f.split()[1]]) for f in RESULT.split(", ")]

    def again(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        out: dict[str, list] = {n: [] for n, _ in fields}
        answers = answers.to_pydict()
        pairs = np.concatenate([np.zeros(0, np.uint32), *map(u32, answers["pairs"])])
        counts = np.concatenate([np.zeros(0, np.int64), *map(i64, answers["counts"])])
        best = np.concatenate([np.zeros(0, np.uint8), *[np.frombuffer(x, np.uint8) for x in answers["best"]]])
        order = np.argsort(pairs)
        pairs, counts, best = pairs[order], counts[order], best[order].astype(np.int64)
        for row in rows.to_pylist():
            x = Aligned(row["a"], row["b"], row["n_a"], row["n_b"])
            at = np.searchsorted(pairs, x.pair)
            n_groups, texts = x.groups()
            n = len(x.n_a)
            edges = np.searchsorted(x.doc, np.arange(n + 1))  # links follow documents
            totals = [np.append(0, np.cumsum(v[at]))[edges] if len(at) else edges for v in (best, counts)]
            sums = [np.diff(edges), *[np.diff(t) for t in totals]]
            columns = [row["doc_ids"], x.n_a.tolist(), x.n_b.tolist(), n_groups.tolist(), *[s.tolist() for s in sums], [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]]
            for (name, _), values in zip(fields, columns, strict=True):
                out[name] += values
        return pa.table({name: pa.array(out[name], kind) for name, kind in fields})

    return chunks.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(again, RESULT)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of both tokenizers over every document."""
    session(spark)
    return align(load(spark, sf_dir, "documents").select("doc_id", "text"))
