"""A store of the content hashes that a stream has kept, read by batch, not by history.

Hashes are dealt into buckets. Each finished batch is a run: its hashes by bucket, and a Bloom filter for each of its buckets. Runs are merged
``fan`` at a time, so that before batch n there are as many as n has digits' worth in base ``fan``; which ones follows from n alone, and a batch
that is run again after a failure writes the same runs again. A new batch reads the filters of the buckets it has hashes for, and of the
hashes only the buckets where a filter says that one may be there.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.session import materialize

BUCKETS = 256
FAN = 8
BITS, PROBES = 12, 6  # bits a hash and probes: about 0.4 % of new hashes are looked up in vain


def runs_before(batch: int, fan: int = FAN) -> list[tuple[int, int]]:
    """The merged runs [first, end) that cover the batches before this one, longest first."""
    out, start = [], 0
    while start < batch:
        size = 1
        while start + size * fan <= batch and start % (size * fan) == 0:
            size *= fan
        out.append((start, start + size))
        start += size
    return out


def merges_after(batch: int, fan: int = FAN) -> list[tuple[tuple[int, int], list[tuple[int, int]]]]:
    """(run, the runs it is made of) that become whole with this batch, shortest first."""
    out, size = [], fan
    while (batch + 1) % size == 0:
        first = batch + 1 - size
        out.append(((first, batch + 1), [(i, i + size // fan) for i in range(first, batch + 1, size // fan)]))
        size *= fan
    return out


def _probes(hashes: pd.Series, bits: int) -> np.ndarray:
    a = np.array([int(h[:15], 16) for h in hashes], dtype=np.uint64)
    b = np.array([int(h[15:30], 16) | 1 for h in hashes], dtype=np.uint64)
    return ((a[:, None] + np.arange(PROBES, dtype=np.uint64) * b[:, None]) % np.uint64(bits)).astype(np.int64)


def _filter(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """A bucket's Bloom filter, sized by its hashes."""
    bits = max(64, BITS * len(group))
    table = np.zeros(bits, dtype=np.uint8)
    table[_probes(group["content_hash"], bits).ravel()] = 1
    return pd.DataFrame({"bucket": [key[0]], "size": [bits], "bits": [np.packbits(table).tobytes()]})


def _suspected(key: tuple, hashes: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    """(run, content_hash) of a bucket where the run's filter doesn't exclude the hash."""
    out = []
    if len(hashes):
        for run, size, bits in zip(filters["run"], filters["size"], filters["bits"]):
            table = np.unpackbits(np.frombuffer(bits, np.uint8), count=size)
            hit = table[_probes(hashes["content_hash"], size)].all(axis=1)
            out += [(key[0], run, h) for h in hashes["content_hash"][hit]]
    return pd.DataFrame(out, columns=["bucket", "run", "content_hash"]).astype({"bucket": "int32"})


class SeenHashes:
    """The store under a folder of the shared storage."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, fan: int = FAN):
        self.spark, self.path, self.buckets, self.fan = spark, path, buckets, fan

    def with_bucket(self, hashes: DataFrame) -> DataFrame:
        """Hashes are hexadecimal; the last eight digits choose the bucket."""
        return hashes.withColumn("bucket", (F.conv(F.right("content_hash", F.lit(8)), 16, 10).cast("long") % self.buckets).cast("int"))

    def _folder(self, kind: str, run: tuple[int, int]) -> str:
        return f"{self.path}/{kind}/run={run[0]}-{run[1]}"

    def _read(self, kind: str, runs: list[tuple[int, int]], schema: str) -> DataFrame:
        read = self.spark.read.schema(f"{schema}, run string, bucket int").option("basePath", f"{self.path}/{kind}")
        return read.parquet(*[self._folder(kind, r) for r in runs])

    def unseen(self, hashes: DataFrame, batch: int) -> DataFrame:
        """The distinct hashes (column content_hash) that no batch before this one has."""
        asked = materialize(self.with_bucket(hashes.select("content_hash").distinct()), "asked-hashes")
        runs = runs_before(batch, self.fan)
        if not runs:
            return asked.select("content_hash")
        met = [r.bucket for r in asked.select("bucket").distinct().collect()]  # at most as many as there are buckets
        filters = self._read("filters", runs, "size int, bits binary").where(F.col("bucket").isin(met))
        found = asked.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(_suspected, "bucket int, run string, content_hash string")
        suspects = materialize(found, "suspected-hashes")
        places = [(r.run, r.bucket) for r in suspects.select("run", "bucket").distinct().collect()]  # at most buckets times runs
        if not places:
            return asked.select("content_hash")
        stored = self._read("hashes", [r for r in runs if any(p[0] == f"{r[0]}-{r[1]}" for p in places)], "content_hash string")
        by_run: dict[str, list[int]] = {}
        for run, bucket in places:
            by_run.setdefault(run, []).append(bucket)
        where = F.lit(False)
        for run, some in sorted(by_run.items()):
            where = where | ((F.col("run") == run) & F.col("bucket").isin(sorted(some)))
        seen = suspects.select("content_hash").join(stored.where(where).select("content_hash"), "content_hash", "left_semi")
        return asked.select("content_hash").join(seen, "content_hash", "left_anti")

    def add(self, hashes: DataFrame, batch: int) -> None:
        """Store a batch's new hashes and the merged runs that become whole with it; a repeated call writes the same again."""
        self._write(self.with_bucket(hashes.select("content_hash").distinct()), (batch, batch + 1))
        for run, parts in merges_after(batch, self.fan):
            self._write(self._read("hashes", parts, "content_hash string").select("content_hash", "bucket"), run)

    def _write(self, hashes: DataFrame, run: tuple[int, int]) -> None:
        folder = self._folder("hashes", run)
        hashes.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
        stored = self.spark.read.schema("content_hash string, bucket int").parquet(folder)
        filters = stored.groupBy("bucket").applyInPandas(_filter, "bucket int, size int, bits binary")
        filters.write.mode("overwrite").partitionBy("bucket").parquet(self._folder("filters", run))
