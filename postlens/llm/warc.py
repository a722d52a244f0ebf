"""WARC archives of pages and their index, merged from sorted runs.

``write_archives`` writes a record for every page, each a gzip member of its own, into one archive per task and ``ARCHIVE_BYTES``, and gives
the index entries of an archive as one run sorted by URL key and capture time. ``merge_runs`` deals the runs' rows by ranges of
(URL key, time) and merges, in each range, the slices of the runs with a loser tree; ranges follow one another, so the whole is the
capture history of every URL key in global order. Ranges are cut by key, time and page, so many captures of one
host or URL spread over several. ``read_archives`` opens the archives at the entries' places, in archive order, and parses records.

Of records with equal payloads (at least ``MIN_PAYLOAD`` bytes) that with the smallest page_id is a response, the others revisit it. Null
html is an empty payload, a null URL an empty one. Rows with equal id and payload have one role; null ids come last, and are
responses where no other row has the payload. Without a time column the capture time is derived from the page id. An empty table gives
no archive. Other columns of the pages are not read. Failed attempts leave archives that no index names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.shared import filesystem, load, materialize, ordered_id, packed, session, text_or_empty, unique_name, work_folder

MIN_PAYLOAD = 0
ARCHIVE_BYTES = 64 << 20
EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)
LAST_SECOND = 250_000_000_000  # capture times start again from there, within what dates can write
INDEX = "url_key string, captured_at string, page_id long, archive string, position long, size long"
ENTRY = pa.schema(
    [("url_key", pa.string()), ("captured_at", pa.string()), ("page_id", pa.int64()), ("archive", pa.string()), ("position", pa.int64()), ("size", pa.int64())]
)
SPLIT_URL = re.compile(r"\A[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)([^#]*)", re.S)


def url_key(url: str) -> str:
    """Host labels from the right, then path and query, so that a site's captures sort together."""
    found = SPLIT_URL.match(url)
    if not found:
        return url
    host, _, port = found[1].lower().rpartition("@")[2].partition(":")
    labels = host.removeprefix("www.").split(".")
    return ",".join(reversed(labels)) + (":" + port if port else "") + ")" + (found[2].lower() or "/")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(row: dict, payload: bytes, digest: str) -> bytes:
    """One WARC record. Line ends in a URL would break the header, so they are percent-encoded there."""
    uri = row["url"].replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    name = "none" if row["page_id"] is None else str(row["page_id"])
    revisit = row["refers_to"] is not None
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (b"" if revisit else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Date: {row['captured_at']}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{row['refers_to']}>",
            f"X-Payload-Length: {len(payload)}",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record at this place")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    body = rest[: int(fields["Content-Length"])]
    return fields, body.partition(b"\r\n\r\n")[2]


def roles(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """(r_id, r_digest, refers_to) of the rows that revisit; payloads travel as digests only."""
    html = text_or_empty("html")
    narrow = pages.filter(F.octet_length(html) >= min_payload).select(F.col("page_id").alias("r_id"), F.sha1(html).alias("r_digest"))
    first = narrow.groupBy("r_digest").agg(F.min("r_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").drop("n")
    again = narrow.distinct().join(first, "r_digest")
    return again.filter(F.col("refers_to").isNotNull() & ~F.col("r_id").eqNullSafe(F.col("refers_to")))


def write_archives(pages: DataFrame, folder: str, captured_at: str | None = None, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Write the archives; returns the stored index runs, one run an archive."""
    html = text_or_empty("html")
    seconds = F.col(captured_at).cast("timestamp").cast("long") if captured_at else F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(LAST_SECOND // 2)) + int(EPOCH.timestamp())
    told = roles(pages, min_payload)
    rows = pages.select("page_id", text_or_empty("url").alias("url"), html.alias("html"), seconds.alias("seconds"))
    rows = rows.join(told, rows["page_id"].eqNullSafe(told["r_id"]) & (F.sha1("html") == told["r_digest"]), "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, entries, at, name = None, [], 0, ""

        def run() -> pa.RecordBatch:
            entries.sort(key=lambda e: (e[0], e[1], e[2] is None, e[2] or 0, e[4]))
            return packed(dict(zip(ENTRY.names, zip(*entries, strict=True), strict=True)), ENTRY)

        for batch in batches:
            for row in batch.to_pylist():
                if sink is None:
                    name, at, entries = unique_name("capture", ".warc.gz"), 0, []
                    store, path = filesystem(f"{folder}/{name}")
                    store.create_dir(path.rpartition("/")[0], recursive=True)
                    sink = store.open_output_stream(path, compression=None)
                row["captured_at"] = (EPOCH + timedelta(seconds=(row["seconds"] or 0) % LAST_SECOND - EPOCH.timestamp())).strftime("%Y-%m-%dT%H:%M:%SZ")
                payload = row["html"].encode()
                member = gzip.compress(record(row, payload, digest_of(payload)), 6, mtime=0)
                sink.write(member)
                entries.append((url_key(row["url"]), row["captured_at"], row["page_id"], name, at, len(member)))
                at += len(member)
                if at >= ARCHIVE_BYTES:
                    sink.close()
                    sink = None
                    yield run()
        if sink is not None:
            sink.close()
            yield run()

    return materialize(rows.select("page_id", "url", "html", "seconds", "refers_to").mapInArrow(write, INDEX), "warc-runs")


class LoserTree:
    """k-way merge of sorted lists: each inner node keeps the loser of its match, so a step replays one path to the root."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.k, self.at = runs, max(1, len(runs)), [0] * len(runs)
        self.heads = [run[0] if run else None for run in runs]
        self.losers = [-1] * self.k
        self.winner = self.play(1) if runs else -1

    def beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and (x, a) <= (y, b))

    def play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self.play(2 * node), self.play(2 * node + 1)
        if not self.beats(a, b):
            a, b = b, a
        self.losers[node] = b
        return a

    def __iter__(self) -> Iterator[tuple]:
        while self.winner >= 0 and self.heads[self.winner] is not None:
            run = self.winner
            yield self.heads[run]
            self.at[run] += 1
            self.heads[run] = self.runs[run][self.at[run]] if self.at[run] < len(self.runs[run]) else None
            node = (run + self.k) >> 1
            while node:
                if self.beats(self.losers[node], run):
                    run, self.losers[node] = self.losers[node], run
                node >>= 1
            self.winner = run


def merge_runs(runs: DataFrame) -> DataFrame:
    """The index in global order of (url_key, captured_at, page_id); a range of it is what one task holds."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ENTRY.names), strict=True):
                slices.setdefault(row[3], []).append((row[0], row[1], row[2] is None, row[2] or 0, *row[3:]))
        for run in slices.values():
            run.sort()  # already in order but where the shuffle brought a run's blocks in another one
        held: list[tuple] = []
        for entry in LoserTree(list(slices.values())):
            held.append((entry[0], entry[1], None if entry[2] else entry[3], *entry[4:]))
            if len(held) == 10_000:
                yield packed(dict(zip(ENTRY.names, zip(*held, strict=True), strict=True)), ENTRY)
                held = []
        if held:
            yield packed(dict(zip(ENTRY.names, zip(*held, strict=True), strict=True)), ENTRY)

    return runs.repartitionByRange("url_key", "captured_at", ordered_id("page_id"), "archive", "position").mapInArrow(merge, INDEX)


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """The records that the index names: page_id, payload_bytes, payload_digest, record_type, refers_to, url, and the entry."""
    fields = [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())]
    out = pa.schema([*ENTRY, *fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, name = None, None
        for batch in batches:
            rows: dict = {f.name: [] for f in out}
            for entry in batch.to_pylist():
                if entry["archive"] != name:
                    if source:
                        source.close()
                    name = entry["archive"]
                    store, path = filesystem(f"{folder}/{name}")
                    source = store.open_input_file(path)
                head, payload = parse(gzip.GzipFile(fileobj=io.BytesIO(source.read_at(entry["size"], entry["position"]))).read())
                revisit, digest = head["WARC-Type"] == "revisit", head["WARC-Payload-Digest"].removeprefix("sha1:")
                if not revisit and digest_of(payload) != digest:
                    raise ValueError(f"{name} at {entry['position']}: the payload doesn't have its digest")
                page = head["WARC-Record-ID"][len("<urn:page:") : -1]
                entry |= {
                    "page_id": None if page == "none" else int(page),
                    "payload_bytes": int(head["X-Payload-Length"]) if revisit else len(payload),
                    "payload_digest": digest,
                    "record_type": head["WARC-Type"],
                    "refers_to": int(head["WARC-Refers-To"][len("<urn:page:") : -1]) if revisit else None,
                    "url": head["WARC-Target-URI"].replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
                }
                for column, values in rows.items():
                    values.append(entry[column])
            yield packed(rows, out)
        if source:
            source.close()

    order = index.repartitionByRange("archive", "position").sortWithinPartitions("archive", "position")
    return order.mapInArrow(read, INDEX + ", payload_bytes long, payload_digest string, record_type string, refers_to long, url string")


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages to archives, their merged index, and the records read back by it."""
    session(spark)
    folder = work_folder(spark, "warc")
    index = materialize(merge_runs(write_archives(load(spark, sf_dir, "pages"), folder)), "warc-index")
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at")
    return read_archives(index, folder).select(*columns)


SQL = f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
h AS (SELECT *, sha1(html) AS hex, octet_length(encode(html)) AS n FROM p),
m AS (SELECT hex, min(page_id) AS first FROM h WHERE n >= {MIN_PAYLOAD} GROUP BY hex),
b AS (SELECT h.*, first, list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + list_aggregate(list_transform(range(0, 5), lambda j: ((strpos('0123456789abcdef', substr(hex, 1 + (5 * i + j) // 4, 1)) - 1)
        >> (3 - (5 * i + j) % 4)) % 2 * (16 >> j)), 'sum')::INT, 1)), 'string_agg', '') AS b32 FROM h LEFT JOIN m USING (hex)),
k AS (SELECT *, coalesce(first IS NOT NULL AND page_id IS DISTINCT FROM first, false) AS again,
        lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)) AS host,
        lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^#]*)', 1)) AS rest FROM b)
SELECT page_id, n AS payload_bytes, b32 AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first END AS refers_to,
       array_to_string(list_reverse(string_split(CASE WHEN starts_with(host, 'www.') THEN substr(host, 5) ELSE host END, '.')), ',')
         || ')' || CASE WHEN rest = '' THEN '/' ELSE rest END AS url_key,
       strftime(TIMESTAMP '2024-01-01' + to_seconds(coalesce(page_id, 0)), '%Y-%m-%dT%H:%M:%SZ') AS captured_at FROM k
"""
