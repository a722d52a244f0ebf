"""The store of seen hashes, the raw table, and the quarantine of records that don't fit."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from postlens import schema
from postlens.plans import cycle
from postlens.sources import payloads, quarantine, store
from postlens.streaming.seen import SeenHashes, merges_after, runs_before


@pytest.mark.parametrize("fan", [2, 3, 8])
def test_runs_cover_all_batches_before(fan):
    stored = set()
    for batch in range(200):
        runs = runs_before(batch, fan)
        assert set(runs) <= stored
        assert [r[0] for r in runs] == [0, *[r[1] for r in runs]][: len(runs)] and (runs[-1][1] if runs else 0) == batch
        assert len(runs) <= fan * 8
        stored.add((batch, batch + 1))
        for run, parts in merges_after(batch, fan):
            assert set(parts) <= stored and parts[0][0] == run[0] and parts[-1][1] == run[1]
            stored.add(run)


def hashes(spark, numbers):
    return spark.createDataFrame([(i,) for i in numbers], "i long").select(F.md5(F.col("i").cast("string")).alias("content_hash"))


def test_seen_hashes_over_batches(spark, tmp_path, monkeypatch):
    """Right over batches and repeats; what a batch reads follows its own buckets, not the history."""
    store = SeenHashes(spark, str(tmp_path / "seen"), buckets=8, fan=2)
    read, kept = [], set()
    plain = SeenHashes._read

    def counted(self, kind, runs, schema):
        frame = plain(self, kind, runs, schema)
        read.append((kind, frame))
        return frame

    monkeypatch.setattr(SeenHashes, "_read", counted)
    batches = [range(0, 40), range(20, 60), range(0, 0), range(55, 90), range(200, 203)]
    for n, numbers in enumerate(batches):
        for _ in range(2 if n == 1 else 1):  # a batch that is run again
            fresh = {r[0] for r in store.unseen(hashes(spark, [*numbers, *list(numbers)[:3]]), n).collect()}
            assert fresh == {r[0] for r in hashes(spark, [i for i in numbers if i not in kept]).collect()}
            store.add(store.unseen(hashes(spark, numbers), n), n)
        kept |= set(numbers)
    read.clear()
    new = {r[0] for r in store.unseen(hashes(spark, [999]), 5).collect()}
    assert len(new) == 1 and not [k for k, _ in read if k == "hashes"]  # the filters exclude it: no hashes are read
    assert store.unseen(hashes(spark, [7]), 5).count() == 0
    files = {f for k, frame in read if k == "hashes" for f in frame.inputFiles()}
    assert files and len(runs_before(5, 2)) == 2


GOOD = {"id": "a", "title": "t", "selftext": "body", "score": 3, "created_utc": 1700000000, "permalink": "/r/x"}


def test_records_that_do_not_fit_are_kept_apart(spark, tmp_path):
    folder = tmp_path / "reddit"
    folder.mkdir()
    lines = [json.dumps(GOOD), "", json.dumps(GOOD | {"id": "b", "score": "many"}), '{"id": "c", "title": ', "null", "17", json.dumps([GOOD | {"id": "d"}, GOOD | {"id": "e", "comments": 5}])]
    (folder / "1.json").write_text("\n".join(lines))
    (folder / "2.json").write_text(json.dumps(GOOD | {"id": "f"}) + "\n" + json.dumps(GOOD | {"id": "g"})[:40])
    posts = payloads.read_reddit(spark, str(folder), "2024-01-01T00:00:00")
    assert sorted(r.post_id for r in posts.collect()) == ["a", "d", "f"]
    assert posts.select("title").distinct().count() == 1 and posts.count() == 3  # also where few columns are read
    bad = quarantine.quarantine(spark, str(folder), payloads.REDDIT, "reddit").collect()
    assert sorted((r.file[-6:], r.reason) for r in bad) == [("1.json", "malformed"), ("1.json", "no object"), ("1.json", "no object"), ("1.json", "wrong type"), ("1.json", "wrong type"), ("2.json", "malformed")]
    assert all(r.source == "reddit" and r.record for r in bad) and len({r.ingest_seq for r in bad}) == 6


def test_a_failing_source_does_not_end_the_others(spark, tmp_path):
    folder = tmp_path / "ok"
    folder.mkdir()
    (folder / "1.json").write_text(json.dumps(GOOD))
    said = []
    broken = lambda: spark.range(3).select(F.raise_error(F.lit("unreadable block")).alias("x"))  # noqa: E731  fails in the job, not before
    frames = quarantine.collect_sources({"gone": lambda: spark.read.text(str(tmp_path / "none")), "broken": broken, "reddit": lambda: payloads.read_reddit(spark, str(folder), "2024-01-01T00:00:00")}, said.append)
    assert [f.count() for f in frames] == [1] and len(said) == 2


def raw_rows(spark, numbers):
    items = spark.range(numbers.start, numbers.stop, 1, 3).select(F.concat(F.lit("text "), "id").alias("content"), "id")
    return store.raw_envelope(items, F.when(F.col("id") % 3 == 0, "a").otherwise("b"), F.lit("posts"), "2024-01-01T00:00:00")


def test_raw_ids_over_batches_and_retries(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "raw")

    def stored():
        return {r.content: r.id for r in store.read_raw(spark, path).collect()}

    store.save_raw(raw_rows(spark, range(0, 20)), path, 0)
    store.save_raw(raw_rows(spark, range(20, 45)), path, 1)
    before = stored()
    store.save_raw(raw_rows(spark, range(20, 45)), path, 1)  # a retry: the same rows, the same ids
    assert stored() == before
    store.save_raw(raw_rows(spark, range(45, 50)), path, 2)
    store.save_raw(raw_rows(spark, range(50, 50)), path, 3)
    whole = stored()
    assert len(whole) == 50 == len(set(whole.values())) and before.items() <= whole.items()
    store.save_raw(raw_rows(spark, range(0, 20)).unionByName(raw_rows(spark, range(60, 90))), path, 0)  # more rows than its range has ids
    grown = stored()
    assert len(grown) == 80 == len(set(grown.values())) == store.read_raw(spark, path).count()
    assert set(store.read_raw(spark, path).columns) == {c.split()[0] for c in schema.RAW.split(", ")}
    newest = [r.id for r in store.load_raw(store.read_raw(spark, path), "b", 7).collect()]
    assert newest == sorted(r.id for r in store.read_raw(spark, path).where("source = 'b'").collect())[:7]


def test_a_writer_that_fails_leaves_no_id_twice(spark, tmp_path):
    path = str(tmp_path / "raw")
    taken = store._first_id(spark, path, 0, 10)  # the range is recorded, the rows are not written
    store.save_raw(raw_rows(spark, range(0, 4)), path, 1)
    store.save_raw(raw_rows(spark, range(4, 8)), path, 0)
    ids = [r.id for r in store.read_raw(spark, path).collect()]
    assert taken == 1 and len(ids) == 8 == len(set(ids))


def test_cycle_saves_raw_rows(spark, tmp_path):
    now = dt.datetime(2024, 1, 2)
    rows = [(i, f"title {i}", f"some words of text number {i % 4}", f"s{i % 2}" if i else None, "2024-01-01T10:00:00") for i in range(9)]
    posts = schema.conform(spark.createDataFrame(rows, "ingest_seq long, title string, content string, source string, date string"))
    path = str(tmp_path / "raw")
    for _ in range(2):
        cycle.run_cycle(posts, now, near=False, raw_path=path)
    raw = store.read_raw(spark, path).collect()
    assert len(raw) == 9 == len({r.id for r in raw})  # copies too, and once though the cycle ran twice
    assert {r.source for r in raw} == {"s0", "s1", "Unknown"} and json.loads(raw[0].metadata)["title"].startswith("title")
