"""Incremental ingest over several batches, restarts and replays."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqloom.sources import manifest, storage
from seqloom.staging import new_path
from seqloom.streaming import ingest

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("seq", T.LongType())])


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA).coalesce(1)


def table(spark, path):
    return {r.k: (r.seq, r.batch) for r in ingest.read_ingested(spark, path, SCHEMA).collect()}


def test_first_write_wins_across_batches_and_restart(spark):
    source, path, progress = new_path(spark, "in"), new_path(spark, "out"), new_path(spark, "progress")
    frame(spark, ("a", 2), ("a", 1), ("b", 3), (None, 0)).write.parquet(source)
    run = lambda: ingest.start_ingest(
        ingest.file_stream(spark, source, SCHEMA, 1), path, progress, "k", "seq"
    ).awaitTermination()
    run()
    assert table(spark, path) == {"a": (1, 0), "b": (3, 0)}
    frame(spark, ("b", 0), ("c", 9)).write.mode("append").parquet(source)
    run()
    assert table(spark, path) == {"a": (1, 0), "b": (3, 0), "c": (9, 1)}


def test_replayed_batch_replaces_itself(spark):
    path = new_path(spark, "out")
    ingest.append_new(frame(spark, ("a", 1)), 0, path, "k", "seq")
    for _ in range(2):
        ingest.append_new(frame(spark, ("a", 5), ("b", 6)), 1, path, "k", "seq")
    assert table(spark, path) == {"a": (1, 0), "b": (6, 1)}


def test_a_new_checkpoint_or_second_stream_loses_nothing(spark):
    source, path = new_path(spark, "in"), new_path(spark, "out")
    frame(spark, ("a", 1), ("b", 2)).write.parquet(source)
    other = new_path(spark, "in")
    frame(spark, ("c", 3), ("a", 0)).write.parquet(other)
    for folder in (source, source, other):
        stream = ingest.file_stream(spark, folder, SCHEMA, 1)
        ingest.start_ingest(stream, path, new_path(spark, "progress"), "k", "seq").awaitTermination()
    assert {k: seq for k, (seq, _) in table(spark, path).items()} == {"a": 1, "b": 2, "c": 3}


def test_batch_order_comes_from_the_column(spark):
    path = new_path(spark, "out")
    ingest.append_new(frame(spark, ("a", 9), ("a", 4), ("a", 7)), 0, path, "k", "seq")
    assert table(spark, path) == {"a": (4, 0)}


def rows_of(spark, path):
    return sorted((r.k, r.seq) for r in ingest.read_ingested(spark, path, SCHEMA).collect())


def test_a_batch_of_new_keys_reads_no_stored_key(spark):
    """In 1,024 buckets; the stored rows are made unreadable, and only a known key needs them."""
    path = new_path(spark, "out")
    many = spark.range(5000).selectExpr("concat('k', id) AS k", "id AS seq")
    ingest.append_new(many, 0, path, "k", "seq", bucket_rows=5)
    (entry,) = manifest.latest(spark, path)[1]
    assert (entry["depth"], entry["rows"]) == (10, 5000)
    assert len(storage.names(spark, f"{path}/entry={entry['name']}")) > 900
    assert rows_of(spark, path) == sorted((f"k{i}", i) for i in range(5000))
    storage.delete(spark, f"{path}/entry={entry['name']}")
    ingest.append_new(frame(spark, ("new", 1), ("newer", 2)), 1, path, "k", "seq", bucket_rows=5)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        ingest.append_new(frame(spark, ("k7", 1)), 2, path, "k", "seq", bucket_rows=5)


def test_equal_fingerprints_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(ingest, "_fingerprint", lambda: F.lit(7))
    path = new_path(spark, "out")
    ingest.append_new(frame(spark, ("a", 1), ("b", 2)), 0, path, "k", "seq")
    ingest.append_new(frame(spark, ("b", 3), ("c", 4)), 1, path, "k", "seq")
    assert rows_of(spark, path) == [("a", 1), ("b", 2), ("c", 4)]


def test_streams_with_the_same_keys_at_one_time(spark):
    path = new_path(spark, "out")
    batches = [frame(spark, *[(f"k{j}", 100 * i + j) for j in range(i, i + 6)]) for i in range(5)]
    with ThreadPoolExecutor(5) as pool:
        list(pool.map(lambda i: ingest.append_new(batches[i], 0, path, "k", "seq", source=f"s{i}"), range(5)))
    got = ingest.read_ingested(spark, path, SCHEMA).collect()
    assert sorted(r.k for r in got) == [f"k{j}" for j in range(10)]
    assert all(r.seq == 100 * int(r.source[1:]) + int(r.k[1:]) for r in got)
    # a serial order: for any two streams, all keys that both brought are the same one's, or a third's
    order = [e["batches"] for e in manifest.latest(spark, path)[1]]
    seen = set()
    for source in (next(iter(b)) for b in order):
        i = int(source[1:])
        mine = {f"k{j}" for j in range(i, i + 6)} - seen
        assert {r.k for r in got if r.source == source} == mine
        seen |= mine


def test_a_crash_before_publishing_leaves_the_old_batch(spark, monkeypatch):
    path = new_path(spark, "out")
    ingest.append_new(frame(spark, ("a", 1)), 0, path, "k", "seq")
    monkeypatch.setattr(manifest, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError):
        ingest.append_new(frame(spark, ("a", 9), ("b", 9)), 0, path, "k", "seq")
    monkeypatch.undo()
    assert rows_of(spark, path) == [("a", 1)]
    ingest.append_new(frame(spark, ("a", 9), ("b", 9)), 0, path, "k", "seq")
    assert rows_of(spark, path) == [("a", 9), ("b", 9)]


def test_entries_of_one_size_are_merged_and_stay_committed(spark):
    path = new_path(spark, "out")
    for i in range(5):
        ingest.append_new(frame(spark, (f"k{i}", i), ("a", 10 - i)), i, path, "k", "seq")
        ingest.merge_entries(spark, path, SCHEMA, "k", fan=4, bucket_rows=2)
    live = manifest.latest(spark, path)[1]
    assert [(e["rows"], e["depth"], e["batches"]) for e in live] == [(5, 2, {"batch": [[0, 3]]}), (1, 0, {"batch": [[4, 4]]})]
    want = sorted([("a", 10), *[(f"k{i}", i) for i in range(5)]])
    assert rows_of(spark, path) == want
    ingest.append_new(frame(spark, ("x", 1)), 2, path, "k", "seq")  # committed
    ingest.append_new(frame(spark, ("a", 3), ("k1", 3)), 9, path, "k", "seq")  # known
    assert rows_of(spark, path) == want
    ingest.drop_old(spark, path, keep=1)
    assert rows_of(spark, path) == want
    assert len(storage.names(spark, path)) == 2 + len(manifest.latest(spark, path)[1])
