"""Files that a read from checkpoints opens."""

from datetime import datetime

from conftest import seq, shard_id
from pyspark.sql import functions as F

from shardweave.operators import resume_read
from shardweave.schemas import LEASES, RECORDS
from shardweave.sources import (
    index_zones,
    newest_records,
    read_shards,
    read_table,
    read_unread,
    read_zones,
    unread_files,
    write_records,
)
from shardweave.sources import records as records_module
from shardweave.streaming import stream_records

NOW = datetime(2024, 1, 1)


def write(spark, path, numbers, shards):
    rows = [("s", name, seq(n), str(n), str(n), NOW) for name in shards for n in numbers]
    write_records(spark.createDataFrame(rows, RECORDS), path)


def test_only_files_that_can_hold_unread_records_are_read(spark, tmp_path, rows):
    path = str(tmp_path / "records")
    shards = [shard_id(k) for k in range(6)] + ["a b%c:d"]
    for first in (0, 100, 200):  # a file per shard each
        write(spark, path, range(first, first + 100), shards)
    assert index_zones(spark, path) == 21 and index_zones(spark, path) == 0
    # one shard is read on from the start, the others from 99 % on, at their end or not at all
    marks = [None, seq(198), seq(297), seq(299), seq(500)]
    held = [("a", shard_id(k), m, "w", 1, False) for k, m in enumerate(marks)] + [("a", "a b%c:d", seq(99), "w", 1, False)]
    leases = spark.createDataFrame([*held, ("b", shard_id(5), None, "w", 1, False)], LEASES)
    df = read_unread(spark, path, leases, "a")
    zones = {(r.shard_id, int(r.least.seq[-4:]) // 100): r.file for r in read_zones(spark, path).collect()}
    wanted = {(shard_id(0), 0), (shard_id(0), 1), (shard_id(0), 2), (shard_id(1), 1), (shard_id(1), 2), (shard_id(2), 2), ("a b%c:d", 1), ("a b%c:d", 2)}
    assert set(df.inputFiles()) == {zones[k] for k in wanted}
    whole = resume_read(read_table(spark, path), leases, "a")
    assert rows(resume_read(df, leases, "a"), "shard_id", "sequence_number") == rows(whole, "shard_id", "sequence_number")


def test_a_map_that_is_behind_loses_nothing(spark, tmp_path, rows):
    path = str(tmp_path / "records")
    write(spark, path, range(10), [shard_id(0)])
    leases = spark.createDataFrame([("a", shard_id(0), seq(9), "w", 1, False), ("a", shard_id(1), None, "w", 1, False)], LEASES)
    assert len(unread_files(spark, path, leases, "a")) == 1  # not known yet, so it is read
    index_zones(spark, path)
    assert unread_files(spark, path, leases, "a") == [] and read_unread(spark, path, leases, "a").count() == 0
    write(spark, path, range(10, 12), [shard_id(0), shard_id(1)])
    unread = resume_read(read_unread(spark, path, leases, "a"), leases, "a")
    assert rows(unread, "shard_id", "data") == [(shard_id(k), str(n)) for k in (0, 1) for n in (10, 11)]
    assert rows(newest_records(spark, path)) == [(shard_id(0), seq(11)), (shard_id(1), seq(11))]
    index_zones(spark, path)
    assert rows(newest_records(spark, path)) == [(shard_id(0), seq(11)), (shard_id(1), seq(11))]
    # rows of the table alone, whatever lies beside them
    assert read_table(spark, path).count() == 14


def test_many_shards_share_files(spark, tmp_path, rows, monkeypatch):
    path, shards = str(tmp_path / "records"), [shard_id(k) for k in range(30)] + ["a b%c:d", "__pooled__"]
    write(spark, path, range(3), shards[-3:])  # few shards: a folder each
    monkeypatch.setattr(records_module, "MAX_FOLDERS", 10)
    write(spark, path, range(3, 13), [*shards, "", None])
    table = read_table(spark, path)
    assert len(table.inputFiles()) < 20  # not one for each shard
    want = [(s, seq(n)) for s in shards for n in range(13) if n > 2 or s in shards[-3:]]
    nulls = [(None, seq(n)) for n in range(3, 13)] * 2
    cols = ("shard_id", "sequence_number")
    assert rows(table, *cols) == sorted(want + nulls, key=repr)
    assert {s for s, _ in rows(table.where(F.col("shard_id") == shard_id(4)), *cols)} == {shard_id(4)}
    stream = stream_records(spark, path).select(*cols).writeStream.format("memory").queryName("common_files")
    stream.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert rows(spark.table("common_files")) == sorted(want + nulls, key=repr)

    marks = [("a", s, seq(k % 13) if k % 3 else None, "w", 1, False) for k, s in enumerate(shards[2:])]
    leases = spark.createDataFrame(marks, LEASES)
    whole = rows(resume_read(table, leases, "a"), *cols)
    for _ in range(2):  # without and with a zone map
        assert rows(resume_read(read_unread(spark, path, leases, "a"), leases, "a"), *cols) == whole
        assert rows(newest_records(spark, path).where("shard_id is not null")) == sorted(((s, seq(12)) for s in shards), key=repr)
        index_zones(spark, path)
    ends = spark.createDataFrame([("a", s, seq(12), "w", 1, False) for s in shards], LEASES)
    assert unread_files(spark, path, ends, "a") == []
    found = read_shards(spark, path, {s: q for _, s, q, *_ in marks if q}, limit=4)
    after = {s: int(q[-4:]) if q else -1 for _, s, q, *_ in marks}
    first = [(s, seq(n)) for s in shards for n in [m for x, m in ((x, int(q[-4:])) for x, q in want) if x == s and m > after.get(s, -1)][:4]]
    assert rows(found, *cols) == sorted(first, key=repr)
    assert rows(read_shards(spark, path), *cols) == sorted(want, key=repr)
