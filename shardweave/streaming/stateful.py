"""Streaming forms of the operators that keep something between micro-batches."""

from collections.abc import Iterator, Mapping
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..plans import ship
from ..schemas import LEASES
from ..sources.records import table_schema, with_pooled
from ..sources.zones import SHARD, shard_of

KEY = ["app_name", "shard_id"]


def stream_records(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
) -> DataFrame:
    """The table at ``path`` as a stream; the limits bound a micro-batch."""
    schema = spark.read.parquet(path).schema
    kept = "shard_id" in schema.fieldNames()
    reader = spark.readStream.schema(with_pooled(table_schema(spark, path)) if kept else schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    rows = reader.parquet(path)
    return rows.withColumn("shard_id", shard_of()).drop(SHARD) if kept else rows


def write_record_stream(
    records: DataFrame, path: str, checkpoint_location: str, trigger: Mapping[str, Any] | None = None
) -> StreamingQuery:
    """Write a stream of records like :func:`write_records`.  The file sink
    keeps its own log of complete files, so nothing else should write to
    ``path``."""
    return (
        records.withColumn("seq_len", F.length("sequence_number"))
        .writeStream.format("parquet")
        .partitionBy("shard_id")
        .option("path", path)
        .option("checkpointLocation", checkpoint_location)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def drop_redelivered_stream(records: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """One row per ``(shard_id, sequence_number)`` of a stream; a copy that
    arrives later than ``delay`` after the first may pass again."""
    timed = records.withColumn("arrival_ts", records["arrival_ts"].cast("timestamp"))
    return timed.withWatermark("arrival_ts", delay).dropDuplicatesWithinWatermark(
        ["shard_id", "sequence_number"]
    )


class _LeaseFold(StatefulProcessor):
    """Holds one lease and applies the commands of each micro-batch in order."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._lease = handle.getValueState(
            "lease", "lease_owner string, lease_count bigint, checkpoint string, completed boolean"
        )
        self._seq = handle.getValueState("seq", "seq bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        lease = self._lease.get() if self._lease.exists() else None
        commands = pd.concat(list(rows)).sort_values("seq")
        if self._seq.exists() and commands["seq"].iloc[0] <= self._seq.get()[0]:
            late = int(commands["seq"].iloc[0])
            raise ValueError(f"command {late} of {tuple(key)} came after command {self._seq.get()[0]}")
        self._seq.update((int(commands["seq"].iloc[-1]),))
        columns = ("op", "worker", "expected_count", "checkpoint")
        for op, worker, expected, checkpoint in zip(*(commands[c] for c in columns), strict=True):
            lease = _after(lease, op, worker, expected, checkpoint)
        if lease is not None:
            self._lease.update(tuple(lease))
            owner, count, checkpoint, completed = lease
            values = [(*key, checkpoint, owner, count, completed)]
            yield pd.DataFrame(values, columns=[f.name for f in LEASES.fields])

    def close(self) -> None:
        pass


def _after(lease, op, worker, expected, checkpoint):
    if lease is None:
        return (worker, 1, None, False) if op == "create" else None
    owner, count, mark, completed = lease
    counted = pd.isna(expected) or expected == count
    if op == "renew" and owner == worker and counted:
        count += 1
    elif op == "take" and owner != worker and counted:
        owner, count = worker, count + 1
    elif op == "checkpoint" and owner == worker:
        mark = checkpoint
    elif op == "close" and owner == worker:
        completed = True
    return owner, count, mark, completed


def fold_leases_stream(commands: DataFrame) -> DataFrame:
    """:func:`fold_leases` of a stream of commands: each micro-batch emits the
    new state of the leases it touches (output mode ``update``).  Commands of a
    lease have to arrive in order of ``seq`` from one micro-batch to the next; one
    that comes too late fails the query, since its lease would be wrong.  Needs the RocksDB state store provider."""
    ship(commands.sparkSession)
    return commands.groupBy(*KEY).transformWithStateInPandas(
        statefulProcessor=_LeaseFold(),
        outputStructType=LEASES,
        outputMode="Update",
        timeMode="None",
    )
