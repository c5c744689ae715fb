"""The consumer: read after the checkpoint, call back, acknowledge, checkpoint.

One step is three DataFrame functions: :func:`read_input` picks the shards that
may be read and the records after their checkpoints, :func:`deliver` runs the
callbacks, :func:`settle` turns the outcome into checkpoints, retries, dead
letters and completed shards.  :func:`consume_once` chains them over tables;
:func:`consume` runs a step per micro-batch.
"""

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import UTC, datetime
from itertools import count
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import seq_order, wall_clock
from ..operators.acks import SHUTDOWN_DELAY_MS, checkpoints_from_acks, completed_shards
from ..operators.leases import (
    apply_checkpoints,
    close_shards,
    create_leases,
    lease_actions,
    renew_leases,
    take_leases,
)
from ..operators.lineage import ready_shards
from ..operators.messages import (
    DEFAULT_BATCH_SIZE,
    FAILED,
    OK,
    map_messages,
    micro_batches,
    route_batchers,
    split_failed,
    union_all,
    with_dropped,
    with_outcome,
)
from ..operators.resume import resume_read
from ..plans import cut_lineage, cuts_in, fits_broadcast, lookup_join
from ..schemas import LEASES
from ..sources.lease_store import LeaseStore
from ..sources.records import read_limited, read_table, read_unread
from ..sources.zones import index_zones, newest_records

# messages waiting for another attempt
PENDING = T.StructType(
    [
        T.StructField("app_name", T.StringType()),
        T.StructField("shard_id", T.StringType()),
        T.StructField("sequence_number", T.StringType()),
        T.StructField("partition_key", T.StringType()),
        T.StructField("data", T.StringType()),
        T.StructField("arrival_ts", T.TimestampNTZType()),
        T.StructField("attempt", T.LongType()),
    ]
)
# when each shard last had a message that was finished, or was first seen closed
LAST_OK = T.StructType(
    [
        T.StructField("app_name", T.StringType()),
        T.StructField("shard_id", T.StringType()),
        T.StructField("ack_ts", T.TimestampNTZType()),
    ]
)
# leases of other workers, as last seen: a count that stands still has been left behind
TRACKED = T.StructType(
    [
        T.StructField("app_name", T.StringType()),
        T.StructField("shard_id", T.StringType()),
        T.StructField("tracked_count", T.LongType()),
        T.StructField("counted_at_ms", T.LongType()),
    ]
)
_MESSAGE = ["app_name", "shard_id", "sequence_number"]
_INPUT = [f.name for f in PENDING.fields]


@dataclass(frozen=True)
class Handlers:
    """The user's side.

    ``on_message``: mapping of columns to expressions, or DataFrame -> DataFrame,
    applied to every message; ``batcher``: expression naming a message's batcher;
    ``on_batch``: DataFrame -> DataFrame over the messages with ``batcher``,
    ``batch_no`` and ``position`` (``map_batches`` calls a function per batch).
    Either marks a message as failed by ``status``.  ``on_failed`` is called once
    per step with the failed messages, when their outcome is written.  ``context``
    is passed to all of them as keyword arguments.
    """

    on_message: Callable[..., DataFrame] | Mapping[str, Column] | None = None
    on_batch: Callable[..., DataFrame] | None = None
    on_failed: Callable[..., None] | None = None
    batcher: Column | None = None
    batch_size: int | Mapping[str, int] = DEFAULT_BATCH_SIZE
    context: dict[str, Any] = field(default_factory=dict)


class ConsumeState(NamedTuple):
    """What a step leaves for the next one."""

    leases: DataFrame
    pending: DataFrame
    last_ok: DataFrame
    tracked: DataFrame | None = None

    @staticmethod
    def empty(spark: SparkSession) -> "ConsumeState":
        return ConsumeState(
            spark.createDataFrame([], LEASES),
            spark.createDataFrame([], PENDING),
            spark.createDataFrame([], LAST_OK),
            spark.createDataFrame([], TRACKED),
        )


class StepResult(NamedTuple):
    """``messages``: every message of the step with its outcome;
    ``dead_letters``: those given up; ``state``: for the next step."""

    messages: DataFrame
    dead_letters: DataFrame
    state: ConsumeState


def keep_leases(
    state: ConsumeState, app_name: str, worker: str, as_of: datetime, lease_expiry_ms: int
) -> ConsumeState:
    """Renew the worker's leases, take those of others whose count has stood
    still for longer than the expiry, and note the counts of the rest.  Many
    workers may share a lease table: what one of them does depends on counts
    alone, and a write holds only if the count is as expected."""
    now = int(as_of.timestamp() * 1000)
    key = ["app_name", "shard_id"]
    live = state.leases.where((F.col("app_name") == app_name) & ~F.col("completed"))
    seen = live.select(*key).join(state.tracked, key, "left")
    seen = seen.select(*key, F.lit(worker).alias("worker"), F.lit(now).alias("now_ms"), "tracked_count", "counted_at_ms")
    actions = cut_lineage(lease_actions(state.leases, seen, lease_expiry_ms))

    def requests(action: str) -> DataFrame:
        chosen = actions.where(F.col("action") == action)
        return chosen.select(*key, F.lit(0).cast("long").alias("request_seq"), "worker", "expected_count")

    leases = renew_leases(state.leases, requests("renew")).leases
    leases = cut_lineage(take_leases(leases, requests("take")).leases)
    others = leases.where((F.col("app_name") == app_name) & ~F.col("completed") & (F.col("lease_owner") != worker))
    stood = F.col("tracked_count").eqNullSafe(F.col("lease_count"))
    tracked = others.join(state.tracked, key, "left").select(
        *key,
        F.when(stood, F.col("counted_at_ms")).otherwise(F.lit(now)).alias("counted_at_ms"),
        F.col("lease_count").alias("tracked_count"),
    )
    rest = state.tracked.where(F.col("app_name") != app_name)
    return state._replace(leases=leases, tracked=cut_lineage(tracked.unionByName(rest)))


def held_leases(
    shards: DataFrame, leases: DataFrame, app_name: str, worker: str
) -> tuple[DataFrame, DataFrame]:
    """The lease table with a lease for every shard that starts and had none,
    and the leases the worker reads from now on."""
    starting = ready_shards(shards, leases, app_name).where(F.col("action") == "start")
    starting = cut_lineage(starting.select(F.lit(app_name).alias("app_name"), "shard_id"))
    requests = starting.join(leases, ["app_name", "shard_id"], "left_anti").select(
        "app_name",
        "shard_id",
        F.lit(0).cast("long").alias("request_seq"),
        F.lit(worker).alias("worker"),
    )
    leases = cut_lineage(create_leases(leases, requests).leases)
    mine = leases.where((F.col("lease_owner") == worker) & ~F.col("completed")).join(
        starting, ["app_name", "shard_id"], "left_semi"
    )
    return leases, mine


def read_input(
    records: DataFrame,
    mine: DataFrame,
    pending: DataFrame,
    app_name: str,
    limit: int | None = None,
    retry: bool = True,
) -> DataFrame:
    """Messages of this step: the pending ones of the leases held (unless
    ``retry`` is false), and up to ``limit`` new records per shard after its
    checkpoint.  A pending record after the checkpoint is not read a second time."""
    few_leases, few_pending = fits_broadcast(mine), fits_broadcast(pending)
    retries = pending.where(F.col("app_name") == app_name).withColumn(
        "attempt", F.col("attempt") + 1
    )
    held = mine.select("app_name", "shard_id")
    retries = lookup_join(
        retries,
        held,
        ["app_name", "shard_id"],
        "left_semi",
        salt_by=["sequence_number"],
        fits=few_leases,
    )
    new = lookup_join(
        resume_read(records, mine, app_name, few_leases),
        retries.select("shard_id", "sequence_number"),
        ["shard_id", "sequence_number"],
        "left_anti",
        fits=few_pending,
    )
    if limit is not None:
        new = read_limited(new, limit)
    new = new.withColumn("attempt", F.lit(0).cast("long"))
    new = new.select(*_INPUT)
    return retries.select(*_INPUT).unionByName(new) if retry else new


def input_bound(mine: DataFrame, pending: DataFrame, limit: int | None) -> int | None:
    """A bound on the messages of a step, where ``limit`` gives one."""
    return None if limit is None else limit * mine.count() + pending.count()


def deliver(messages: DataFrame, handlers: Handlers, total: int | None = None) -> DataFrame:
    """Run the callbacks.  A message that fails in ``on_message`` reaches no
    batch (``batcher``, ``batch_no`` and ``position`` are NULL).

    The outcome of ``on_message`` is read more than once, so it is written
    first: the callback runs once, and what it said of a message holds.  Statuses
    are as in :func:`with_outcome`; a message that a function drops has failed.
    ``total`` is a bound on their number, if known.
    """
    if callable(handlers.on_message):  # a function may leave rows out
        messages = cut_lineage(messages)
    mapped = map_messages(messages, handlers.on_message, **handlers.context)
    if callable(handlers.on_message):
        mapped = with_dropped(messages, cut_lineage(mapped), _MESSAGE)
    mapped = cut_lineage(mapped)
    good, bad = split_failed(mapped)
    batched = micro_batches(
        route_batchers(good, handlers.batcher), handlers.batch_size, total=total
    )
    if handlers.on_batch is not None:
        batched = cut_lineage(batched)
        left = cut_lineage(with_outcome(handlers.on_batch(batched, **handlers.context)))
        batched = with_dropped(batched, left, _MESSAGE)
    return union_all([batched, bad])


def _tell_failed(messages: DataFrame, handlers: Handlers) -> None:
    if handlers.on_failed is not None:
        handlers.on_failed(messages.where(F.col("status") == FAILED), **handlers.context)


def settle(
    messages: DataFrame,
    state: ConsumeState,
    shards: DataFrame,
    records: DataFrame,
    app_name: str,
    worker: str,
    as_of: datetime,
    max_attempts: int | None = None,
    shutdown_delay_ms: int = SHUTDOWN_DELAY_MS,
    newest: DataFrame | None = None,
) -> tuple[DataFrame, ConsumeState]:
    """Dead letters and the state after a step; ``newest`` as in :func:`completed_shards`.

    The checkpoint of a shard becomes its last finished message: one that
    succeeded or was given up.  It never goes back: a retry that is finished does
    not rewind a shard that is further on.
    """
    now = wall_clock(as_of)
    spent = F.lit(False) if max_attempts is None else F.col("attempt") + 1 >= max_attempts
    given_up = (F.col("status") == FAILED) & spent
    finished = messages.withColumn("status", F.when(given_up, OK).otherwise(F.col("status")))
    acks = finished.select(
        "app_name",
        "shard_id",
        F.lit(0).cast("long").alias("ack_id"),
        seq_order("sequence_number").alias("position"),
        "sequence_number",
        "status",
    )
    checkpoints = (
        checkpoints_from_acks(acks)
        .where(F.col("checkpoint").isNotNull())
        .select(
            "app_name",
            "shard_id",
            F.lit(0).cast("long").alias("request_seq"),
            F.lit(worker).alias("worker"),
            "checkpoint",
        )
    )
    leases = cut_lineage(apply_checkpoints(state.leases, checkpoints, monotonic=True).leases)

    failed = messages.where(F.col("status") == FAILED)
    dead = failed.where(spent)
    others = state.pending.join(
        messages.select("app_name", "shard_id", "sequence_number"),
        ["app_name", "shard_id", "sequence_number"],
        "left_anti",
    )
    pending = failed.where(~spent).select(*_INPUT).unionByName(others.select(*_INPUT))

    ok_now = (
        finished.where(F.col("status") == OK)
        .select("app_name", "shard_id")
        .distinct()
        .withColumn("ack_ts", now)
    )
    # a closed shard that never had such a message counts from when it was seen
    seen_closed = (
        shards.where(F.col("seq_end").isNotNull())
        .select(F.lit(app_name).alias("app_name"), "shard_id")
        .distinct()
        .join(leases.select("app_name", "shard_id"), ["app_name", "shard_id"], "left_semi")
        .join(state.last_ok, ["app_name", "shard_id"], "left_anti")
        .withColumn("ack_ts", now)
    )
    last_ok = (
        state.last_ok.unionByName(ok_now)
        .unionByName(seen_closed)
        .groupBy("app_name", "shard_id")
        .agg(F.max("ack_ts").alias("ack_ts"))
    )
    known = union_all(
        [
            pending.select(
                "app_name",
                "shard_id",
                "sequence_number",
                "attempt",
                F.lit(FAILED).alias("status"),
                F.lit(None).cast("timestamp_ntz").alias("ack_ts"),
            ),
            last_ok.select(
                "app_name",
                "shard_id",
                F.lit("").alias("sequence_number"),
                F.lit(0).cast("long").alias("attempt"),
                F.lit(OK).alias("status"),
                "ack_ts",
            ),
        ]
    )
    done = (
        completed_shards(shards, leases, records, known, app_name, now, shutdown_delay_ms, newest)
        .where("completed")
        .select(
            "app_name",
            "shard_id",
            F.lit(0).cast("long").alias("request_seq"),
            F.lit(worker).alias("worker"),
        )
    )
    leases = close_shards(leases, done).leases
    return dead, ConsumeState(leases, pending, last_ok, state.tracked)


def consume_once(
    records: DataFrame,
    shards: DataFrame,
    state: ConsumeState,
    app_name: str,
    worker: str,
    as_of: datetime,
    handlers: Handlers = Handlers(),
    limit: int | None = None,
    max_attempts: int | None = None,
    shutdown_delay_ms: int = SHUTDOWN_DELAY_MS,
    lease_expiry_ms: int | None = None,
) -> StepResult:
    """One step over tables; with ``lease_expiry_ms`` it begins by
    :func:`keep_leases`.  The messages are written to the checkpoint folder
    as soon as the callbacks return them, so that these run once and all results
    are of one run; so is the state, which the next step starts from."""
    if lease_expiry_ms is not None:
        state = keep_leases(state, app_name, worker, as_of, lease_expiry_ms)
    leases, mine = held_leases(shards, state.leases, app_name, worker)
    to_do = read_input(records, mine, state.pending, app_name, limit)
    total = input_bound(mine, state.pending, limit)
    messages = cut_lineage(deliver(to_do, handlers, total))
    _tell_failed(messages, handlers)
    dead, after = settle(
        messages,
        state._replace(leases=leases),
        shards,
        records,
        app_name,
        worker,
        as_of,
        max_attempts,
        shutdown_delay_ms,
    )
    cut = [None if table is None else cut_lineage(table) for table in after]
    return StepResult(messages, dead, ConsumeState(*cut))


def _write_step(table: DataFrame, path: str, n: int) -> None:
    """The first step of a micro-batch replaces all that is under its path."""
    if n == 0:
        step = table.withColumn("step", F.lit(0))
        step.write.mode("overwrite").partitionBy("step").parquet(path)
    else:
        table.write.mode("overwrite").parquet(f"{path}/step={n}")


def consume(
    spark: SparkSession,
    records_path: str,
    listing: Callable[[], DataFrame],
    state_path: str,
    output_path: str,
    app_name: str,
    worker: str,
    handlers: Handlers = Handlers(),
    limit: int | None = None,
    max_attempts: int | None = None,
    shutdown_delay_ms: int = SHUTDOWN_DELAY_MS,
    trigger: Mapping[str, Any] | None = None,
    max_files_per_trigger: int | None = None,
    clock: Callable[[], datetime] = lambda: datetime.now(UTC),
    stream_name: str | None = None,
    lease_expiry_ms: int | None = None,
) -> StreamingQuery:
    """Start a streaming query that consumes the table at ``records_path``
    (written by ``write_records``).  All paths are folders every executor sees.

    New files, or a tick where there are none, wake the consumer up; what it
    reads is decided by the lease checkpoints.  It then runs steps of at most
    ``limit`` new records per shard until nothing new can be read, so records
    held back by ``limit`` are not left over; waiting messages are retried, and
    quiet shards closed, once per wake-up.  Messages are written first, under the
    number of the micro-batch and the step, then dead letters, then the state: a
    repeated micro-batch starts from the state before it and replaces its own
    output.  ``listing`` gives the current shard listing, once per step; records
    and leases are of one stream, which ``stream_name`` picks from a listing of several.  With ``lease_expiry_ms``
    a wake-up renews the worker's leases and takes those left behind by others.
    """
    for name, value in (("app_name", app_name), ("worker", worker)):
        if not isinstance(value, str) or not value:
            raise ValueError(f"{name} must be a non-empty string")
    stores = ConsumeState(
        LeaseStore(spark, f"{state_path}/leases", LEASES),
        LeaseStore(spark, f"{state_path}/pending", PENDING, _MESSAGE),
        LeaseStore(spark, f"{state_path}/last_ok", LAST_OK),
        LeaseStore(spark, f"{state_path}/tracked", TRACKED),
    )

    def wake_up(_rows: DataFrame, batch_id: int) -> None:
        read = None
        for n in count():
            with cuts_in(f"{state_path}/work"):
                last, read = read, run_step(batch_id, n)
            # the same messages again: a lease that no longer can be written; the next wake-up tries anew
            if read[0] == 0 or read == last:
                break

    def run_step(batch_id: int, n: int) -> tuple:
        """One step; how many new messages it read, and a sum that tells them from others."""
        version = (batch_id, n)
        before = ConsumeState(*(s.read(before=version) for s in stores))
        shards = listing()
        if stream_name is not None:
            shards = shards.where(F.col("stream_name") == stream_name)
        now = clock()
        if lease_expiry_ms is not None and n == 0:
            before = keep_leases(before, app_name, worker, now, lease_expiry_ms)
        leases, mine = held_leases(shards, before.leases, app_name, worker)
        if n == 0:
            index_zones(spark, records_path)
        records = read_table(spark, records_path)
        unread = read_unread(spark, records_path, mine, app_name)
        to_do = read_input(unread, mine, before.pending, app_name, limit, retry=n == 0)
        total = input_bound(mine, before.pending, limit)
        messages = cut_lineage(deliver(to_do, handlers, total))
        _write_step(messages, f"{output_path}/messages/app={app_name}/batch={batch_id}", n)
        _tell_failed(messages, handlers)
        dead, after = settle(
            messages,
            before._replace(leases=leases),
            shards,
            records,
            app_name,
            worker,
            now,
            max_attempts,
            shutdown_delay_ms,
            newest_records(spark, records_path),
        )
        _write_step(dead, f"{output_path}/dead_letters/app={app_name}/batch={batch_id}", n)
        for store, table in zip(stores, after, strict=True):
            store.write(version, table)
        for store in stores:  # now that nothing is read from their state before the step
            store.compact()
        told = F.bit_xor(F.xxhash64("shard_id", "sequence_number"))
        return tuple(messages.where("attempt = 0").agg(F.count(F.lit(1)), told).first())

    reader = spark.readStream.schema(read_table(spark, records_path).schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (
        reader.parquet(records_path)
        .select("shard_id")
        .union(ticks.select(F.lit(None).cast("string")))
        .writeStream.queryName(f"consume-{app_name}")
        .option("checkpointLocation", f"{state_path}/query")
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .foreachBatch(wake_up)
        .start()
    )
