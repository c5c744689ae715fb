"""Registered queries: name -> function of (spark, sf_dir)."""

from collections.abc import Callable
from datetime import datetime, timedelta
from uuid import uuid4

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from .. import sources as src
from ..plans import cut_lineage
from ..plans.lineage_cut import checkpoint_dir
from ..streaming import (
    ConsumeState,
    Handlers,
    consume_once,
    deliver,
    held_leases,
    input_bound,
    read_input,
)
from .inputs import SLICE_ROWS, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LIMIT = 100
AFTER_SEQ = "49606519" + "500".rjust(48, "0")
AS_OF = datetime(2024, 1, 30, 12)
RECORD = ["shard_id", "sequence_number", "partition_key", "data", "arrival_ts"]


def query(fn: Callable) -> Callable:
    """Register ``fn(t)``, where ``t(name)`` is an input or given table."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(lambda name: table(spark, sf_dir, name))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


# --- the flagship -----------------------------------------------------------


@query
def next_batches(t) -> DataFrame:
    """For app-a: the next 100 records per shard after its checkpoint, as
    messages in batches of 40, and the checkpoint of each batch if all goes well."""
    unread = op.resume_read(t("records"), t("leases"), "app-a")
    msgs = op.wrap_messages(src.read_limited(unread, LIMIT))
    flat = msgs.select("data", "metadata.*")
    batched = op.micro_batches(op.route_batchers(flat), 40)
    acks = batched.select(
        "app_name",
        "shard_id",
        F.col("batch_no").alias("ack_id"),
        "position",
        "sequence_number",
        F.lit("ok").alias("status"),
    )
    return op.checkpoints_from_acks(acks)


# --- sources ----------------------------------------------------------------


@query
def encode_records(t) -> DataFrame:
    customer = t("customer")
    coded = src.encode_records(customer, "c_custkey")
    return coded.select(
        "partition_key", F.from_json("data", customer.schema).alias("row")
    ).select("partition_key", "row.*")


@query
def encode_payload(t) -> DataFrame:
    """The payload itself, with fields that are NULL."""
    rows = t("customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("c_mktsegment")
    )
    return src.encode_records(rows, "c_custkey")


@query
def write_records(t) -> DataFrame:
    """Records written as a table kept per shard, and read back."""
    records = t("user_records")
    path = f"{checkpoint_dir(records.sparkSession)}/records-{uuid4().hex}"
    src.write_records(records, path)
    return src.read_table(records.sparkSession, path).select(*RECORD)


def _pages(t) -> DataFrame:
    """The listing's pages.  One shuffle by stream, with as many parts as the rows
    ask for, serves the pages, their ends and the shards: adaptive execution would
    pack these rows, which compress well, into parts that are large in memory."""
    entries = t("page_entries")
    parts = max(-(-2 * t("events").count() // SLICE_ROWS), entries.sparkSession.sparkContext.defaultParallelism)
    entry = F.struct(
        F.col("shard_id").alias("ShardId"),
        F.col("parent_shard_id").alias("ParentShardId"),
        F.col("adjacent_parent_shard_id").alias("AdjacentParentShardId"),
        F.struct(
            F.col("hash_start").alias("StartingHashKey"), F.col("hash_end").alias("EndingHashKey")
        ).alias("HashKeyRange"),
        F.struct(
            F.col("seq_start").alias("StartingSequenceNumber"),
            F.col("seq_end").alias("EndingSequenceNumber"),
        ).alias("SequenceNumberRange"),
    )
    return (
        entries.repartition(parts, "stream_name")
        .groupBy("stream_name", "page_no", "stream_status", "has_more")
        .agg(F.array_sort(F.collect_list(entry)).alias("shards"))
    )


@query
def shard_listing(t) -> DataFrame:
    return src.shard_listing(_pages(t))


@query
def shard_listing_active(t) -> DataFrame:
    return src.shard_listing(_pages(t), active_only=True)


@query
def active_streams(t) -> DataFrame:
    return src.active_streams(_pages(t))


@query
def read_trim_horizon(t) -> DataFrame:
    return src.read_records(t("records"), "trim_horizon").select(*RECORD)


@query
def read_after_sequence(t) -> DataFrame:
    return src.read_records(t("records"), "after_sequence_number", AFTER_SEQ).select(*RECORD)


@query
def read_at_sequence(t) -> DataFrame:
    return src.read_records(t("records"), "at_sequence_number", AFTER_SEQ).select(*RECORD)


def _stored(t, name: str) -> str:
    """An input as a table kept per shard."""
    records = t(name)
    path = f"{checkpoint_dir(records.sparkSession)}/records-{uuid4().hex}"
    src.write_records(records, path)
    return path


@query
def read_latest(t) -> DataFrame:
    """What is written after a reader began at the end of the first 70 records of
    each shard; the zone map tells where the shards ended."""
    records = t("records")
    spark = records.sparkSession
    path = f"{checkpoint_dir(spark)}/records-{uuid4().hex}"
    numbered = op.micro_batches(op.route_batchers(records), 70)
    src.write_records(numbered.where("batch_no = 0").select(*RECORD), path)
    src.index_zones(spark, path)
    newest = cut_lineage(src.newest_records(spark, path))
    src.write_records(numbered.where("batch_no > 0").select(*RECORD), path)
    return src.read_records(src.read_table(spark, path), "latest", newest=newest).select(*RECORD)


@query
def read_limited(t) -> DataFrame:
    return src.read_limited(t("records"), LIMIT).select(*RECORD)


@query
def read_limited_large(t) -> DataFrame:
    """A limit beyond what Spark ranks per map task."""
    return src.read_limited(t("records"), 2_000).select("shard_id", "sequence_number")


@query
def read_source(t) -> DataFrame:
    """The next 100 records of each shard after the checkpoints of app-a, through
    the data source."""
    leases = t("leases").where("app_name = 'app-a' AND checkpoint IS NOT NULL")
    after = {r.shard_id: r.checkpoint for r in leases.collect()}
    return src.read_shards(leases.sparkSession, _stored(t, "records"), after, LIMIT).select(*RECORD)


@query
def poll_pacing(t) -> DataFrame:
    read = src.read_limited(t("user_records"), 70)
    return src.poll_pacing(read, t("user_shards"), 70)


@query
def lease_lookup(t) -> DataFrame:
    keys = t("requests").select("app_name", "shard_id", "request_seq")
    return src.lease_lookup(t("user_leases"), keys)


@query
def lookup_salted(t) -> DataFrame:
    """The lookup where the leases are too many to broadcast: both sides are
    shuffled, and adaptive execution splits what is skewed."""
    keys = t("requests").select("app_name", "shard_id", "request_seq")
    return src.lease_lookup(t("user_leases").hint("merge"), keys)


@query
def route_to_shard(t) -> DataFrame:
    records = t("records").select("stream_name", "partition_key", "sequence_number")
    return src.route_to_shard(records, t("shards")).select(
        "sequence_number", "hash_key", "shard_id"
    )


@query
def route_streams(t) -> DataFrame:
    """Events routed over the open shards of the stream they belong to."""
    listing = t("listing")
    records = t("events").select(
        F.format_string("stream-%09d", F.floor(F.col("event_id") / 16)).alias("stream_name"),
        F.col("user_id").cast("string").alias("partition_key"),
        "event_id",
    )
    return src.route_to_shard(records, listing).select("event_id", "stream_name", "shard_id")


# --- messages ---------------------------------------------------------------


@query
def wrap_messages(t) -> DataFrame:
    msgs = op.wrap_messages(t("records").select(*RECORD))
    return msgs.select("data", "metadata.*")


def _mark_errors(msgs: DataFrame) -> DataFrame:
    bad = F.col("data").endswith("|error")
    return op.map_messages(
        msgs,
        {
            "status": F.when(bad, "failed").otherwise("ok"),
            "error": F.when(bad, F.concat(F.lit("bad record "), F.col("data"))),
        },
    )


@query
def map_messages(t) -> DataFrame:
    return _mark_errors(t("records")).select("sequence_number", "status", "error")


@query
def map_messages_pandas(t) -> DataFrame:
    """The same callback as a function of pandas frames with a context."""

    def callback(frame: pd.DataFrame, ending: str) -> pd.DataFrame:
        bad = frame["data"].str.endswith(ending)
        error = ("bad record " + frame["data"]).where(bad, None)
        return frame[["sequence_number"]].assign(
            status=bad.map({True: "failed", False: "ok"}), error=error
        )

    return op.map_messages(
        t("records").select("sequence_number", "data"),
        pandas_fn=callback,
        schema="sequence_number string, status string, error string",
        ending="|error",
    )


@query
def dead_letters(t) -> DataFrame:
    _, bad = op.split_failed(_mark_errors(t("records")))
    return bad.select("shard_id", "sequence_number", "error")


_SIZES = {"orders": 10, "default": 20}


def _rule() -> Column:
    return F.when(F.col("data").endswith("|purchase"), "orders")


def _batched(t) -> DataFrame:
    return op.micro_batches(op.route_batchers(t("records"), _rule()), _SIZES)


@query
def route_batchers(t) -> DataFrame:
    return (
        op.route_batchers(t("records"), _rule())
        .groupBy("shard_id", "batcher")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def micro_batches(t) -> DataFrame:
    return _batched(t).select("shard_id", "batcher", "batch_no", "position", "sequence_number")


@query
def micro_batches_sliced(t) -> DataFrame:
    """The same batches numbered slice by slice."""
    batched = op.micro_batches(op.route_batchers(t("records"), _rule()), _SIZES, slice_rows=50)
    return batched.select("shard_id", "batcher", "batch_no", "position", "sequence_number")


@query
def map_batches(t) -> DataFrame:
    def summarise(batch: pd.DataFrame, label: str) -> pd.DataFrame:
        seqs, first = batch["sequence_number"], batch.iloc[0]
        row = (first["shard_id"], first["batcher"], first["batch_no"], label, len(batch))
        return pd.DataFrame(
            [(*row, seqs.iloc[0], seqs.iloc[-1], batch["partition_key"].nunique())],
            columns="shard_id batcher batch_no label n first_seq last_seq n_keys".split(),
        )

    cols = ["shard_id", "batcher", "batch_no", "position", "sequence_number", "partition_key"]
    return op.map_batches(
        _batched(t).select(*cols),
        summarise,
        "shard_id string, batcher string, batch_no long, label string, n long, "
        "first_seq string, last_seq string, n_keys long",
        label="batch",
    )


@query
def partition_by(t) -> DataFrame:
    return op.partition_by(t("records"), "partition_key", 7).select(
        "partition_key", "sequence_number", "processor", "processor_pos"
    )


@query
def partition_by_sliced(t) -> DataFrame:
    return op.partition_by(t("records"), "partition_key", 7, slice_rows=50).select(
        "partition_key", "sequence_number", "processor", "processor_pos"
    )


# --- reading on -------------------------------------------------------------


@query
def resume_read(t) -> DataFrame:
    return op.resume_read(t("records"), t("leases"), "app-a").select("app_name", *RECORD)


@query
def resume_read_shuffled(t) -> DataFrame:
    unread = op.resume_read(t("records"), t("leases"), "app-a", fits=False)
    return unread.select("app_name", *RECORD)


@query
def resume_read_zones(t) -> DataFrame:
    """Every shard read on from its own checkpoint: of a table with a zone map only
    files that reach beyond it are opened."""
    path = _stored(t, "user_records")
    leases = t("user_leases")
    src.index_zones(leases.sparkSession, path)
    unread = src.read_unread(leases.sparkSession, path, leases, "app-a")
    return op.resume_read(unread, leases, "app-a").select("app_name", *RECORD)


@query
def missing_leases(t) -> DataFrame:
    return op.missing_leases(t("records"), t("leases"), "app-a").select("app_name", *RECORD)


@query
def multi_app_resume(t) -> DataFrame:
    return op.multi_app_resume(t("records"), t("leases")).select(
        "app_name", "shard_id", "sequence_number"
    )


# --- acknowledgements -------------------------------------------------------


def _acks(t) -> DataFrame:
    numbered = op.micro_batches(op.route_batchers(t("records")), 20)
    return numbered.select(
        F.lit("app-a").alias("app_name"),
        "shard_id",
        F.col("batch_no").alias("ack_id"),
        "position",
        "sequence_number",
        F.when(F.col("event_type") == "error", "failed").otherwise("ok").alias("status"),
    )


@query
def checkpoints_from_acks(t) -> DataFrame:
    return op.checkpoints_from_acks(_acks(t))


@query
def checkpoints_contiguous(t) -> DataFrame:
    return op.checkpoints_from_acks(_acks(t), mode="contiguous")


@query
def pending_retries(t) -> DataFrame:
    return op.pending_retries(t("retry_acks"))


@query
def exhausted_retries(t) -> DataFrame:
    return op.pending_retries(t("retry_acks"), max_attempts=3)


@query
def completed_shards(t) -> DataFrame:
    return op.completed_shards(
        t("user_shards"),
        t("user_leases"),
        t("user_records"),
        t("user_acks"),
        "app-a",
        AS_OF,
        86_400_000,
    )


@query
def drop_redelivered(t) -> DataFrame:
    return op.drop_redelivered(t("redelivered"))


@query
def consumer_lag(t) -> DataFrame:
    return op.consumer_lag(t("user_records"), t("user_leases"))


@query
def consumer_lag_sliced(t) -> DataFrame:
    """The same lag with the shards' order run slice by slice."""
    return op.consumer_lag(t("user_records"), t("user_leases"), slice_rows=50)


# --- lineage ----------------------------------------------------------------


@query
def shard_edges(t) -> DataFrame:
    return op.shard_edges(t("listing"))


@query
def shard_vertices(t) -> DataFrame:
    return op.shard_vertices(t("listing"))


@query
def shard_parents(t) -> DataFrame:
    parents = op.shard_parents(t("listing"))
    return parents.withColumn("parents", F.array_join("parents", ","))


@query
def ready_shards(t) -> DataFrame:
    return op.ready_shards(t("listing"), t("listing_leases"), "app-a")


@query
def ready_shards_reference(t) -> DataFrame:
    return op.ready_shards(t("listing"), t("listing_leases"), "app-a", reference_mode=True)


@query
def shard_generations(t) -> DataFrame:
    return op.shard_generations(t("listing"))


@query
def lineage_cycles(t) -> DataFrame:
    return op.lineage_cycles(t("listing"))


@query
def ordered_replay(t) -> DataFrame:
    return op.ordered_replay(t("replay_records"), op.shard_generations(t("listing"))).select(
        "partition_key", "replay_no", "generation", "stream_name", "shard_id", "sequence_number"
    )


# --- leases -----------------------------------------------------------------

_REQUEST = ["app_name", "shard_id", "request_seq", "worker"]


def _requests(t, kind: str, *extra: str) -> DataFrame:
    return t("requests").where(F.col("event_type") == kind).select(*_REQUEST, *extra)


def _create(t):
    return op.create_leases(t("user_leases"), _requests(t, "signup"))


def _renew(t):
    return op.renew_leases(t("user_leases"), _requests(t, "view", "expected_count"))


def _take(t):
    return op.take_leases(t("user_leases"), _requests(t, "click", "expected_count"))


def _checkpoint(t, **options):
    return op.apply_checkpoints(
        t("user_leases"), _requests(t, "purchase", "checkpoint"), **options
    )


def _close(t):
    return op.close_shards(t("user_leases"), _requests(t, "error"))


@query
def create_leases(t) -> DataFrame:
    return _create(t).outcomes


@query
def create_leases_table(t) -> DataFrame:
    return _create(t).leases


@query
def renew_leases(t) -> DataFrame:
    return _renew(t).outcomes


@query
def renew_leases_table(t) -> DataFrame:
    return _renew(t).leases


@query
def take_leases(t) -> DataFrame:
    return _take(t).outcomes


@query
def take_leases_table(t) -> DataFrame:
    return _take(t).leases


@query
def apply_checkpoints(t) -> DataFrame:
    return _checkpoint(t).outcomes


@query
def apply_checkpoints_table(t) -> DataFrame:
    return _checkpoint(t).leases


@query
def apply_checkpoints_monotonic(t) -> DataFrame:
    return _checkpoint(t, monotonic=True).leases


@query
def close_shards(t) -> DataFrame:
    return _close(t).outcomes


@query
def close_shards_table(t) -> DataFrame:
    return _close(t).leases


@query
def lease_actions(t) -> DataFrame:
    return op.lease_actions(t("user_leases"), t("observations"))


@query
def fold_leases(t) -> DataFrame:
    return op.fold_leases(t("lease_commands"))


@query
def stale_leases(t) -> DataFrame:
    return op.stale_leases(t("lease_history"), expiry_ms=3 * 86_400_000)


@query
def fold_leases_sliced(t) -> DataFrame:
    return op.fold_leases(t("lease_commands"), slice_rows=40)


@query
def stale_leases_sliced(t) -> DataFrame:
    return op.stale_leases(t("lease_history"), expiry_ms=3 * 86_400_000, slice_rows=10)


# --- end to end -------------------------------------------------------------


def _handlers() -> Handlers:
    bad = F.col("data").endswith("|error")
    return Handlers(
        on_message={"status": F.when(bad, "failed").otherwise("ok")},
        batcher=_rule(),
        batch_size=_SIZES,
    )


def _step(t, **options):
    records = t("records")
    state = ConsumeState.empty(records.sparkSession)._replace(leases=t("leases"))
    return consume_once(
        records, t("shards"), state, "app-a", "worker-1", AS_OF, _handlers(), **options
    )


@query
def consume(t) -> DataFrame:
    """The messages of one step with their outcome."""
    records = t("records")
    pending = ConsumeState.empty(records.sparkSession).pending
    _, mine = held_leases(t("shards"), t("leases"), "app-a", "worker-1")
    messages = read_input(records, mine, pending, "app-a", limit=500)
    return deliver(messages, _handlers(), input_bound(mine, pending, 500)).select(
        "app_name",
        "shard_id",
        "sequence_number",
        "attempt",
        "batcher",
        "batch_no",
        "position",
        "status",
    )


@query
def consume_batch_failures(t) -> DataFrame:
    """The outcome of a step whose batch callback marks failures and leaves the
    status of the rest out, and drops some messages."""

    def on_batch(batched: DataFrame) -> DataFrame:
        kept = batched.where(~F.col("data").endswith("|signup"))
        return kept.withColumn("status", F.when(F.col("data").endswith("|error"), "failed"))

    records = t("records")
    state = ConsumeState.empty(records.sparkSession)._replace(leases=t("leases"))
    handlers = Handlers(on_batch=on_batch, batch_size=40)
    step = consume_once(records, t("shards"), state, "app-a", "worker-1", AS_OF, handlers, limit=500)
    return step.messages.select("shard_id", "sequence_number", "status", "error")


@query
def consume_pending(t) -> DataFrame:
    """What one step leaves to be retried."""
    return _step(t, limit=500).state.pending.select("shard_id", "sequence_number", "attempt")


@query
def consume_leases(t) -> DataFrame:
    """The lease table after a step that reads all and gives up on failures."""
    return _step(t, max_attempts=1, shutdown_delay_ms=0).state.leases


@query
def consume_takeover(t) -> DataFrame:
    """A second step, after the lease of another worker has stood still for too
    long: the worker takes it and reads its shard on."""
    state = ConsumeState.empty(t("records").sparkSession)._replace(leases=t("leases"))
    for minutes in (0, 10):
        step = consume_once(
            t("records"), t("shards"), state, "app-a", "worker-1", AS_OF + timedelta(minutes=minutes), lease_expiry_ms=300_000
        )
        state = step.state
    return step.messages.select("shard_id", "sequence_number", "status")


@query
def consume_dead_letters(t) -> DataFrame:
    """Dead letters of three steps that try every message once."""
    state = ConsumeState.empty(t("records").sparkSession)._replace(leases=t("leases"))
    dead = []
    for _ in range(3):
        step = consume_once(t("records"), t("shards"), state, "app-a", "worker-1", AS_OF, _handlers(), max_attempts=1)
        state = step.state
        dead.append(step.dead_letters.select("shard_id", "sequence_number", "attempt"))
    return dead[0].union(dead[1]).union(dead[2])
