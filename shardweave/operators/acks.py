"""Acknowledgements: checkpoints, retries, completion, lag."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import millis_between, plus_millis, seq_after, seq_order, wall_clock
from ..plans import lookup_join, slice_groups
from ..plans.numbering import SLICE_ROWS
from .messages import FAILED, OK

SHUTDOWN_DELAY_MS = 300_000


def _ok() -> Column:
    return F.col("status") == OK


def _failed() -> Column:
    return F.col("status") == FAILED


def checkpoints_from_acks(acks: DataFrame, mode: str = "last_ok") -> DataFrame:
    """Per ack the new checkpoint and the number of messages acknowledged and
    to be retried.

    The checkpoint is the sequence number of the last successful message by
    ``position`` (not the greatest one); NULL if all failed.  With
    ``mode='contiguous'`` it is the last one before the first failure, so a
    failed message is never behind the checkpoint.
    """
    keys = ["app_name", "shard_id", "ack_id"]
    if mode == "contiguous":
        first_bad = acks.where(_failed()).groupBy(*keys).agg(F.min("position").alias("_bad"))
        acks = lookup_join(acks, first_bad, keys, salt_by=["position"])
        counts_on = _ok() & (F.col("_bad").isNull() | (F.col("position") < F.col("_bad")))
    elif mode == "last_ok":
        counts_on = _ok()
    else:
        raise ValueError("mode must be 'last_ok' or 'contiguous'")
    return acks.groupBy(*keys).agg(
        F.max_by(
            F.when(counts_on, F.col("sequence_number")), F.when(counts_on, F.col("position"))
        ).alias("checkpoint"),
        F.count_if(_ok()).alias("n_ok"),
        F.count_if(_failed()).alias("n_failed"),
    )


def pending_retries(
    acks: DataFrame,
    keys: tuple[str, ...] = ("app_name", "shard_id", "sequence_number"),
    max_attempts: int | None = None,
) -> DataFrame:
    """Records whose latest attempt failed, with that ``attempt``.

    Without ``max_attempts`` they are retried until they succeed.  With it, a
    record tried that often has ``exhausted`` true and goes to the dead letters
    instead.
    """
    latest = acks.groupBy(*keys).agg(
        F.max("attempt").alias("attempt"), F.max_by("status", "attempt").alias("status")
    )
    spent = F.lit(False) if max_attempts is None else F.col("attempt") + 1 >= max_attempts
    return latest.where(_failed()).drop("status").withColumn("exhausted", spent)


def completed_shards(
    shards: DataFrame,
    leases: DataFrame,
    records: DataFrame,
    acks: DataFrame,
    app_name: str,
    as_of: datetime | Column,
    shutdown_delay_ms: int = SHUTDOWN_DELAY_MS,
    newest: DataFrame | None = None,
) -> DataFrame:
    """Closed shards the application is done with: nothing unread after the
    checkpoint, no pending retry, and the last successful ack at least the
    shutdown delay before ``as_of``.  One row per closed shard whose lease is
    not completed yet, with the three findings and ``completed``.

    ``newest``: per shard the greatest sequence number, where it is known without
    the records (``newest_records`` of a table with a zone map)."""
    now = as_of if isinstance(as_of, Column) else wall_clock(as_of)
    mine_open = leases.where((F.col("app_name") == app_name) & ~F.col("completed"))
    held = (
        shards.where(F.col("seq_end").isNotNull())
        .select("shard_id")
        .join(mine_open.select("shard_id", "checkpoint", "lease_owner"), "shard_id")
    )
    if newest is None:  # one record per shard of a map task is shuffled; only closed shards are read
        rows = records.select("shard_id", "sequence_number").join(held.select("shard_id"), "shard_id", "left_semi")
        newest = rows.groupBy("shard_id").agg(
            F.max_by("sequence_number", seq_order("sequence_number")).alias("newest")
        )
    mine = acks.where(F.col("app_name") == app_name)
    retries = (
        pending_retries(mine).groupBy("shard_id").agg(F.count(F.lit(1)).alias("n_pending"))
    )
    last_ok = mine.where(_ok()).groupBy("shard_id").agg(F.max("ack_ts").alias("last_ok_ts"))
    unread = F.col("newest").isNotNull() & (
        F.col("checkpoint").isNull() | seq_after("newest", "checkpoint")
    )
    quiet = plus_millis(F.col("last_ok_ts"), shutdown_delay_ms) <= now
    return (
        held.join(newest, "shard_id", "left")
        .join(retries, "shard_id", "left")
        .join(last_ok, "shard_id", "left")
        .select(
            F.lit(app_name).alias("app_name"),
            "shard_id",
            "lease_owner",
            unread.alias("has_unread"),
            F.coalesce("n_pending", F.lit(0)).cast("long").alias("n_pending"),
            F.coalesce(quiet, F.lit(False)).alias("quiet"),
        )
        .withColumn(
            "completed", ~F.col("has_unread") & (F.col("n_pending") == 0) & F.col("quiet")
        )
    )


def drop_redelivered(records: DataFrame) -> DataFrame:
    """One row per ``(shard_id, sequence_number)``; copies of a record are
    alike, so any one is kept.  Copies are dropped before the shuffle."""
    return records.dropDuplicates(["shard_id", "sequence_number"])


def consumer_lag(
    records: DataFrame, leases: DataFrame, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Per lease the unread records of its shard and how far, in arrival time,
    what was read up to the checkpoint is behind the newest record.
    ``behind_ms`` counts from the oldest record where nothing was read.

    Records and checkpoints are merged in one order: along it runs the number of
    records so far and their newest arrival, and a checkpoint reads off both.
    However many applications a shard has, a record passes once.  Shards of more
    than ``slice_rows`` rows run in slices, each from the totals of those before.
    """
    held = leases.select("app_name", "shard_id", "checkpoint")
    read = records.select("shard_id", "sequence_number", "arrival_ts").join(
        held.select("shard_id"), "shard_id", "left_semi"
    )
    marks = held.select(
        "shard_id",
        F.col("checkpoint").alias("sequence_number"),
        F.lit(None).cast(records.schema["arrival_ts"].dataType).alias("arrival_ts"),
    ).distinct()
    merged = read.withColumn("is_mark", F.lit(False)).unionByName(
        marks.withColumn("is_mark", F.lit(True))
    )
    order = [seq_order("sequence_number"), F.col("is_mark")]
    most = records.count() + leases.count()
    cut = slice_groups(merged, ["shard_id"], order, slice_rows, total=most)

    slices = cut.rows.groupBy("shard_id", "_slice").agg(
        F.count_if(~F.col("is_mark")).alias("n"),
        F.min("arrival_ts").alias("oldest"),
        F.max("arrival_ts").alias("newest"),
    )
    per_shard = slices.groupBy("shard_id").agg(
        F.sum("n").alias("n"), F.min("oldest").alias("oldest"), F.max("newest").alias("newest")
    )
    so_far = (
        Window.partitionBy("shard_id", "_slice")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    at_marks = (
        cut.rows.withColumn("n_read", F.count_if(~F.col("is_mark")).over(so_far))
        .withColumn("read_to", F.max("arrival_ts").over(so_far))
        .where("is_mark")
        .select("shard_id", "_slice", F.col("sequence_number").alias("mark"), "n_read", "read_to")
    )
    if cut.many:
        earlier = (
            Window.partitionBy("shard_id").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        )
        before = slices.select(
            "shard_id",
            "_slice",
            F.sum("n").over(earlier).alias("n_before"),
            F.max("newest").over(earlier).alias("to_before"),
        )
        at_marks = (
            at_marks.join(before, ["shard_id", "_slice"], "left")
            .withColumn("n_read", F.col("n_read") + F.coalesce("n_before", F.lit(0)))
            .withColumn("read_to", F.greatest("read_to", "to_before"))
        )
    at_marks = at_marks.withColumnRenamed("shard_id", "mark_shard").drop("_slice")
    own = (F.col("shard_id") == F.col("mark_shard")) & F.col("checkpoint").eqNullSafe(F.col("mark"))
    return (
        held.join(at_marks, own)
        .join(per_shard, "shard_id")
        .select(
            "app_name",
            "shard_id",
            (F.col("n") - F.col("n_read")).cast("long").alias("n_unread"),
            millis_between(F.coalesce("read_to", "oldest"), F.col("newest")).alias("behind_ms"),
        )
    )
