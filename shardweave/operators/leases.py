"""Lease tables changed by tables of requests.

Every change is conditional, like a compare-and-set write: the request names
what it expects and fails if the lease differs.  All requests of one call are
judged against the same lease table; where several of them could change the
same lease, the first by ``request_seq`` does and the others fail.  For logs in
which later commands build on earlier ones see :func:`fold_leases`.
"""

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import plus_millis, seq_after, seq_order
from ..plans import fits_broadcast, lookup_join
from ..plans.numbering import SLICE_ROWS, slice_groups

KEY = ["app_name", "shard_id"]
LEASE_EXPIRY_MS = 90_001
LEASE_RENEW_INTERVAL_MS = 30_000


class LeaseChange:
    """``outcomes``: one row per request with its ``outcome``; ``leases``: the
    lease table afterwards.  The outcomes are planned when asked for."""

    def __init__(self, leases: DataFrame, outcomes: Callable[[], DataFrame]):
        self.leases = leases
        self._plan_outcomes = outcomes

    @cached_property
    def outcomes(self) -> DataFrame:
        return self._plan_outcomes()


def _with_lease(requests: DataFrame, leases: DataFrame, fits: bool) -> DataFrame:
    """Requests with the lease they aim at as struct ``lease`` (NULL if none)."""
    values = [c for c in leases.columns if c not in KEY]
    current = leases.select(*KEY, F.struct(*values).alias("lease"))
    return lookup_join(requests, current, KEY, salt_by=["request_seq"], fits=fits)


def _judge(
    requests: DataFrame,
    leases: DataFrame,
    holds: Column,
    failure: str,
    one_winner: bool,
    changes: dict[str, Column],
) -> LeaseChange:
    """Apply the requests for which ``holds`` is true.  ``changes`` maps lease
    columns to expressions over the winning request's columns and ``lease``.
    With ``one_winner`` only the first request that holds succeeds; otherwise
    all do and the last one's values stay."""
    fits = fits_broadcast(leases)
    judged = _with_lease(requests, leases, fits).withColumn(
        "_holds", F.coalesce(holds, F.lit(False))
    )
    pick = F.min_by if one_winner else F.max_by
    new = F.struct("request_seq", *[e.alias(c) for c, e in changes.items()])
    # at most one row per lease, so it fits wherever the leases do
    winners = (
        judged.where("_holds").groupBy(*KEY).agg(pick(new, "request_seq").alias("_won"))
    )

    def outcomes() -> DataFrame:
        rows = judged
        if one_winner:
            first = winners.select(*KEY, F.col("_won.request_seq").alias("_first"))
            rows = lookup_join(rows, first, KEY, salt_by=["request_seq"], fits=fits).withColumn(
                "_holds", F.col("_holds") & (F.col("request_seq") == F.col("_first"))
            )
        return rows.select(
            *requests.columns,
            F.when(F.col("_holds"), F.lit("ok")).otherwise(F.lit(failure)).alias("outcome"),
        )

    after = leases.join(winners, KEY, "left").select(
        *[
            F.when(F.col("_won").isNotNull(), F.col(f"_won.{c}")).otherwise(F.col(c)).alias(c)
            if c in changes
            else F.col(c)
            for c in leases.columns
        ]
    )
    return LeaseChange(after, outcomes)


def create_leases(leases: DataFrame, requests: DataFrame) -> LeaseChange:
    """Requests ``(app_name, shard_id, request_seq, worker)``: create the lease
    with the worker as owner and count 1, unless it exists
    (``already_exists``)."""
    seen = _with_lease(requests, leases, fits_broadcast(leases))
    first = (
        seen.where(F.col("lease").isNull())
        .groupBy(*KEY)
        .agg(
            F.min("request_seq").alias("_first"),
            F.min_by("worker", "request_seq").alias("_worker"),
        )
    )

    def outcomes() -> DataFrame:
        return lookup_join(
            seen, first.select(*KEY, "_first"), KEY, salt_by=["request_seq"]
        ).select(
            *requests.columns,
            F.when(F.col("request_seq") == F.col("_first"), F.lit("ok"))
            .otherwise(F.lit("already_exists"))
            .alias("outcome"),
        )

    created = first.select(
        *KEY,
        F.lit(None).cast("string").alias("checkpoint"),
        F.col("_worker").alias("lease_owner"),
        F.lit(1).cast("long").alias("lease_count"),
        F.lit(False).alias("completed"),
    )
    return LeaseChange(leases.unionByName(created), outcomes)


def renew_leases(leases: DataFrame, requests: DataFrame) -> LeaseChange:
    """Requests ``(…, worker, expected_count)``: raise the count by one if both
    the owner and the count match (``lease_renew_failed``)."""
    holds = (F.col("lease.lease_owner") == F.col("worker")) & (
        F.col("lease.lease_count") == F.col("expected_count")
    )
    return _judge(
        requests,
        leases,
        holds,
        "lease_renew_failed",
        True,
        {"lease_count": F.col("expected_count") + 1},
    )


def take_leases(leases: DataFrame, requests: DataFrame) -> LeaseChange:
    """Requests ``(…, worker, expected_count)``: become the owner and raise the
    count by one if the count matches and the owner is someone else
    (``lease_take_failed``)."""
    holds = (F.col("lease.lease_owner") != F.col("worker")) & (
        F.col("lease.lease_count") == F.col("expected_count")
    )
    return _judge(
        requests,
        leases,
        holds,
        "lease_take_failed",
        True,
        {"lease_count": F.col("expected_count") + 1, "lease_owner": F.col("worker")},
    )


def apply_checkpoints(
    leases: DataFrame, requests: DataFrame, monotonic: bool = False
) -> LeaseChange:
    """Requests ``(…, worker, checkpoint)``: set the checkpoint if the worker
    owns the lease (``lease_owner_match``).  A lower checkpoint overwrites a
    higher one unless ``monotonic``: then it is accepted and changes nothing."""
    requests = requests.withColumnRenamed("checkpoint", "new_checkpoint")
    holds = F.col("lease.lease_owner") == F.col("worker")
    value = F.col("new_checkpoint")
    if not monotonic:
        change = _judge(requests, leases, holds, "lease_owner_match", False, {"checkpoint": value})
        after = change.leases
    else:
        change = _judge(requests, leases, holds, "lease_owner_match", False, {})
        best = (
            change.outcomes.where((F.col("outcome") == "ok") & value.isNotNull())
            .groupBy(*KEY)
            .agg(F.max_by(value, seq_order(value)).alias("_best"))
        )
        ahead = F.col("_best").isNotNull() & (
            F.col("checkpoint").isNull() | seq_after("_best", "checkpoint")
        )
        newest = F.when(ahead, F.col("_best")).otherwise(F.col("checkpoint"))
        after = (
            leases.join(best, KEY, "left")
            .withColumn("checkpoint", newest)
            .select(*leases.columns)
        )
    return LeaseChange(
        after, lambda: change.outcomes.withColumnRenamed("new_checkpoint", "checkpoint")
    )


def close_shards(leases: DataFrame, requests: DataFrame) -> LeaseChange:
    """Requests ``(…, worker)``: mark the shard completed if the worker owns the
    lease (``lease_owner_match``)."""
    holds = F.col("lease.lease_owner") == F.col("worker")
    return _judge(
        requests, leases, holds, "lease_owner_match", False, {"completed": F.lit(True)}
    )


def lease_actions(
    leases: DataFrame, observations: DataFrame, lease_expiry_ms: int = LEASE_EXPIRY_MS
) -> DataFrame:
    """What each worker does with each lease it looks at.

    Observations: ``(app_name, shard_id, worker, now_ms, tracked_count,
    counted_at_ms)``, where the last two are the lease count the worker saw and
    when it last saw it change.  ``action`` is ``create`` (no lease), ``renew``
    (own lease), ``take`` (the count did not change for longer than the expiry,
    tested before looking at the count) or ``track``; ``expected_count`` is what
    the conditional write compares.  ``next_count`` and ``next_counted_at_ms``
    are the tracking state after a ``track``.
    """
    values = [c for c in leases.columns if c not in KEY]
    current = leases.select(*KEY, F.struct(*values).alias("lease"))
    seen = lookup_join(observations, current, KEY, salt_by=["worker", "now_ms"])
    own = F.col("lease.lease_owner") == F.col("worker")
    expired = F.col("now_ms") - F.col("counted_at_ms") > lease_expiry_ms
    action = (
        F.when(F.col("lease").isNull(), "create")
        .when(own, "renew")
        .when(expired, "take")
        .otherwise("track")
    )
    changed = ~F.col("lease.lease_count").eqNullSafe(F.col("tracked_count"))
    moved = (F.col("action") == "track") & changed
    return seen.withColumn("action", action).select(
        *observations.columns,
        "action",
        F.when(F.col("action") == "renew", F.col("lease.lease_count"))
        .when(F.col("action") == "take", F.col("tracked_count"))
        .alias("expected_count"),
        F.when(moved, F.col("lease.lease_count")).otherwise(F.col("tracked_count")).alias(
            "next_count"
        ),
        F.when(moved, F.col("now_ms")).otherwise(F.col("counted_at_ms")).alias(
            "next_counted_at_ms"
        ),
    )


def stale_leases(
    observations: DataFrame,
    expiry_ms: int = LEASE_EXPIRY_MS,
    by: tuple[str, ...] = ("shard_id",),
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Expiry over a history of observations ``(shard_id, obs_id, obs_ts,
    lease_count)``: adds ``counted_at``, the last time before the row at which
    the count changed (the first observation starts the clock), and ``stale``,
    whether more than the expiry has passed since.

    The history of one lease may be long, so it is cut into slices; a slice
    takes over the last count and the last change from the slices before it.
    """
    by = list(by)
    order = [F.col("obs_ts"), F.col("obs_id")]
    cut = slice_groups(observations, by, order, slice_rows)
    inside = Window.partitionBy(*by, "_slice").orderBy(*order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = cut.rows.withColumn("_prev", F.lag("lease_count").over(inside)).withColumn(
        "_first", F.row_number().over(inside) == 1
    )
    if cut.many:
        # per slice: how it begins and ends and its last change from row to row
        ends = (
            rows.where("_cut")
            .withColumn("_change", F.when(F.col("_prev") != F.col("lease_count"), F.col("obs_ts")))
            .groupBy(*by, "_slice")
            .agg(
                F.min_by("lease_count", F.struct(*order)).alias("_count_in"),
                F.max_by("lease_count", F.struct(*order)).alias("_count_out"),
                F.min("obs_ts").alias("_begin"),
                F.max("_change").alias("_change"),
            )
        )
        slices = Window.partitionBy(*by).orderBy("_slice")
        so_far = slices.rowsBetween(Window.unboundedPreceding, -1)
        last_out = F.lag("_count_out").over(slices)
        carried = (
            ends.withColumn("_in_prev", last_out)
            .withColumn(
                "_at_begin",
                F.when(
                    F.col("_in_prev").isNull() | (F.col("_in_prev") != F.col("_count_in")),
                    F.col("_begin"),
                ),
            )
            .withColumn(
                "_carry", F.max(F.greatest("_change", "_at_begin")).over(so_far)
            )
            .select(*by, "_slice", "_in_prev", "_carry")
        )
        rows = rows.join(F.broadcast(carried), [*by, "_slice"], "left").withColumn(
            "_prev", F.when(F.col("_first"), F.col("_in_prev")).otherwise(F.col("_prev"))
        )
    else:
        rows = rows.withColumn("_carry", F.lit(None).cast(observations.schema["obs_ts"].dataType))
    changed = F.when(
        F.col("_prev").isNull() | (F.col("_prev") != F.col("lease_count")), F.col("obs_ts")
    )
    return (
        rows.withColumn("_changed", changed)
        .withColumn("counted_at", F.greatest("_carry", F.max("_changed").over(before)))
        .withColumn(
            "stale",
            F.coalesce(F.col("obs_ts") > plus_millis(F.col("counted_at"), expiry_ms), F.lit(False)),
        )
        .select(*observations.columns, "counted_at", "stale")
    )
