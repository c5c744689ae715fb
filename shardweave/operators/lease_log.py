"""The lease table that an ordered log of commands leads to.

Commands of one lease build on each other, so they are folded in order.  A
short log is one array per lease, folded by a native ``aggregate``.  A long log
is cut into slices.  What a slice does to a lease depends only on the owner and
the count it starts from, so

1. every slice is summarised for all states it could start from, all slices at
   once (``_summarise``);
2. the summaries of a lease are chained, one small step per slice, which gives
   the state each slice really starts from (``_chain``);
3. every slice is folded from its start, again all at once.

No task ever holds the whole log of a lease.
"""

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import lookup_join, ship, slice_groups
from ..schemas import LEASES

KEY = ["app_name", "shard_id"]
SLICE_COMMANDS = 20_000

_STATE = (
    "struct<lease_owner: string, lease_count: bigint, checkpoint: string, "
    "checkpoint_seq: bigint, completed: boolean>"
)
# one line per start a slice tells apart: in_owner NULL = no lease yet, or with
# any_owner an owner the slice does not name; in_count NULL = any other count;
# out_owner NULL = unchanged; out_count, or without it the gain on in_count
_SUMMARY = (
    "app_name string, shard_id string, _slice int, in_owner string, any_owner boolean, "
    "in_count bigint, out_owner string, out_count bigint, gain bigint"
)
_STARTS = "app_name string, shard_id string, _slice int, owner_in string, count_in bigint"


def _apply(acc: Column, c: Column) -> Column:
    """The state after command ``c``."""
    exists = acc["lease_owner"].isNotNull()
    own = exists & (acc["lease_owner"] == c["worker"])
    counted = c["expected_count"].isNull() | (c["expected_count"] == acc["lease_count"])

    def state(owner, count, checkpoint, checkpoint_seq, completed) -> Column:
        return F.struct(
            owner.alias("lease_owner"),
            count.alias("lease_count"),
            checkpoint.alias("checkpoint"),
            checkpoint_seq.alias("checkpoint_seq"),
            completed.alias("completed"),
        )

    op, rest = c["op"], (acc["checkpoint"], acc["checkpoint_seq"], acc["completed"])
    created = state(
        c["worker"],
        F.lit(1).cast("long"),
        F.lit(None).cast("string"),
        F.lit(None).cast("long"),
        F.lit(False),
    )
    return (
        F.when((op == "create") & ~exists, created)
        .when(
            (op == "renew") & own & counted,
            state(acc["lease_owner"], acc["lease_count"] + 1, *rest),
        )
        .when(
            (op == "take") & exists & ~own & counted,
            state(c["worker"], acc["lease_count"] + 1, *rest),
        )
        .when(
            (op == "checkpoint") & own,
            state(
                acc["lease_owner"], acc["lease_count"], c["checkpoint"], c["seq"], acc["completed"]
            ),
        )
        .when(
            (op == "close") & own,
            state(acc["lease_owner"], acc["lease_count"], rest[0], rest[1], F.lit(True)),
        )
        .otherwise(acc)
    )


class _Held:
    """Starts by the state they have led to so far: holder -> count -> starts.

    Counts are kept less a shift per holder, so a command for any count is one
    addition, and of two tables that meet the smaller one is moved."""

    def __init__(self) -> None:
        self.by: dict = {}

    def put(self, holder, count: int, starts: list) -> None:
        shift, counts = self.by.setdefault(holder, [0, {}])
        here = counts.get(count - shift, [])
        if len(here) < len(starts):
            here, starts = starts, here
        here.extend(starts)
        counts[count - shift] = here

    def pop(self, holder, count: int) -> list:
        shift, counts = self.by.get(holder, (0, {}))
        return counts.pop(count - shift, [])

    def renew_all(self, holder) -> None:
        if holder in self.by:
            self.by[holder][0] += 1

    def take_all(self, worker) -> None:
        for holder in [h for h in self.by if h != worker]:
            moved = self.by.pop(holder)
            moved[0] += 1
            kept = self.by.get(worker, [0, {}])
            if len(kept[1]) < len(moved[1]):
                kept, moved = moved, kept
            self.by[worker] = kept
            for count, starts in moved[1].items():
                self.put(worker, count + moved[0], starts)

    def states(self) -> dict:
        return {
            start: (holder, count + shift)
            for holder, (shift, counts) in self.by.items()
            for count, starts in counts.items()
            for start in starts
        }


def _summarise(frame: pd.DataFrame) -> pd.DataFrame:
    """What one slice of commands makes of every state it can start from.  A
    command costs as much as there are workers, however many counts are named."""
    frame = frame.sort_values("seq")
    workers = sorted(frame["worker"].unique())
    # start owner (None: not named here) -> owner now and count gained, for counts in general
    general = {o: (o, 0) for o in [*workers, None]}
    # (start owner, start count) -> (owner, count) now, where a count decides; "" = no lease
    held, known, none = _Held(), set(), True
    expected = frame["expected_count"].astype("Int64")
    for op, worker, want in zip(frame["op"], frame["worker"], expected, strict=True):
        if op not in ("create", "renew", "take"):
            continue
        free = want is pd.NA
        if op == "create":
            if none:
                held.put(worker, 1, [("", 0)])
                none = False
            continue
        if free:
            (held.renew_all if op == "renew" else held.take_all)(worker)
        else:
            holders = [worker] if op == "renew" else [h for h in held.by if h != worker]
            if moved := [x for h in holders for x in held.pop(h, int(want))]:
                held.put(worker, int(want) + 1, moved)
        for owner, (holder, gain) in general.items():
            if (holder == worker) != (op == "renew"):
                continue
            if free:
                general[owner] = (worker, gain + 1)
            elif want - gain >= 1 and (start := (owner, int(want - gain))) not in known:
                known.add(start)
                held.put(worker, int(want) + 1, [start])
    special: dict = held.states() | ({("", 0): None} if none else {})
    lines = []
    for owner, (holder, gain) in general.items():
        lines.append((owner, owner is None, None, None if holder == owner else holder, None, gain))
    for (owner, count), now in special.items():
        out = now or (None, None)
        if owner == "":
            lines.append((None, False, None, *out, None))
        else:
            lines.append((owner, owner is None, count, *out, None))
    names = ["in_owner", "any_owner", "in_count", "out_owner", "out_count", "gain"]
    table = pd.DataFrame(lines, columns=names)
    for i, name in enumerate([*KEY, "_slice"]):
        table.insert(i, name, frame[name].iloc[0])
    for name in ("in_count", "out_count", "gain"):
        table[name] = table[name].astype("Int64")
    return table


def _chain(summaries: pd.DataFrame, first: pd.DataFrame) -> pd.DataFrame:
    """The state every slice of one lease starts from."""
    owner, count = None, None
    if len(first) and pd.notna(first["lease_owner"].iloc[0]):
        owner, count = first["lease_owner"].iloc[0], int(first["lease_count"].iloc[0])
    starts = []
    for number, table in summaries.groupby("_slice", sort=True):
        starts.append((*(table[k].iloc[0] for k in KEY), number, owner, count))
        if owner is None:
            line = table[table["in_owner"].isna() & ~table["any_owner"]].iloc[0]
        else:
            mine = table[table["in_owner"] == owner]
            if not len(mine):
                mine = table[table["any_owner"]]
            exact = mine[mine["in_count"] == count]
            line = exact.iloc[0] if len(exact) else mine[mine["in_count"].isna()].iloc[0]
        if pd.notna(line["out_owner"]):
            owner = line["out_owner"]
        if pd.notna(line["out_count"]):
            count = int(line["out_count"])
        elif owner is not None:
            count = count + int(line["gain"])
    out = pd.DataFrame(starts, columns=[*KEY, "_slice", "owner_in", "count_in"])
    out["count_in"] = out["count_in"].astype("Int64")
    return out


def _starts_of_cut_logs(rows: DataFrame, initial: DataFrame) -> DataFrame:
    ship(rows.sparkSession)
    summaries = (
        rows.where("_cut")
        .select(*KEY, "_slice", "seq", "op", "worker", "expected_count")
        .groupBy(*KEY, "_slice")
        .applyInPandas(_summarise, _SUMMARY)
    )
    first = initial.select(*KEY, "lease_owner", "lease_count").join(
        summaries.select(*KEY).distinct(), KEY, "left_semi"
    )
    return (
        summaries.groupBy(*KEY)
        .cogroup(first.groupBy(*KEY))
        .applyInPandas(_chain, _STARTS)
    )


def fold_leases(
    commands: DataFrame,
    initial: DataFrame | None = None,
    slice_rows: int = SLICE_COMMANDS,
    order: Iterable[str] = ("seq",),
) -> DataFrame:
    """Apply ``commands`` in the order of ``seq``, per lease, to ``initial``.

    Commands: ``(app_name, shard_id, seq, op, worker, expected_count,
    checkpoint)`` with op ``create``, ``renew``, ``take``, ``checkpoint`` or
    ``close``; the conditions are those of the operators of the same kind, and
    an ``expected_count`` of NULL stands for the count just read.  Commands that
    fail change nothing.  Returns the lease table afterwards.
    """
    spark = commands.sparkSession
    if initial is None:
        initial = spark.createDataFrame([], LEASES)
    cut = slice_groups(commands, KEY, [F.col(c) for c in order], slice_rows)
    log = F.struct("seq", "op", "worker", "expected_count", "checkpoint")
    logs = cut.rows.groupBy(*KEY, "_slice").agg(F.array_sort(F.collect_list(log)).alias("_log"))
    before = initial.select(
        *KEY,
        F.col("lease_owner").alias("_owner0"),
        F.col("lease_count").alias("_count0"),
        F.col("checkpoint").alias("_checkpoint0"),
        F.col("completed").alias("_completed0"),
    )
    logs = lookup_join(logs, before, KEY, salt_by=["_slice"])
    owner_in, count_in = F.col("_owner0"), F.col("_count0")
    if cut.many:
        # one row per slice of the logs that were cut: no more than pivots and such logs
        starts = _starts_of_cut_logs(cut.rows, initial).withColumn("_started", F.lit(True))
        logs = logs.join(F.broadcast(starts), [*KEY, "_slice"], "left")
        owner_in = F.when(F.col("_started"), F.col("owner_in")).otherwise(owner_in)
        count_in = F.when(F.col("_started"), F.col("count_in")).otherwise(count_in)
    start = F.struct(
        owner_in.alias("lease_owner"),
        count_in.alias("lease_count"),
        F.lit(None).cast("string").alias("checkpoint"),
        F.lit(None).cast("long").alias("checkpoint_seq"),
        F.lit(False).alias("completed"),
    ).cast(_STATE)
    folded = logs.withColumn("_s", F.aggregate("_log", start, _apply))
    marked = F.when(F.col("_s.checkpoint_seq").isNotNull(), F.col("_s.checkpoint_seq"))
    changed = folded.groupBy(*KEY).agg(
        F.max_by("_s.lease_owner", "_slice").alias("lease_owner"),
        F.max_by("_s.lease_count", "_slice").alias("lease_count"),
        F.max_by(F.struct(F.col("_s.checkpoint").alias("v")), marked).alias("_mark"),
        F.bool_or("_s.completed").alias("_done"),
        F.first("_checkpoint0").alias("_checkpoint0"),
        F.first("_completed0").alias("_completed0"),
    )
    after = changed.where(F.col("lease_owner").isNotNull()).select(
        *KEY,
        F.when(F.col("_mark").isNotNull(), F.col("_mark.v"))
        .otherwise(F.col("_checkpoint0"))
        .alias("checkpoint"),
        "lease_owner",
        "lease_count",
        (F.col("_done") | F.coalesce("_completed0", F.lit(False))).alias("completed"),
    )
    untouched = initial.join(changed.select(*KEY), KEY, "left_anti").select(*after.columns)
    return after.unionByName(untouched)
