"""Retries and the countdown of closed shards, as state with timers.

The batch operators ``pending_retries`` and ``completed_shards`` find these from
whole tables.  Here a stream of events keeps them up to date: what failed last
waits for its next attempt, and a closed shard with nothing unread and nothing
pending completes on its own when its shutdown delay has run out.  A success
restarts the countdown, a failure cancels it.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.acks import SHUTDOWN_DELAY_MS
from ..operators.messages import FAILED, OK
from ..plans import ship

KEY = ["app_name", "shard_id"]
#: ``kind``: ``ack`` (sequence_number, attempt, status), ``record`` (one that can be
#: read), ``checkpoint`` (the lease's new one) or ``closed`` (the shard ended).
EVENTS = "app_name STRING, shard_id STRING, kind STRING, sequence_number STRING, attempt BIGINT, status STRING"
#: ``kind``: ``retry`` (whether the record waits for another attempt) or ``completed``.
CHANGES = "app_name STRING, shard_id STRING, kind STRING, sequence_number STRING, attempt BIGINT, pending BOOLEAN"
FINISHED_TTL_MS = 86_400_000


def _order(seq: str | None) -> tuple[int, str]:
    return (-1, "") if seq is None else (len(seq), seq)


class _Watch(StatefulProcessor):
    def __init__(self, shutdown_delay_ms: int, finished_ttl_ms: int):
        self._delay, self._ttl = shutdown_delay_ms, finished_ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._waiting = handle.getMapState("waiting", "seq string", "attempt bigint")
        # attempts that succeeded: known for a while, so one that comes late does not undo them
        self._finished = handle.getMapState("finished", "seq string", "attempt bigint", self._ttl)
        self._shard = handle.getValueState(
            "shard", "closed boolean, newest string, checkpoint string, last_ok bigint, due bigint, completed boolean"
        )

    def _attempts(self, key, acks: pd.DataFrame) -> list[tuple]:
        """Take over the last attempt of each record; the changes to tell."""
        out = []
        last = acks.sort_values("attempt", kind="stable").drop_duplicates("sequence_number", keep="last")
        for seq, attempt, status in zip(last["sequence_number"], last["attempt"], last["status"], strict=True):
            states = (self._waiting, self._finished)
            known = [s.getValue((seq,))[0] for s in states if s.containsKey((seq,))]
            if known and max(known) > attempt:
                continue
            failed = status == FAILED
            mine, other = states if failed else states[::-1]
            if other.containsKey((seq,)):
                other.removeKey((seq,))
            mine.updateValue((seq,), (int(attempt),))
            out.append((*key, "retry", seq, int(attempt), failed))
        return out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        events, now = pd.concat(list(rows)), timerValues.getCurrentProcessingTimeInMs()
        state = self._shard.get() if self._shard.exists() else (False, None, None, None, None, False)
        closed, newest, checkpoint, last_ok, due, completed = state
        kinds = events["kind"]
        closed = closed or bool((kinds == "closed").any())
        newest = max([newest, *events.loc[kinds == "record", "sequence_number"]], key=_order)
        checkpoint = max([checkpoint, *events.loc[kinds == "checkpoint", "sequence_number"]], key=_order)
        acks = events[kinds == "ack"]
        out = self._attempts(key, acks)
        if (acks["status"] == OK).any():
            last_ok = now
        unread = _order(newest) > _order(checkpoint)
        counting = closed and not unread and last_ok is not None and not completed and not self._waiting.exists()
        wanted = last_ok + self._delay if counting else None
        if wanted != due:
            if due is not None:
                self._handle.deleteTimer(due)
            if wanted is not None:
                self._handle.registerTimer(wanted)
        self._shard.update((closed, newest, checkpoint, last_ok, wanted, completed))
        if out:
            yield self._told(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = self._shard.get()
        if state[4] is not None and not state[5]:
            self._shard.update((*state[:4], None, True))
            yield self._told([(*key, "completed", None, None, None)])

    @staticmethod
    def _told(rows: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=[c.split()[0] for c in CHANGES.split(", ")])
        return frame.astype({"attempt": "Int64", "pending": "boolean"})

    def close(self) -> None:
        pass


def watch_shards(
    events: DataFrame, shutdown_delay_ms: int = SHUTDOWN_DELAY_MS, finished_ttl_ms: int = FINISHED_TTL_MS
) -> DataFrame:
    """The changes (:data:`CHANGES`) that a stream of :data:`EVENTS` brings, in
    output mode ``update``: the newest ``retry`` of a record says whether it waits;
    ``completed`` comes once, by itself, when a closed shard's countdown ends.

    Attempts of one record may come in any order within ``finished_ttl_ms`` after
    one succeeded; those that wait are kept as long as it takes.  The countdown is
    by the clock of the query.  Needs the RocksDB state store provider."""
    ship(events.sparkSession)
    return events.groupBy(*KEY).transformWithStateInPandas(
        statefulProcessor=_Watch(shutdown_delay_ms, finished_ttl_ms),
        outputStructType=CHANGES,
        outputMode="Update",
        timeMode="ProcessingTime",
    )
