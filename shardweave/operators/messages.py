"""Messages: wrapping records, user callbacks, batchers and batches."""

from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import reduce
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import seq_order
from ..plans import number_rows
from ..plans.numbering import SLICE_ROWS

OK, FAILED = "ok", "failed"
DEFAULT_BATCHER = "default"
DEFAULT_BATCH_SIZE = 20


def wrap_messages(records: DataFrame) -> DataFrame:
    """Records as messages: ``data`` and all other columns as ``metadata``."""
    rest = [c for c in records.columns if c != "data"]
    return records.select("data", F.struct(*rest).alias("metadata"))


def map_messages(
    msgs: DataFrame,
    fn: Callable[..., DataFrame] | Mapping[str, Column] | None = None,
    *,
    pandas_fn: Callable[..., pd.DataFrame] | None = None,
    schema: T.StructType | str | None = None,
    **context: Any,
) -> DataFrame:
    """Apply the per-message callback and return the messages with ``status``
    (``ok`` or ``failed``) and ``error``.

    ``fn`` is a mapping of column names to expressions, or a function from
    DataFrame to DataFrame; both stay inside the JVM.  ``pandas_fn`` gets Arrow
    batches as pandas frames and needs the output ``schema``.  Keyword
    arguments are the handler context and are passed on to the function.  A
    callback marks a message as failed by setting ``status`` to ``failed``; NULL
    stands for ``ok``, and any other status fails the message (:func:`with_outcome`).
    """
    if pandas_fn is not None:
        if schema is None:
            raise ValueError("pandas_fn needs the output schema")

        def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                yield pandas_fn(frame, **context)

        out = msgs.mapInPandas(run, schema)
    elif fn is None:
        out = msgs
    elif isinstance(fn, Mapping):
        out = msgs.withColumns(dict(fn))
    else:
        out = fn(msgs, **context)
    return with_outcome(out)


def with_outcome(msgs: DataFrame) -> DataFrame:
    """Messages as a callback left them, with a ``status`` that is ``ok`` or
    ``failed``, and ``error``.  No status stands for ``ok``; one that is neither
    fails the message and is told in ``error``, unless the callback said why."""
    if "status" not in msgs.columns:
        msgs = msgs.withColumn("status", F.lit(OK))
    if "error" not in msgs.columns:
        msgs = msgs.withColumn("error", F.lit(None).cast("string"))
    status = F.coalesce(F.col("status").cast("string"), F.lit(OK))
    odd = ~status.isin(OK, FAILED)
    told = F.concat(F.lit("unknown status "), status)
    return msgs.withColumns(
        {
            "error": F.when(odd, F.coalesce("error", told)).otherwise(F.col("error")),
            "status": F.when(odd, F.lit(FAILED)).otherwise(status),
        }
    )


def with_dropped(given: DataFrame, left: DataFrame, keys: Iterable[str]) -> DataFrame:
    """What a callback ``left`` of the messages it was ``given``, and those it
    dropped, as failed: a message that is neither acknowledged nor failed would be
    lost or read for ever."""
    dropped = given.join(left.select(*keys), list(keys), "left_anti").withColumns(
        {"status": F.lit(FAILED), "error": F.lit("dropped by a callback")}
    )
    return left.unionByName(dropped, allowMissingColumns=True)


def route_batchers(msgs: DataFrame, rule: Column | None = None) -> DataFrame:
    """Name the ``batcher`` of each message; NULL means the default batcher."""
    default = F.lit(DEFAULT_BATCHER)
    return msgs.withColumn("batcher", default if rule is None else F.coalesce(rule, default))


def micro_batches(
    msgs: DataFrame,
    batch_size: int | Mapping[str, int] = DEFAULT_BATCH_SIZE,
    by: Iterable[str] = ("shard_id", "batcher"),
    slice_rows: int = SLICE_ROWS,
    total: int | None = None,
) -> DataFrame:
    """Give each message ``batch_no`` and ``position``, both from 0.

    Consecutive messages of a shard and batcher, in sequence order, form
    batches of ``batch_size``; the last may be short.  ``batch_size`` may be
    given per batcher.  A hot shard is numbered slice by slice, so it never
    passes through one task.  ``total`` is a bound on the number of messages,
    if known.
    """
    by = list(by)
    if isinstance(batch_size, Mapping):
        named = [F.lit(x) for pair in batch_size.items() for x in pair]
        size = F.coalesce(F.create_map(*named)[F.col("batcher")], F.lit(DEFAULT_BATCH_SIZE))
    else:
        size = F.lit(batch_size)
    numbered = number_rows(
        msgs, by, [seq_order("sequence_number")], "_rn", slice_rows, total=total
    )
    index = F.col("_rn") - 1
    return numbered.select(
        *msgs.columns,
        F.floor(index / size).cast("long").alias("batch_no"),
        F.pmod(index, size).cast("long").alias("position"),
    )


def map_batches(
    batched: DataFrame,
    fn: Callable[..., pd.DataFrame],
    schema: T.StructType | str,
    by: Iterable[str] = ("shard_id", "batcher", "batch_no"),
    **context: Any,
) -> DataFrame:
    """Call ``fn(batch, **context)`` with every batch as a pandas frame in
    sequence order.

    A batch is small, so the batches are shuffled whole and sorted, and Python
    takes them from large Arrow batches one after the other; a transfer of its
    own per batch would cost more than the callback.  The number of tasks is
    ``spark.sql.shuffle.partitions`` whatever the size of the data, since the
    time goes into the callbacks.
    """
    by = list(by)
    tasks = int(batched.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            if frame.empty:
                continue
            keys = frame[by]
            starts = (keys != keys.shift()).any(axis=1).to_numpy().nonzero()[0].tolist()
            out = [
                fn(frame.iloc[i:j].reset_index(drop=True), **context)
                for i, j in zip(starts, starts[1:], strict=False)
            ]
            if out:
                yield pd.concat(out, ignore_index=True)
            rest = frame.iloc[starts[-1] :]
        if rest is not None:
            yield fn(rest.reset_index(drop=True), **context)

    together = batched.repartition(tasks, *by).sortWithinPartitions(*by, "position")
    return together.mapInPandas(run, schema)


def split_failed(
    msgs: DataFrame, fn: Callable[[DataFrame], DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The messages that went well (those without a status too), and those that
    failed (for a dead-letter table or a retry), the latter as ``fn`` leaves them."""
    bad = F.col("status").eqNullSafe(FAILED)
    failed = msgs.where(bad)
    return msgs.where(~bad), failed if fn is None else fn(failed)


def partition_by(
    msgs: DataFrame, key: str, processors: int, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Assign every message a ``processor`` by its key and its
    ``processor_pos`` there, in sequence order.

    All messages of a key have one processor, so their order holds.  The order
    is data, not a property of a task: a processor whose key is hot may be
    worked on by many tasks and still be read back in order.
    """
    head = F.conv(F.substring(F.md5(F.col(key).cast("binary")), 1, 8), 16, 10).cast("long")
    assigned = msgs.withColumn("processor", F.pmod(head, F.lit(processors)).cast("int"))
    order = [seq_order("sequence_number"), F.col("shard_id")]
    return number_rows(
        assigned, ["processor"], order, name="processor_pos", slice_rows=slice_rows
    )


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
