"""Consuming a stream end to end, as one batch step or as a streaming query."""

from .consumer import (
    ConsumeState,
    Handlers,
    StepResult,
    consume,
    consume_once,
    deliver,
    held_leases,
    input_bound,
    read_input,
    settle,
)
from .stateful import (
    drop_redelivered_stream,
    fold_leases_stream,
    stream_records,
    write_record_stream,
)
from .timers import watch_shards

__all__ = [
    "ConsumeState",
    "Handlers",
    "StepResult",
    "consume",
    "consume_once",
    "deliver",
    "drop_redelivered_stream",
    "fold_leases_stream",
    "held_leases",
    "input_bound",
    "read_input",
    "settle",
    "stream_records",
    "watch_shards",
    "write_record_stream",
]
