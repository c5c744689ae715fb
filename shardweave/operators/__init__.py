"""Operators: functions from DataFrames to DataFrames."""

from .acks import (
    checkpoints_from_acks,
    completed_shards,
    consumer_lag,
    drop_redelivered,
    pending_retries,
)
from .lease_log import fold_leases
from .leases import (
    LeaseChange,
    apply_checkpoints,
    close_shards,
    create_leases,
    lease_actions,
    renew_leases,
    stale_leases,
    take_leases,
)
from .lineage import (
    lineage_cycles,
    ordered_replay,
    ready_shards,
    shard_edges,
    shard_generations,
    shard_parents,
    shard_vertices,
)
from .messages import (
    map_batches,
    map_messages,
    micro_batches,
    partition_by,
    route_batchers,
    split_failed,
    wrap_messages,
)
from .resume import missing_leases, multi_app_resume, resume_read

__all__ = [
    "LeaseChange",
    "apply_checkpoints",
    "checkpoints_from_acks",
    "close_shards",
    "completed_shards",
    "consumer_lag",
    "create_leases",
    "drop_redelivered",
    "fold_leases",
    "lease_actions",
    "lineage_cycles",
    "map_batches",
    "map_messages",
    "micro_batches",
    "missing_leases",
    "multi_app_resume",
    "ordered_replay",
    "partition_by",
    "pending_retries",
    "ready_shards",
    "renew_leases",
    "resume_read",
    "route_batchers",
    "shard_edges",
    "shard_generations",
    "shard_parents",
    "shard_vertices",
    "split_failed",
    "stale_leases",
    "take_leases",
    "wrap_messages",
]
