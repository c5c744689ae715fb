"""Reading and writing records, shard listings and lease tables."""

from .lease_store import LeaseStore, lease_lookup
from .listing import active_streams, listing_pages, shard_listing
from .records import (
    encode_records,
    poll_pacing,
    read_limited,
    read_records,
    read_table,
    read_unread,
    write_records,
)
from .routing import route_to_shard
from .shard_source import ShardRecords, read_shards, stream_shards
from .zones import index_zones, newest_records, read_zones, unread_files

__all__ = [
    "LeaseStore",
    "ShardRecords",
    "active_streams",
    "encode_records",
    "index_zones",
    "lease_lookup",
    "listing_pages",
    "newest_records",
    "poll_pacing",
    "read_limited",
    "read_records",
    "read_shards",
    "read_table",
    "read_unread",
    "read_zones",
    "route_to_shard",
    "shard_listing",
    "stream_shards",
    "unread_files",
    "write_records",
]
