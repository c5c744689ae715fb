"""shardweave: consuming and analysing sharded, append-only record streams with Spark."""

__version__ = "0.1.0"
