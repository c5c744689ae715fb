"""Column expressions: sequence-number order, hash keys, time arithmetic."""

from .hashkeys import MAX_HASH_KEY, decimal_to_hex, hash_key
from .ordering import seq_after, seq_at_or_after, seq_order
from .times import millis_between, plus_millis, wall_clock

__all__ = [
    "MAX_HASH_KEY",
    "decimal_to_hex",
    "hash_key",
    "millis_between",
    "plus_millis",
    "seq_after",
    "seq_at_or_after",
    "seq_order",
    "wall_clock",
]
