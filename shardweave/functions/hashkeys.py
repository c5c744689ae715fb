"""128-bit hash keys as 32 hex digits.

Listings carry decimal strings between 0 and 2^128 - 1 (39 digits), which no
Spark number holds.  As fixed-width lower-case hex, string order is numeric
order and ``md5`` already yields the same form.
"""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_HASH_KEY = str(2**128 - 1)

_CHUNK = 9  # digits taken per step: a 32-bit limb * 10^9 + carry fits a BIGINT
_LIMBS = ("a", "b", "c", "d")  # 32 bits each, least significant first


def _multiply_add(acc: Column, chunk: Column) -> Column:
    """acc * 10^9 + chunk over four limbs, one nested struct per carry."""
    fields, carry = [], chunk
    for name in _LIMBS:
        total = acc[name] * F.lit(10**_CHUNK).cast("long") + carry
        fields.append(total.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")).alias(name))
        carry = F.shiftright(total, 32)
    return F.struct(*fields)


def decimal_to_hex(c) -> Column:
    """Decimal string (0 .. 2^128 - 1) to 32 lower-case hex digits."""
    c = c if isinstance(c, Column) else F.col(c)
    width = 5 * _CHUNK
    padded = F.lpad(c, width, "0")
    chunks = F.array(
        *[F.substring(padded, 1 + i, _CHUNK).cast("long") for i in range(0, width, _CHUNK)]
    )
    zero = F.struct(*[F.lit(0).cast("long").alias(n) for n in _LIMBS])

    def render(acc: Column) -> Column:
        parts = [F.lpad(F.lower(F.hex(acc[n])), 8, "0") for n in reversed(_LIMBS)]
        return reduce(lambda x, y: F.concat(x, y), parts)

    return F.when(c.isNotNull(), F.aggregate(chunks, zero, _multiply_add, render))


def hash_key(partition_key) -> Column:
    """Hash key of a partition key: its MD5 as 32 hex digits."""
    c = partition_key if isinstance(partition_key, Column) else F.col(partition_key)
    return F.md5(c.cast("binary"))
