"""Order of sequence numbers.

A sequence number is a decimal digit string of up to 128 digits, too long for
DECIMAL(38), and plain string order puts '10' before '9'.  The order used
everywhere is (number of digits, digits).
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def seq_order(c) -> Column:
    """Sort key of a sequence number; use it in orderBy, max_by and windows."""
    c = _col(c)
    return F.struct(F.length(c).alias("digits"), c.alias("seq"))


def seq_after(c, bound) -> Column:
    """True where sequence number ``c`` is strictly after ``bound``."""
    c, bound = _col(c), _col(bound)
    longer = F.length(c) > F.length(bound)
    return longer | ((F.length(c) == F.length(bound)) & (c > bound))


def seq_at_or_after(c, bound) -> Column:
    """True where sequence number ``c`` is ``bound`` or comes after it."""
    c, bound = _col(c), _col(bound)
    return seq_after(c, bound) | (c == bound)
