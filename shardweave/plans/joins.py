"""Joins of a large, possibly skewed side with a keyed lookup."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup row (lease, shard, position) is some 200 bytes, so this is ~40 MB.
MAX_BROADCAST_ROWS = 200_000
# A key with more rows than this is spread over several tasks.
HOT_ROWS = 2_000_000


def count_up_to(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> int:
    """Number of rows, or ``max_rows + 1`` if there are more."""
    return df.limit(max_rows + 1).count()


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    return count_up_to(df, max_rows) <= max_rows


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    salt_by: Sequence[str] = (),
    fits: bool | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``facts`` with ``lookup`` on equal columns ``on``.

    The lookup is counted, up to the bound, unless the caller knows whether it
    ``fits``.  Within the bound it is broadcast and the facts are not shuffled.
    Beyond it both sides are shuffled, and with ``salt_by`` (columns that tell
    the facts of a key apart) the hot keys are spread: their facts are counted,
    each key gets one part per ``hot_rows`` facts, a fact's part is a hash of
    ``salt_by``, and the lookup row of the key is repeated once per part.  The
    result is the same either way: the columns of ``facts``, then the further
    ones of ``lookup``.
    """
    on = list(on)
    columns = facts.columns
    if how not in ("left_semi", "left_anti"):
        columns = columns + [c for c in lookup.columns if c not in on]
    if fits is None:
        fits = fits_broadcast(lookup, max_broadcast_rows)
    if fits:
        return facts.join(F.broadcast(lookup), on, how).select(*columns)
    if salt_by:
        sizes = facts.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
        # no more rows than facts / hot_rows; the bound is raised until they are few
        while not fits_broadcast(hot := _hot_keys(sizes, on, hot_rows), max_broadcast_rows):
            hot_rows *= 10
        return _salted_join(facts, lookup, hot, on, how, salt_by).select(*columns)
    return facts.join(lookup, on, how).select(*columns)


def _hot_keys(sizes: DataFrame, on: list[str], hot_rows: int) -> DataFrame:
    parts = F.ceil(F.col("_n") / hot_rows).alias("_parts")
    return sizes.where(F.col("_n") > hot_rows).select(*on, parts)


def _salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    hot: DataFrame,
    on: list[str],
    how: str,
    salt_by: Sequence[str],
) -> DataFrame:
    parts = F.coalesce("_parts", F.lit(1)).cast("long")
    salted = facts.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*salt_by), parts)
    )
    repeated = (
        lookup.join(F.broadcast(hot), on, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        .drop("_parts")
    )
    return salted.join(repeated, [*on, "_salt"], how)
