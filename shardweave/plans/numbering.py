"""Exact row numbers inside groups of any size.

``row_number() OVER (PARTITION BY g ORDER BY o)`` puts a whole group into one
task.  That is fine for small groups and they stay as they are.  The rows of
large groups are range partitioned by (group, order) and written: a partition is
a slice, slices are counted, and a row's number is its number inside the slice
plus the sizes of the slices before.  Rows carry nothing but the number of their
slice, no row is dropped, and since the slices are a written table, a recomputed
task finds the same ones.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage_cut import cut_lineage

SLICE_ROWS = 1_000_000
MAX_PIVOTS = 200_000  # large groups, ~100 bytes each: the broadcast stays near 20 MB
MIN_SLICES = 16


@dataclass(frozen=True)
class Slicing:
    """``rows`` carries ``_slice`` (slices of a group follow its order) and
    ``_cut``, true in large groups, which may have more than one slice.  ``many``
    is false when there is no such group."""

    rows: DataFrame
    many: bool


def count_at_or_below(sorted_pivots: Column, key: Column, most: int) -> Column:
    """Binary search by halving steps: how many of up to ``most`` sorted values
    are <= key."""
    steps, step = [], 1
    while step <= most:
        steps.append(step)
        step *= 2
    return F.aggregate(
        F.array(*[F.lit(s) for s in reversed(steps)]),
        F.lit(0),
        lambda found, s: F.when(F.get(sorted_pivots, found + s - 1) <= key, found + s).otherwise(
            found
        ),
    )


def _join_groups(rows: DataFrame, few: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join with a small table by ``on``, where NULL equals NULL."""
    renamed = few.withColumnsRenamed({c: f"_of_{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in on]
    return rows.join(F.broadcast(renamed), same, "left").drop(*[f"_of_{c}" for c in on])


def slice_groups(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    slice_rows: int = SLICE_ROWS,
    max_pivots: int = MAX_PIVOTS,
    total: int | None = None,
) -> Slicing:
    """Cut the groups of more than ``slice_rows`` rows into order-consecutive
    slices of about that many, but no more slices than the session has shuffle
    partitions (or ``MIN_SLICES``).  Of more than ``max_pivots`` large groups only
    the largest are cut.  ``(group, order)`` should identify a row; copies of one
    row stay in one slice.  ``total`` is the number of rows, or a bound on it,
    where the caller has it; otherwise they are counted."""
    group = list(group)
    whole = df.withColumn("_slice", F.lit(0)).withColumn("_cut", F.lit(False))
    if (df.count() if total is None else total) <= slice_rows:
        return Slicing(whole, many=False)
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    large = cut_lineage(sizes.where(F.col("_n") > slice_rows))
    rows_in_large = large.agg(F.sum("_n")).first()[0]
    if rows_in_large is None:
        return Slicing(whole, many=False)

    # at most max_pivots groups can have more rows than this
    large = large.where(F.col("_n") > max(slice_rows, rows_in_large // max_pivots))
    most = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MIN_SLICES)
    slices = min(-(-rows_in_large // slice_rows), most)
    marked = _join_groups(df, large.select(*group, F.lit(True).alias("_large")), group)
    of_large = marked.where("_large").drop("_large")
    ranged = cut_lineage(
        of_large.repartitionByRange(slices, *map(F.col, group), *order).withColumn(
            "_slice", F.spark_partition_id()
        )
    )
    of_small = marked.where(F.col("_large").isNull()).drop("_large")
    rows = of_small.withColumn("_slice", F.lit(0)).withColumn("_cut", F.lit(False))
    return Slicing(rows.unionByName(ranged.withColumn("_cut", F.lit(True))), many=True)


def number_rows(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    name: str = "rn",
    slice_rows: int = SLICE_ROWS,
    max_pivots: int = MAX_PIVOTS,
    total: int | None = None,
    first: int | None = None,
) -> DataFrame:
    """Add ``name``: the 1-based position of each row inside its group.  With
    ``first``, only rows up to that position are kept; slices that begin beyond
    it are dropped before the shuffle."""
    group = list(group)
    cut = slice_groups(df, group, order, slice_rows, max_pivots, total)
    if not cut.many:
        plain = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        numbered = df.withColumn(name, plain.cast("long"))
        return numbered if first is None else numbered.where(F.col(name) <= first)

    earlier = (
        Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    # one row per slice of a large group, so no more rows than slices plus large groups
    offsets = (
        cut.rows.where("_cut")
        .groupBy(*group, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.sum("_n").over(earlier))
        .where(F.col("_before").isNotNull())
        .select(*group, "_slice", "_before")
    )
    before = F.coalesce("_before", F.lit(0))
    rows = _join_groups(cut.rows, offsets, [*group, "_slice"])
    if first is not None:
        rows = rows.where(before < first)
    inside = F.row_number().over(Window.partitionBy(*group, "_slice").orderBy(*order))
    numbered = rows.select(*df.columns, (inside + before).cast("long").alias(name))
    return numbered if first is None else numbered.where(F.col(name) <= first)
