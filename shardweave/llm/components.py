"""Connected components of an edge table of any size."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import cut_lineage


def _directed(edges: DataFrame) -> DataFrame:
    """(a, b) with a > b, each edge once."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _stars(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours move to the least node around it, then its
    smaller ones do: paths halve, hubs never gather their neighbours in one task.
    Between the two steps edges may repeat, and are written: they are read twice."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = cut_lineage(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    moved = large.join(least, "a").select("m", F.explode(F.array("a", "b")).alias("a"))
    return _directed(moved.select("a", F.col("m").alias("b")))


def _settled(edges: DataFrame) -> bool:
    """Whether every edge leads from a node with no other edge down to one that leads nowhere."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    loose = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return loose.where("down > 1 or (down = 1 and up = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of an edge ``(a, b)`` between two
    different nodes; the component is the least node in it.  Each round's edges
    are written, so its cost does not grow with the rounds before it."""
    edges = cut_lineage(_directed(edges))
    while not _settled(edges):
        edges = cut_lineage(_stars(edges))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select("b", "b").distinct()
    )
