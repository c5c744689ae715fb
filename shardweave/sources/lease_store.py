"""Lease tables: point lookups, and versions kept as a log of changes."""

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LEASES
from .folders import Folder


def lease_lookup(leases: DataFrame, keys: DataFrame) -> DataFrame:
    """For every key row the lease with the same ``(app_name, shard_id)`` and
    ``found``, false where there is none."""
    hits = leases.withColumn("found", F.lit(True))
    joined = keys.join(hits, ["app_name", "shard_id"], "left")
    return joined.withColumn("found", F.coalesce("found", F.lit(False)))


Version = tuple[int, int]


class _Part(NamedTuple):
    """Changes of the versions from ``first`` to ``last``.  A part of level 0 is
    of one version, one of level n + 1 holds what ``FAN`` parts of level n came to."""

    level: int
    first: Version
    last: Version

    @property
    def name(self) -> str:
        return f"changes-{self.level}-{self.first[0]}.{self.first[1]}-{self.last[0]}.{self.last[1]}"

    @staticmethod
    def named(name: str) -> "_Part | None":
        found = re.fullmatch(r"changes-(\d+)-(\d+)\.(\d+)-(\d+)\.(\d+)", name)
        if not found:
            return None
        level, *n = map(int, found.groups())
        return _Part(level, (n[0], n[1]), (n[2], n[3]))

    def holds(self, other: "_Part") -> bool:
        return self.level > other.level and self.first <= other.first and other.last <= self.last


class LeaseStore:
    """Versions of a keyed table, as a log of changes under ``path``.

    A version is a number, or a micro-batch and a step in it.  Writing one writes
    the rows that changed since the version before and the keys that are gone;
    reading takes the newest row of each key.  :meth:`compact` merges eight parts
    of a level into one of the next, so n versions leave some 8 log n parts, and a
    changed row is written once per level.  Parts that were merged are removed by
    the next compaction, so tables read before stay readable that long.

    Writing a version removes what was written from it on: a repeated micro-batch
    begins with the state before it.  So parts of several micro-batches are merged
    only when a later one has begun.
    """

    FAN = 8

    def __init__(self, spark: SparkSession, path: str, schema=LEASES, key: Sequence[str] = ("app_name", "shard_id")):
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, list(key)
        self.folder = Folder(spark, self.path)

    @staticmethod
    def _version(version: int | Version) -> Version:
        return (version, 0) if isinstance(version, int) else version

    def _all(self) -> list[_Part]:
        parts = filter(None, map(_Part.named, self.folder.names()))
        return sorted((p for p in parts if self.folder.complete(p.name)), key=lambda p: (p.first, p.level))

    def _parts(self, before: Version | None = None) -> list[_Part]:
        """The parts that make up the state before a version, in order."""
        fit = [p for p in self._all() if before is None or p.last < before]
        return [p for p in fit if not any(q.holds(p) for q in fit)]

    def versions(self) -> list[int] | list[Version]:
        """The newest version of every part; numbers if none has a step."""
        last = [p.last for p in self._parts()]
        return [batch for batch, _ in last] if not any(step for _, step in last) else last

    def write(self, version: int | Version, table: DataFrame) -> None:
        """Make ``table`` the state of ``version``.  Keys are unique in it."""
        version = self._version(version)
        for part in self._all():
            if part.last >= version:
                self.folder.remove(part.name)
        columns = [f.name for f in self.schema.fields]
        row = F.struct(*columns)
        old = self.read(version).select(*self.key, row.alias("old"), F.lit(None).cast(self.schema).alias("new"))
        new = table.select(*self.key, F.lit(None).cast(self.schema).alias("old"), row.alias("new"))
        both = old.unionByName(new).groupBy(*self.key).agg(F.max("old").alias("old"), F.max("new").alias("new"))
        changed = both.where(~F.col("new").eqNullSafe(F.col("old")))
        kept = F.when(F.col("new").isNull(), F.col("old")).otherwise(F.col("new"))
        at = F.struct(*(F.lit(n).cast("long").alias(c) for n, c in zip(version, ("batch", "step"), strict=True)))
        changes = changed.select(kept.alias("row"), F.col("new").isNull().alias("gone"), at.alias("at"))
        self._write(changes, _Part(0, version, version))

    def _write(self, changes: DataFrame, part: _Part) -> None:
        changes.write.mode("overwrite").parquet(f"{self.path}/{part.name}")

    def _newest(self, parts: Sequence[_Part]) -> DataFrame:
        """The newest change of each key: ``row``, whether it is ``gone``, and the version ``at`` which."""
        schema = f"row {self.schema.simpleString()}, gone BOOLEAN, at STRUCT<batch: BIGINT, step: BIGINT>"
        changes = self.spark.read.schema(schema).parquet(*[f"{self.path}/{p.name}" for p in parts])
        newest = F.max_by(F.struct("row", "gone", "at"), "at").alias("c")
        return changes.groupBy(*[F.col(f"row.{k}").alias(k) for k in self.key]).agg(newest).select("c.*")

    def read(self, before: int | Version | None = None) -> DataFrame:
        """The newest state, or the newest older than version ``before``; an
        empty table if there is none."""
        parts = self._parts(None if before is None else self._version(before))
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self._newest(parts).where("not gone").select("row.*")

    def _mergeable(self) -> Iterator[list[_Part]]:
        parts = self._parts()
        now = parts[-1].last[0] if parts else 0
        for done in (True, False):  # finished micro-batches; the present one
            own = [p for p in parts if (p.last[0] < now) == done]
            for level in {p.level for p in own}:
                same = [p for p in own if p.level == level]
                if len(same) >= self.FAN:
                    yield same

    def compact(self) -> None:
        """Remove parts that were merged before, and merge those that are many."""
        every = self._all()
        for part in every:
            if any(q.holds(part) for q in every):
                self.folder.remove(part.name)
        while groups := list(self._mergeable()):
            for group in groups:
                newest = self._newest(group)
                # where the group is all there was, nothing older needs to be told what is gone
                kept = newest.where("not gone") if self._parts(group[-1].last) == group[:-1] else newest
                self._write(kept, _Part(group[0].level + 1, group[0].first, group[-1].last))
