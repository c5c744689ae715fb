"""A table of records as a Spark data source, in batch and as a stream.

    spark.dataSource.register(ShardRecords)
    spark.readStream.format("shard_records").option("path", ...).option("limit", 100)

The table is one that ``write_records`` wrote.  The offset of the stream is a map
from shard to the sequence number read last.  A micro-batch takes at most ``limit``
records after it of each shard, one partition per shard, and the engine's own log
of offsets is where a restarted query goes on.  What can be skipped is skipped by
the statistics of files and row groups.  Executors read the rows; planning reads
footers, and sequence numbers of the row groups that the next ``limit`` records lie in.
"""

import json
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..plans import ship
from .zones import POOLED, SHARD

_SHARD = "shard_id="
_NULL = "__HIVE_DEFAULT_PARTITION__"
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
Offsets = dict[str, str]


def _order(seq: str) -> tuple[int, str]:
    return len(seq), seq


class _Table:
    """The files of a table, by shard; any file system that Arrow opens.  ``ranges``
    keeps what was read of their footers."""

    def __init__(self, path: str, ranges: dict | None = None):
        self._ranges = {} if ranges is None else ranges
        self._group: tuple = (None, {})
        if "://" in path:
            self.files, self.root = pafs.FileSystem.from_uri(path)
        else:
            self.files, self.root = pafs.LocalFileSystem(), path.removeprefix("file:").rstrip("/")

    def _names(self, folder: str) -> list[pafs.FileInfo]:
        return self.files.get_file_info(pafs.FileSelector(folder, allow_not_found=True))

    def shards(self) -> dict[str, list[str]]:
        """Where the records of each shard lie: its folder, and files it has in common with others."""
        found = [i for i in self._names(self.root) if i.type == pafs.FileType.Directory and i.base_name.startswith(_SHARD)]
        places: dict[str, list[str]] = {}
        for name, path in ((unquote(i.base_name.removeprefix(_SHARD)), i.path) for i in found):
            if name == POOLED:
                for file in self.data([path]):
                    for shard in self._held(file):
                        places.setdefault(shard, []).append(file)
            elif name != _NULL:
                places.setdefault(name, []).append(path)
        return dict(sorted(places.items()))

    def data(self, places: list[str]) -> list[str]:
        """The files of these folders, and those told by themselves."""
        folders = [p for p in places if p.rsplit("/", 1)[1].startswith(_SHARD)]
        files = [p for p in places if p not in folders]
        for folder in folders:
            names = [i.path for i in self._names(folder) if i.type == pafs.FileType.File]
            files += [n for n in names if n.endswith(".parquet") and n.rsplit("/", 1)[1][0] not in "._"]
        return sorted(files)

    def _common(self, file: str) -> bool:
        """Whether a file is one that shards have in common, not of a shard so named."""
        if file.rsplit("/", 2)[1] != f"{_SHARD}{POOLED}":
            return False
        if (key := ("common", file)) not in self._ranges:
            self._ranges[key] = SHARD in pq.read_schema(file, filesystem=self.files).names
        return self._ranges[key]

    def _held(self, file: str) -> list[str]:
        """The shards in a file of the common folder."""
        if (key := ("held", file)) not in self._ranges:
            names = {POOLED}
            if self._common(file):
                whole = pq.ParquetFile(file, filesystem=self.files)
                parts = (whole.read_row_group(k, columns=[SHARD]).column(0) for k in range(whole.num_row_groups))
                names = {s for part in parts for s in part.unique().to_pylist()}
            self._ranges[key] = sorted(names)
        return self._ranges[key]

    def schema(self) -> T.StructType:
        """The schema as Spark wrote it, with the shard at the end."""
        for places in self.shards().values():
            for name in self.data(places):
                told = pq.read_schema(name, filesystem=self.files).metadata[_SPARK_SCHEMA]
                fields = [f for f in T.StructType.fromJson(json.loads(told)) if f.name not in ("seq_len", "shard_id", SHARD)]
                return T.StructType([*fields, T.StructField("shard_id", T.StringType())])
        raise ValueError(f"no records under {self.root}")

    def rows(self, shard: str, files: list[str], low: str | None, high: str | None, columns: list[str]) -> Iterator[pa.RecordBatch]:
        """Batches of the shard's rows after ``low`` up to ``high``."""
        size, seq = ds.field("seq_len"), ds.field("sequence_number")
        wanted = pc.scalar(True)
        if low is not None:
            wanted = wanted & ((size > len(low)) | ((size == len(low)) & (seq > low)))
        if high is not None:
            wanted = wanted & ((size < len(high)) | ((size == len(high)) & (seq <= high)))
        common = [f for f in files if self._common(f)]
        for some, which in (([f for f in files if f not in common], wanted), (common, wanted & (ds.field(SHARD) == shard))):
            if some:
                table = ds.dataset(some, format="parquet", filesystem=self.files)
                yield from table.to_batches(columns=columns, filter=which, batch_readahead=2, fragment_readahead=1)

    def _groups(self, file: str) -> list[tuple]:
        """(least, greatest, place) of the row groups of a file, by its statistics.
        Bounds are of length and digits apart, so they may be wider than the rows."""
        if file not in self._ranges:
            told, out = pq.read_metadata(file, filesystem=self.files), []
            at = {told.schema.column(k).name: k for k in range(told.num_columns)}
            for k in range(told.num_row_groups):
                size, seq = (told.row_group(k).column(at[c]).statistics for c in ("seq_len", "sequence_number"))
                if size is not None and seq is not None and size.has_min_max and seq.has_min_max:
                    out.append(((size.min, seq.min), (size.max, seq.max), k))
                else:
                    out.append(((0, ""), (1 << 31, ""), k))
            self._ranges[file] = out
        return self._ranges[file]

    def _numbers(self, shard: str, file: str, k: int) -> list[str]:
        """The shard's sequence numbers in a row group; the last group read of a common
        file is kept, since the next shard's records lie in it too."""
        if not self._common(file):
            return pq.ParquetFile(file, filesystem=self.files).read_row_group(k, columns=["sequence_number"]).column(0).to_pylist()
        if self._group[0] != (file, k):
            read = pq.ParquetFile(file, filesystem=self.files).read_row_group(k, columns=[SHARD, "sequence_number"])
            held: dict[str, list[str]] = {}
            for s, number in zip(read.column(SHARD).to_pylist(), read.column("sequence_number").to_pylist(), strict=True):
                held.setdefault(s, []).append(number)
            self._group = ((file, k), held)
        return self._group[1].get(shard, [])

    def end(self, shard: str, places: list[str], low: str | None, limit: int | None) -> str | None:
        """The sequence number of the ``limit``-th record after ``low``, or of the
        last there is; ``low`` if there is none.  Row groups are read from the least
        on, and no further than the records that are wanted can reach."""
        floor = (0, "") if low is None else _order(low)
        groups = [(least, most, f, k) for f in self.data(places) for least, most, k in self._groups(f) if most > floor]
        groups.sort(key=lambda g: g[0] if limit is not None else (-g[1][0],))
        best: list[str] = []
        for least, most, file, k in groups:
            if limit is not None and len(best) >= limit and _order(best[-1]) < least:
                break
            if limit is None and best and most[0] < len(best[-1]):
                break
            here = {s for s in self._numbers(shard, file, k) if _order(s) > floor}
            ordered = sorted({*best, *here}, key=_order)
            best = ordered[:limit] if limit is not None else ordered[-1:]
        return best[-1] if best else low


@dataclass
class _Shard(InputPartition):
    """The records of a shard after ``low`` up to ``high``, in these files."""

    shard: str
    files: list
    low: str | None
    high: str | None


class _Reading:
    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.names = options["path"], schema.names
        self.limit = int(options["limit"]) if options.get("limit") else None
        if self.limit is not None and self.limit < 1:
            raise ValueError("limit must be at least 1")

    def read(self, partition: _Shard) -> Iterator[pa.RecordBatch]:
        columns = [n for n in self.names if n != "shard_id"]
        for batch in _Table(self.path).rows(partition.shard, partition.files, partition.low, partition.high, columns):
            if batch.num_rows:
                shard = pa.array([partition.shard] * batch.num_rows, pa.string())
                by_name = dict(zip(columns, batch.columns, strict=True)) | {"shard_id": shard}
                yield pa.RecordBatch.from_arrays([by_name[n] for n in self.names], names=self.names)


class _Batch(_Reading, DataSourceReader):
    """All records after the positions in option ``after`` (a map as JSON); with ``limit`` the first of each shard."""

    def __init__(self, options: dict, schema: T.StructType):
        super().__init__(options, schema)
        self.after: Offsets = json.loads(options.get("after") or "{}")

    def partitions(self) -> list[_Shard]:
        table, out = _Table(self.path), []
        for shard, places in table.shards().items():
            low = self.after.get(shard)
            high = None if self.limit is None else table.end(shard, places, low, self.limit)
            if self.limit is not None:
                out.append(_Shard(shard, table.data(places), low, high))
            else:  # nothing holds the files of a shard together
                out += [_Shard(shard, [f], low, None) for f in table.data(places)]
        return out


class _Stream(_Reading, DataSourceStreamReader):
    def __init__(self, options: dict, schema: T.StructType):
        super().__init__(options, schema)
        self.after: Offsets = json.loads(options.get("after") or "{}")
        self.log = options.get("checkpointLocation")
        self.at: Offsets | None = None
        self.ranges: dict = {}

    def initialOffset(self) -> dict:
        return dict(self.after)

    def _logged(self) -> Offsets | None:
        """The newest offset in the query's own log: a batch it names is run before any other."""
        if not self.log:
            return None
        log = _Table(self.log)
        names = [i.base_name for i in log._names(f"{log.root}/offsets") if i.base_name.isdigit()]
        if not names:
            return None
        with log.files.open_input_stream(f"{log.root}/offsets/{max(names, key=int)}") as file:
            last = file.read().decode().strip().split("\n")[-1]
        return json.loads(last) if last != "-" else None

    def latestOffset(self) -> dict:
        if self.at is None:  # the first call of this run; a logged batch was planned already if it has to run
            self.at = self._logged() or self.initialOffset()
        table = _Table(self.path, self.ranges)
        ends = {s: table.end(s, places, self.at.get(s), self.limit) for s, places in table.shards().items()}
        self.at = self.at | {s: e for s, e in ends.items() if e is not None}
        return dict(self.at)

    def partitions(self, start: dict, end: dict) -> list[_Shard]:
        table = _Table(self.path)
        if self.at is None:
            self.at = dict(end)
        moved = [(s, places) for s, places in table.shards().items() if end.get(s) is not None and end.get(s) != start.get(s)]
        return [_Shard(s, table.data(places), start.get(s), end[s]) for s, places in moved]

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class ShardRecords(DataSource):
    """Records of a table kept per shard.  Options: ``path``; ``limit``, the most
    records of a shard in a micro-batch (a stream) or at all (a batch); ``after``, a
    map of shards to sequence numbers as JSON to begin after.  A stream needs its
    ``checkpointLocation`` as an option of the reader too."""

    @classmethod
    def name(cls) -> str:
        return "shard_records"

    def schema(self) -> T.StructType:
        return _Table(self.options["path"]).schema()

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Batch(dict(self.options), schema)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        # options come with lower-case names
        options = dict(self.options) | {"checkpointLocation": self.options.get("checkpointLocation")}
        return _Stream(options, schema)


def _options(path: str, limit: int | None, after: Offsets | None) -> dict[str, str]:
    told = {"path": path, "limit": limit, "after": json.dumps(after) if after else None}
    return {k: str(v) for k, v in told.items() if v is not None}


def read_shards(spark: SparkSession, path: str, after: Offsets | None = None, limit: int | None = None) -> DataFrame:
    """The records of each shard after the given positions, at most ``limit`` of each."""
    ship(spark)
    spark.dataSource.register(ShardRecords)
    return spark.read.format("shard_records").options(**_options(path, limit, after)).load()


def stream_shards(
    spark: SparkSession, path: str, checkpoint_location: str, limit: int, after: Offsets | None = None
) -> DataFrame:
    """The same as a stream: each micro-batch holds at most ``limit`` records of a
    shard.  ``checkpoint_location`` is that of the query the stream is written by."""
    ship(spark)
    spark.dataSource.register(ShardRecords)
    options = _options(path, limit, after) | {"checkpointLocation": checkpoint_location}
    return spark.readStream.format("shard_records").options(**options).load()
