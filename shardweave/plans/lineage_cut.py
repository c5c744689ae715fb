"""Cutting the lineage of iterative jobs on storage that outlives executors."""

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from itertools import count
from uuid import uuid4
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
# what a cut shuffled is of no use once its table is written
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_CUTS_PER_GC = 4
_paths: ContextVar[Iterator[str] | None] = ContextVar("cut paths", default=None)
_cuts = count(1)
_tables: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.  Only a local
    session without that setting gets a folder of its own; a cluster without it
    is an error, since a machine-local folder would be lost with its machine."""
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_SETTING} to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="shardweave-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


@contextmanager
def cuts_in(folder: str) -> Iterator[None]:
    """Within, tables go to ``folder`` under running numbers and replace those
    of an earlier use, so that a job that repeats for ever does not fill the
    checkpoint folder.  DataFrames must not be used after the next use."""
    token = _paths.set(f"{folder}/cut-{i}" for i in count())
    try:
        yield
    finally:
        _paths.reset(token)


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Within, the session has these settings; afterwards its own again."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def cut_lineage(df: DataFrame, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder and return it read from
    there: its plan is a scan with known size, whatever led to it.  Spark removes
    the shuffle files of the write when it ends, so a chain of cuts holds those of
    one cut at a time on disk.  Python workers get at most ``batch_rows`` rows at once.

    Broadcast tables and other state of the plans before a cut go when the driver
    collects its garbage.  Many small jobs let its heap grow to the limit first, so
    every few cuts ask for it, which also gives the memory back to the machine."""
    spark, paths = df.sparkSession, _paths.get()
    path = next(paths) if paths else f"{checkpoint_dir(spark)}/cut-{uuid4().hex}"
    with _settings(spark, {_CLEANUP: "true"} | ({_BATCH_ROWS: str(batch_rows)} if batch_rows else {})):
        df.write.mode("overwrite").parquet(path)
    if next(_cuts) % _CUTS_PER_GC == 0:
        spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    _tables[out] = path
    return out


def drop_cut(cut: DataFrame) -> None:
    """Delete the table of ``cut``, which :func:`cut_lineage` returned.  All that is
    made from it must be written before; neither it nor what it led to can be
    computed again."""
    path = _tables.pop(cut)
    context = cut.sparkSession.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
