"""Folders on the file system a path names (local, HDFS, object store)."""

from pyspark.sql import SparkSession


class Folder:
    """A folder, through Hadoop's file system, so it may be anywhere Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        context = spark.sparkContext
        self._path = context._jvm.org.apache.hadoop.fs.Path(path)
        self._files = self._path.getFileSystem(context._jsc.hadoopConfiguration())
        self._new = context._jvm.org.apache.hadoop.fs.Path

    def names(self) -> list[str]:
        """What lies directly in it; nothing if it does not exist."""
        if not self._files.exists(self._path):
            return []
        return [s.getPath().getName() for s in self._files.listStatus(self._path)]

    def complete(self, name: str) -> bool:
        """Whether the job that wrote the table ``name`` was committed."""
        return self._files.exists(self._new(self._new(self._path, name), "_SUCCESS"))

    def size(self, name: str) -> int:
        return self._files.getContentSummary(self._new(self._path, name)).getLength()

    def remove(self, name: str) -> None:
        self._files.delete(self._new(self._path, name), True)
