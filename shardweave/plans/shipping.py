"""The library on the executors."""

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this library to the executors' Python workers, once per application:
    the operators' functions are imported there, and it may not be installed."""
    context, root = spark.sparkContext, Path(__file__).parents[1]
    if context.applicationId in _SHIPPED or not root.is_dir():
        return
    archive = f"{tempfile.mkdtemp(prefix='shardweave-')}/shardweave.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    context.addPyFile(archive)  # Spark copies it to every executor
    _SHIPPED.add(context.applicationId)
