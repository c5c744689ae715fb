"""Helpers shared by the operators of this package."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are what lies between spaces and the control characters 9 to 13.
SPACE = r"[\x20\x09-\x0D]"
NO_SPACE = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, null text as empty: other columns, whatever
    their names, never meet the operator's own."""
    return docs.select(
        docs[id_col].alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")
    )


def crc_remainder(id_col: Column | str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as an empty text."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def in_slices(batches, rows: int = 512):
    """Arrow batches in slices of at most ``rows`` rows, which bound what a worker holds at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
