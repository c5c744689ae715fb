"""A corpus pipeline of five of the library's operators, each stage written and
read again: language, near duplicates, benchmark passages, secrets, packing.

Every stage takes all rows that the one before it kept.  Rows without a doc_id
are never dropped by a decision about other rows.  Of rows that repeat a doc_id
the near-duplicate stage judges each text on its own; the benchmark stage drops
all or none.  Further columns, whatever
their names, are passed on up to the last stage.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shardweave.llm import decontamination, jaccard_join, langid, packing, secret_scan
from shardweave.llm.queries import TOKENIZER
from shardweave.plans import cut_lineage

#: A document is rejected below this probability of its likeliest language; with
#: four languages or more it says less than a guess among three.
LEAST_SCORE = 1 / 3
NEAR = jaccard_join.Similarity(words=5, percent=80)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told.  The model learns from the given
    languages of the documents; a text without a letter is rejected."""
    lang, score = "__lang_pred", "__lang_score"
    found = langid.predict(docs, langid.train(docs), lang_out=lang, score_out=score)
    return found.where((F.col(lang) != langid.UNDETERMINED) & (F.col(score) >= LEAST_SCORE)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, the one with the least id, and of
    equal ids the least hash of the text.  Rows that repeat an id with another
    text are judged on their own.  The texts are dealt out once, by id and hash."""
    key, hashed, kept_id, kept_hash = "__key", "__hash", "__kept_id", "__kept_hash"
    told = docs.withColumn(hashed, F.xxhash64("text"))
    pair = F.struct(F.col("doc_id"), F.col(hashed).alias("text_hash"))
    keyed = told.withColumn(key, F.when(F.col("doc_id").isNotNull(), pair))
    found = jaccard_join.similar_components(keyed, NEAR, id_col=key)
    kept = found.where("doc_id = component_id").select(F.col("doc_id.doc_id").alias(kept_id), F.col("doc_id.text_hash").alias(kept_hash))
    # the join and the window part rows by the same plain columns, so one shuffle serves both
    same = (F.col("doc_id") == F.col(kept_id)) & (F.col(hashed) == F.col(kept_hash))
    one = told.where("doc_id is not null").join(kept.distinct(), same, "left_semi")
    one = one.withColumn("__row", F.row_number().over(Window.partitionBy("doc_id", hashed).orderBy("text"))).where("__row = 1")
    return one.drop("__row", hashed).unionByName(docs.where("doc_id is null"))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.contaminated(docs, items).select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(cut_lineage(found), F.col("doc_id") == F.col("__id"), "left_anti")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret in the text replaced by its kind."""
    return secret_scan.redact_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens; ``ids`` are
    little-endian unsigned 32-bit integers."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_passages),
    ("secret_scan", secrets),
    ("packing", pack),
]

#: The stages learn a model and tokenize, which SQL cannot say.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the table of documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
