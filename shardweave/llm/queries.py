"""Registered queries of this package, and their SQL where it can say the same."""

import json

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat_format,
    conversation_repair,
    decontamination,
    fill_in_middle,
    html_extract,
    jaccard_join,
    langid,
    license_scan,
    packing,
    quality_rules,
    secret_scan,
    toxicity,
    url_filter,
)
from .common import crc_remainder, id_and_text, table
from .oracles import CONVERSATION_REPAIR, FILL_IN_MIDDLE, license_sql

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = chat_format.turn_records(table(spark, sf_dir, "conversations"))
    told = "</s>[INST] ok [/INST]"
    message = {"messages": [{"role": r, "content": told} for r in ("user", "assistant")]}
    extra = spark.range(1).select(
        F.lit(-7).cast(records.schema["conv_id"].dataType).alias("conv_id"), F.parse_json(F.lit(json.dumps(message))).alias("record")
    )
    turns = chat_format.canonical_turns(records.union(extra), "conv_id", "record")
    made = chat_format.format_turns(turns)
    read = made.select(
        "conv_id",
        "loss",
        chat_format.blocks(F.col("formatted")).alias("blocks"),
        chat_format.read_turns(F.col("formatted")).alias("turns"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
    told = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        chat_format.read_loss(F.col("blocks"), F.col("loss")).alias("under_loss"),
        "formatted_chars",
    )
    return read.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.char_length("under_loss").cast("long").alias("loss_chars"),
        F.sha2("under_loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "loss_tokens"
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(crc_remainder("doc_id", 5) != 0))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", (crc_remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(id_and_text(table(spark, sf_dir, "documents")))
    spans = F.col("secret_spans")

    def joined(of):
        return F.array_join(
            F.transform(of, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"].isin([r.kind for r in secret_scan.BASE_RULES]))
    return found.select(
        "doc_id",
        *[count(r.kind) for r in secret_scan.BASE_RULES],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    )


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = html_extract.extract(pages.select("page_id", "url", "html"), html_extract.train(pages))
    text = F.col("main_text")
    return found.select("page_id", "url", text.alias("text"), F.char_length(text).cast("long").alias("n_chars"))


TOXIC_FROM = 0.7


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(crc_remainder("doc_id", 3) != 1))
    found = toxicity.score(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        (crc_remainder("doc_id", 3) == 1).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


#: The rules that the contract of this query states.
URL_RULES = tuple(
    url_filter.Rule(*r.split(" "))
    for r in ("allow com/", "block example.com/en/", "allow www.example.com/en/", "block net/es/", "block net/fr/")
)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_components(table(spark, sf_dir, "documents"), jaccard_join.Similarity(words=3, percent=90))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.repair_report(rows, present=F.col("present"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.find_licenses(id_and_text(table(spark, sf_dir, "documents")))
    places = F.col("license_places")
    base = F.filter(places, lambda p: p["base"])

    def labels(of):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda p: p["label"]))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda p: p["start"])).alias("first_word"),
        F.array_max(F.transform(base, lambda p: p["start"])).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(places).alias("labels"),
        license_scan.covered_share(places, F.col("n_words")).alias("score"),
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        F.col("n_units").alias("n"),
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_packing": op2_packing,
    "op3_language_id": op3_language_id,
    "op4_decontamination": op4_decontamination,
    "op5_quality_rules": op5_quality_rules,
    "op6_secret_scan": op6_secret_scan,
    "op7_html_extract": op7_html_extract,
    "op8_toxicity": op8_toxicity,
    "op9_url_filter": op9_url_filter,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_license_scan": op12_license_scan,
    "op13_fill_in_middle": op13_fill_in_middle,
}
#: SQL that DuckDB can run.  The other operators learn, tokenize or tell positions
#: of matches, and are tested against brute force instead.
ORACLES: dict[str, str] = {
    "op1_chat_format": r"""WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
  escaped AS (
    SELECT *, regexp_replace(text,
        '([<\[])(\\*)(/?s>|/?(?:INST|OUT|SYS|ROLE)(?: [0-9A-F]*)?\])', '\1\\\2\3', 'g') AS body,
      CASE role WHEN 'user' THEN 22 WHEN 'assistant' THEN 20 WHEN 'system' THEN 20
        ELSE 23 + length(hex(role)) END AS marks
    FROM turns)
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length(body) + marks) AS BIGINT) AS formatted_chars
  FROM escaped GROUP BY conv_id""",
    "op10_jaccard_join": r"""WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda x: x <> '') AS l FROM documents),
  shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(l) = 0 THEN [] WHEN len(l) < 3 THEN [array_to_string(l, ' ')]
      ELSE list_transform(range(1, len(l) - 1), lambda i: l[i] || ' ' || l[i + 1] || ' ' || l[i + 2]) END) AS g
    FROM words),
  sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
  common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
  links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * c >= 90 * (x.n + y.n - c)),
  both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
  reach AS (
    SELECT doc_id, doc_id AS r FROM documents
    UNION SELECT l.b, reach.r FROM reach JOIN both_ways l ON l.a = reach.doc_id)
  SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r) AS component_id
  FROM documents d JOIN reach USING (doc_id) LEFT JOIN sizes USING (doc_id) GROUP BY d.doc_id""",
    "op11_conversation_repair": CONVERSATION_REPAIR,
    "op12_license_scan": license_sql(license_scan.BASE_PHRASES, license_scan.TEMPLATES),
    "op13_fill_in_middle": FILL_IN_MIDDLE,
}
