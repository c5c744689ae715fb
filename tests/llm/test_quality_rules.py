import math
import re
from collections import Counter

import pytest
from fixtures import DOCS, SF, WORD, awkward, nothing, prose
from pyspark.sql import functions as F

from shardweave.llm import quality_rules as qr
from shardweave.llm.queries import QUERIES

LABELS = "doc_id long, quality int, toxic int"


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    seen, cover = Counter(windows), set()
    for k, w in enumerate(windows):
        if seen[w] > 1:
            cover.update(range(k, k + 8))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover)


def check(rows, texts):
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == base(texts[r.doc_id])
        failed = got[0] < 20 or 100 * got[4] > 30 * got[0]
        assert r.base_failed == failed and not (failed and r.kept)


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op5_quality_rules"](spark, SF).collect()
    assert len(rows) == len(texts)
    check(rows, texts)


def test_base_measures_of_odd_texts(spark):
    texts = dict(enumerate([
        None, "", " \x0b\x0c", "a\xa0b c", "x\n\nx\n x\nx", "a b c d e f g h " * 3, "w " * 40, prose(1, 30) + "\n" + prose(1, 30), "#*$%&|<> é#",
        " ".join("abcdefgh") + " z " + " ".join("abcdefgh"), "q " + prose(2, 9) + " " + prose(2, 9) + " " + prose(3, 50), "\r\n".join(["ab"] * 9),
    ]))
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in texts.items()], DOCS)
    check(qr.judge(df, nothing(spark, LABELS)).collect(), texts)


def test_binomial_tail(spark):
    def tail(n, k, p):
        return sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))

    cases = [(n, k) for n in (1, 10, 500, 3000) for k in (0, 1, 3, 20) if k <= 0.02 * n or k == 0]
    df = spark.createDataFrame(cases, "n long, k long")
    for n, k, got in df.select("n", "k", qr.binomial_tail(F.col("n"), F.col("k"), 0.02)).collect():
        assert got == pytest.approx(tail(n, k, 0.02), rel=1e-9)
    far = spark.createDataFrame([(0, 0), (100, 50)], "n long, k long")
    assert [r[0] for r in far.select(qr.binomial_tail(F.col("n"), F.col("k"), 0.02)).collect()] == [1.0, 1.0]


def labelled(spark, n, bad_share=0.1, noise=0):
    rows, marks = [], []
    for i in range(n):
        bad = i % round(1 / bad_share) == 0
        text = prose(i, 30)
        rows.append((i, " | ".join(text.split(" ")) if bad or (noise and i % noise == 1) else text, "en", None, None))
        marks.append((i, int(not bad), 0))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(marks, LABELS)


def test_enough_evidence_gives_a_cutoff(spark):
    docs, labels = labelled(spark, 4000)
    rows = qr.judge(docs, labels).collect()
    assert all(r.kept == (r.doc_id % 10 != 0) for r in rows)


def test_too_little_evidence_gives_none(spark):
    docs, labels = labelled(spark, 300)
    assert all(r.kept for r in qr.judge(docs, labels).collect())


def test_cutoffs_that_lose_good_documents_do_not_pass(spark):
    docs, labels = labelled(spark, 4000, noise=10)  # as many good as bad documents look bad
    chosen = qr.cutoffs(qr.measures(docs), labels).collect()
    assert all(r.p_value <= 0.05 and r.n_rejected <= 0.01 * r.n_holdout for r in chosen)
    assert sum(not r.kept for r in qr.judge(docs, labels).collect() if r.doc_id % 10 == 1) == 0


def test_awkward_and_empty(spark):
    docs = awkward(spark)
    marks = spark.createDataFrame([(5, 1, 0), (5, 0, 0), (None, 1, 0), (7, None, 0)], LABELS)
    out = qr.judge(docs, marks).collect()
    assert len(out) == docs.count()
    assert [r.kept for r in out if r.doc_id in (5, 6, 7)] == [True] * 4
    assert qr.judge(nothing(spark, DOCS), nothing(spark, LABELS)).collect() == []
