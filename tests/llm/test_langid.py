import random
import tracemalloc
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from fixtures import DOCS, awkward, nothing

from shardweave.llm import langid
from shardweave.llm.queries import QUERIES

ALPHABETS = {"aa": "abcde", "bb": "defgh", "cc": "жзийк"}


def made(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(ALPHABETS))
        words = ["".join(rng.choice(ALPHABETS[lang]) for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(3, 60))]
        rows.append((i, " ".join(words), lang))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    return langid.train(spark.createDataFrame(made(400), "doc_id long, text string, lang string"))


def test_learns(spark, model):
    rows = made(200, seed=2)
    out = langid.predict(spark.createDataFrame(rows, "doc_id long, text string, lang string"), model).collect()
    assert sum(r.lang == r.lang_pred for r in out) >= 198
    assert all(0 <= r.lang_score <= 1 for r in out)
    assert (model.table[:, :-1] == 0).mean() > 0.5  # sparse


def test_frequencies_are_counted_over_all_documents(spark):
    rows = [(i, "xyz" if i % 2 else "x", "aa" if i % 2 else "bb") for i in range(300)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), training=langid.Training(per_language=20))
    x = next(langid._buckets("x"))[0]
    y = next(langid._buckets("y"))[0]
    assert model.table[x, -1] == pytest.approx(np.log(301 / 301) + 1)
    assert model.table[y, -1] == pytest.approx(np.log(301 / 151) + 1)


def test_blocks_count_every_ngram_once():
    text = "".join(random.Random(4).choice("abcdef ") for _ in range(1000))
    whole = np.bincount(np.concatenate(list(langid._buckets(text))).astype(int), minlength=1 << langid.BITS)
    block, langid.BLOCK = langid.BLOCK, 7
    try:
        parts = np.bincount(np.concatenate(list(langid._buckets(text))).astype(int), minlength=1 << langid.BITS)
    finally:
        langid.BLOCK = block
    assert (whole == parts).all() and whole.sum() == 1000 + 999 + 998


def test_awkward(spark, model):
    docs = awkward(spark)
    out = langid.predict(docs, model)
    assert out.columns == [c for c in docs.columns if c != "lang_pred"] + ["lang_pred", "lang_score"]
    rows = out.collect()
    assert len(rows) == docs.count()
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters)
        assert r.lang_score == 0 if not letters else 0 < r.lang_score <= 1


def test_nothing_to_learn_from(spark):
    empty = nothing(spark, DOCS)
    assert langid.train(empty) is None
    assert langid.predict(empty, None).collect() == []
    row = langid.predict(spark.createDataFrame([(1, "abc")], "doc_id long, text string"), None).first()
    assert (row.lang_pred, row.lang_score) == ("und", 0.0)


def test_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op3_language_id"](spark, sf).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(lang[r.doc_id] == r.lang_pred for r in held) >= 0.97 * len(held)


def test_the_sample_is_not_copied_to_wider_types():
    n, grams = 50, 4_000
    places = list(range(n))
    at = [np.arange(grams, dtype=np.int32)] * n
    sample = pa.table({"place": places, "lang": ["a", "b"] * (n // 2), "buckets": at, "counts": [np.ones(grams, dtype=np.int32)] * n}).combine_chunks()
    idf = np.linspace(1, 2, 1 << langid.BITS)
    tracemalloc.start()
    items = langid._items(sample, idf, ("a", "b"), 50.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(items) == n and all(abs(x.sum() - 50) < 1e-9 for _, x, _ in items)
    assert peak < 1.5 * 8 * n * grams  # the features, and no other array of their size
