import random
from zlib import crc32

import numpy as np
import pytest
from fixtures import DOCS, awkward, nothing, prose

from shardweave.llm import toxicity as tx
from shardweave.llm.queries import QUERIES

SMALL = tx.Training(epochs=6, size=4, hidden=6, attention=4, window=16, stride=12)


def made(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words, bad = prose(seed * 1000 + i, rng.randint(5, 120)).split(" "), rng.random() < 0.4
        if bad:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(["vileword", "nastyword", "foulword"]))
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_gradients():
    t = tx.Training(size=3, hidden=4, attention=3)
    net = tx.Network(t)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    words = "alpha beta gamma delta epsilon zeta".split()
    rows, d = tx.stacked([np.array([0, 1, 2, 3]), np.array([4, 5]), np.array([5, 0, 1])]), np.array([1.0, -2.0, 0.5])

    def loss():
        return float((net.forward(net.projected(net.inputs(words)[0]), rows) * d).sum())

    x, source = net.inputs(words)
    p = net.projected(x)
    _, cache = net.forward(p, rows, keep=True)
    g = net.backward(p.shape, cache, d)
    g |= net.input_gradients(x, source, g.pop("projected"))
    for name, w in net.w.items():
        at = np.unravel_index(np.argmax(np.abs(g[name])), w.shape)
        old, e = w[at], 1e-3
        w[at] = old + e
        more = loss()
        w[at] = old - e
        less = loss()
        w[at] = old
        assert (more - less) / (2 * e) == pytest.approx(g[name][at], rel=2e-3, abs=1e-6), name


def test_windows_cover_every_word():
    for n in range(1, 300):
        starts = tx.window_starts(n, 64, 48)
        assert set().union(*(range(s, min(n, s + 64)) for s in starts)) == set(range(n))
        assert starts == sorted(set(starts)) and all(b - a <= 48 for a, b in zip(starts, starts[1:], strict=False))


def test_score_is_that_of_the_greatest_window():
    rows = made(120, 1)
    model = tx.fit([r[1] for r in rows], np.array([r[2] for r in rows]), 0.4, SMALL)
    text = prose(77, 200)
    words = tx.words_of(text)
    each = [model.logits([" ".join(words[s : s + 16])])[0] for s in tx.window_starts(len(words), 16, 12)]
    assert model.logits([text])[0] == pytest.approx(max(each), rel=1e-4)


def test_learns_and_takes_the_same_score_in_any_batch(spark):
    train, held = made(500, 2), made(200, 3)
    model = tx.fit([r[1] for r in train], np.array([r[2] for r in train]), 0.4, SMALL)
    scores = model.scores([r[1] for r in held])
    labels = np.array([r[2] for r in held])
    assert ((scores >= 0.5) == labels).mean() > 0.95
    assert np.allclose([model.scores([r[1]])[0] for r in held[:20]], scores[:20], atol=1e-4)


def test_awkward_and_empty(spark):
    docs = awkward(spark)
    rows = made(60, 4)
    model = tx.fit([r[1] for r in rows], np.array([r[2] for r in rows]), 0.4, SMALL)
    out = tx.score(docs, model).collect()
    assert len(out) == docs.count() and all(0 <= r.toxicity <= 1 for r in out)
    assert all(r.toxicity == 0 for r in out if not tx.words_of(r.text or ""))
    assert tx.score(nothing(spark, DOCS), model).collect() == []
    assert {r.toxicity for r in tx.score(docs, None).collect()} == {0.0}
    labels = "doc_id long, quality int, toxic int"
    assert tx.train(docs, nothing(spark, labels)) is None
    one = spark.createDataFrame([(5, 1, 1), (None, 1, 0), (6, 0, None), (7, 1, 1)], labels)
    assert tx.train(docs, one) is None  # one label alone teaches nothing
    assert tx.train(nothing(spark, DOCS), spark.createDataFrame([(1, 1, 0), (2, 1, 1)], labels)) is None


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op8_toxicity"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)
    bad = [r.score for r in rows if labels.get(r.doc_id) == 1]
    good = [r.score for r in rows if labels.get(r.doc_id) == 0]
    assert np.mean([b > g for b in bad for g in good]) > 0.85
