import re
from hashlib import sha256

import pytest
from fixtures import DOCS, awkward, nothing
from pyspark.sql import functions as F

from shardweave.llm import fill_in_middle as fim
from shardweave.llm.queries import QUERIES


def plain(doc_id, text, o=fim.Options()):
    """The same for one text, by its statement."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = sha256(f"{o.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(mark in text for mark in o.marks) or h[2] % 100 >= o.percent:
        return len(units), "plain", None, None, text
    P, S, M = o.marks
    if h[3] % 100 < o.spm_percent:
        return len(units), "spm", len(p), len(m), f"{S}{s}{P}{p}{M}{m}"
    return len(units), "psm", len(p), len(m), f"{P}{p}{S}{s}{M}{m}"


ODD = [None, "", "\n", "\n\n", "a", "a\n", "a\n\nb", "é\r\n漢🙂\nüb", "x<P>y\nz", "<", "<P\nS>\n<S", "M>\n>", " a\x0bb\x85\nc", "\n" * 5000, "x" * 200_000 + "\ny"]


@pytest.mark.parametrize("options", [fim.Options(), fim.Options(seed=3, percent=40, spm_percent=10, marks=("[a]", "[b]", "[c]"))])
def test_every_text_as_stated_and_back(spark, options):
    rows = [(i, ODD[i % len(ODD)]) for i in range(20 * len(ODD))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = fim.fill_in_middle(docs, options=options)
    for r in made.withColumn("back", fim.restored(F.col("output"), F.col("form"), options)).collect():
        text = rows[r.doc_id][1]
        assert (r.n_units, r.form, r.prefix_chars, r.middle_chars, r.output) == plain(r.doc_id, text, options)
        assert r.back == (text or "")
    assert {r.form for r in made.select("form").distinct().collect()} == {"plain", "psm", "spm"}


def test_awkward_rows_and_clashing_columns(spark):
    docs = awkward(spark).withColumns({"h1": F.lit("x"), "form": F.lit(1), "output": F.lit(None).cast("string")})
    got = sorted(fim.fill_in_middle(docs).collect(), key=repr)
    want = sorted(((r.doc_id, *plain(r.doc_id, r.text)) for r in docs.collect()), key=repr)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert fim.fill_in_middle(nothing(spark, DOCS)).collect() == []


def test_slices_by_bytes_change_nothing(monkeypatch):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["ab", None, "", "x" * 50, "c", "d"])], names=["text"])
    monkeypatch.setattr(fim, "SLICE_BYTES", 4)
    parts = list(fim._by_bytes(batch, 0))
    assert [x for p in parts for x in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert all(p.num_rows == 1 or sum(len(x or "") for x in p.column(0).to_pylist()) <= 4 for p in parts)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op13_fill_in_middle"](spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, form, p, m, out = plain(r.doc_id, docs[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, p, m)
        assert r.output_sha256 == sha256(out.encode()).hexdigest()
        assert r.restored_sha256 == sha256((docs[r.doc_id] or "").encode()).hexdigest()
