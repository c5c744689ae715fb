import corpus_pipeline as cp
import pytest
from fixtures import DOCS, SF, awkward, linked, nothing, prose

from shardweave.llm import packing


@pytest.fixture(scope="module")
def stages():
    return dict(cp.STAGES)


def test_every_stage_takes_awkward_and_empty_tables(spark, tmp_path):
    for docs in (awkward(spark), nothing(spark, DOCS)):
        for name, stage in cp.STAGES:
            out = stage(spark, docs, SF)
            if name != "packing":
                assert out.columns == docs.columns
            path = f"{tmp_path}/{name}-{docs.count()}"
            out.write.mode("overwrite").parquet(path)
            docs = spark.read.schema(out.schema).parquet(path)


def test_run_against_its_parts(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = cp.run(spark, SF).collect()
    kept = {r.doc_id for r in out}
    components = linked([(i, t) for i, t in rows.items() if any(c.isalpha() for c in t)], 5, 80)
    assert {components[i][1] for i in kept} == kept  # one document of each group
    encoder = packing.byte_bpe(cp.TOKENIZER)
    texts = {}
    for r in sorted(out, key=lambda r: r.start):
        texts[r.doc_id] = texts.get(r.doc_id, b"") + bytes(r.ids)
    import numpy as np

    changed = 0
    for i, ids in texts.items():
        text = encoder.decode(np.frombuffer(ids, "<u4")[:-1].tolist())
        changed += text != rows[i]
        assert text == rows[i] or "[assign]" in text or "[hex]" in text
    assert changed < 0.1 * len(kept) and len(kept) > 0.7 * len(rows)


def test_clean_documents_stay_and_others_go(spark, stages):
    rows = [(i, prose(i, 80), "en", None, None) for i in range(30)]
    rows += [(40, rows[3][1], "en", None, None), (41, rows[4][1] + " more words", "en", None, None), (3, rows[3][1], "en", None, None), (50, "123", None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    found = stages["language_id"](spark, docs, SF)
    assert sorted(r.doc_id for r in found.collect()) == sorted(r[0] for r in rows if r[0] != 50)
    left = stages["near_duplicates"](spark, found, SF)
    assert sorted(r.doc_id for r in left.collect()) == list(range(30))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    leaked = left.union(spark.createDataFrame([(60, prose(90, 20) + ". " + item, "en", None, None)], DOCS))
    assert sorted(r.doc_id for r in stages["decontamination"](spark, leaked, SF).collect()) == list(range(30))


def test_other_texts_under_one_id_are_judged_on_their_own(spark, stages):
    copied = prose(3, 80)
    rows = [(3, copied), (5, "z " + prose(5, 80)), (5, copied + " more"), (6, prose(6, 80)), (6, "a " + prose(7, 80)), (6, prose(6, 80)), (None, copied)]
    docs = spark.createDataFrame([(i, t, "en", None, None) for i, t in rows], DOCS)
    left = [(r.doc_id, r.text) for r in stages["near_duplicates"](spark, docs, SF).collect()]
    assert sorted(left, key=repr) == sorted([rows[0], rows[1], rows[3], rows[4], rows[6]], key=repr)


def test_near_duplicates_deal_texts_out_once(spark, stages):
    """One shuffle between the texts and what is left of them, for the join and the window together."""
    rows = [(i, prose(i, 80), "en", None, None) for i in range(30)] + [(3, prose(3, 80), "en", None, None)]
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        left = stages["near_duplicates"](spark, spark.createDataFrame(rows, DOCS), SF)
        assert sorted(r.doc_id for r in left.collect()) == list(range(30))
        lines = left._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    depth = [next((i for i, c in enumerate(x) if c.isalpha() or c == "*"), 0) for x in lines]
    at = next(i for i, x in enumerate(lines) if "Scan" in x and "text" in x)
    above, least = [], depth[at]
    for i in reversed(range(at)):
        if depth[i] < least:
            above.append(lines[i])
            least = depth[i]
    assert sum("Exchange" in x for x in above) == 1, "\n".join(lines)
