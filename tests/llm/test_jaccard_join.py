import random

import pytest
from fixtures import DOCS, SF, awkward, linked, nothing, prose

from shardweave.llm import jaccard_join as jj
from shardweave.llm.components import components
from shardweave.llm.queries import QUERIES
from shardweave.plans import cuts_in


def run(df, words, percent):
    rows = jj.similar_components(df, jj.Similarity(words, percent)).collect()
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}


def edited(text, seed, edits):
    rng, words = random.Random(seed), text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80)])
def test_families_copies_and_shared_passages(spark, words, percent):
    base, passage = prose(10, 120, 5000), prose(11, 60, 5000)
    texts = [edited(base, k, k % 5) for k in range(60)]  # near and exact copies
    texts += [passage + " " + prose(100 + k, 40 + 2 * k, 5000) for k in range(40)]  # a passage many share
    texts += [prose(300 + k % 7, 1 + k % 9) for k in range(40)]  # very short ones
    texts += [prose(500, 200, 3), prose(500, 200, 3).upper(), "a b", "A\tb", "", " "]
    rows = list(enumerate(texts))
    assert run(spark.createDataFrame(rows, "doc_id long, text string"), words, percent) == linked(rows, words, percent)


def test_edges_of_similarity(spark):
    """Pairs exactly at, above and below nine tenths."""
    rows, k = [], 0
    for n in (10, 19, 20, 29, 100):
        whole = [f"u{n}w{i}" for i in range(n + 2)]  # n shingles
        for cut in range(0, n // 5 + 2):
            rows.append((k, " ".join(whole[: len(whole) - cut])))
            k += 1
    assert run(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90) == linked(rows, 3, 90)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op10_jaccard_join"](spark, SF).collect()}
    assert got == linked(rows, 3, 90)


def test_awkward_and_empty(spark):
    docs = awkward(spark)
    rows = jj.similar_components(docs, jj.Similarity()).collect()
    assert len(rows) == docs.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id))
    assert by_id[0] == [(0, 0)] and by_id[1] == [(0, 1)] and by_id[2] == [(0, 2)]
    assert {c for _, c in by_id[5] + by_id[6]} == {5}
    assert jj.similar_components(nothing(spark, DOCS)).collect() == []


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(31)} | {100 + i: 100 for i in range(20)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_rows_without_an_id_carry_links(spark):
    words = prose(9, 120).split()
    texts = [" ".join(words), " ".join([*words[:-1], "q"]), " ".join([*words[:-1], "q", "r"])]  # 1-2-3, 1 and 3 apart
    sim = jj.Similarity(words=3, percent=98)
    whole = [(k, t) for k, t in enumerate(texts, 1)]
    assert len({c for _, c in linked(whole, 3, 98).values()}) == 1 and len({c for _, c in linked(whole[::2], 3, 98).values()}) == 2
    for missing in ([], [2], [1], [1, 2, 3]):
        rows = [(None if k in missing else k, t, None, None, None) for k, t in whole] * 2
        rows += [(None, prose(30 + k, 50), None, None, None) for k in range(3)]  # others without an id stay apart
        out = jj.similar_components(spark.createDataFrame(rows, DOCS), sim).collect()
        comps = linked(whole, 3, 98)
        least = {k: min((j for j in comps if comps[j][1] == comps[k][1] and j not in missing), default=None) for k, _ in whole}
        want = sorted([(None if k in missing else k, least[k]) for k, _ in whole] * 2 + [(None, None)] * 3, key=repr)
        assert sorted(((r.doc_id, r.component_id) for r in out), key=repr) == want


def test_texts_under_one_id_keep_their_own_links(spark):
    texts = [prose(40 + k, 60) for k in range(12)]
    rows = [(7, t, None, None, None) for t in texts] + [(100 + k, t, None, None, None) for k, t in enumerate(texts[:4])]
    out = jj.similar_components(spark.createDataFrame(rows, DOCS), jj.Similarity(words=3, percent=90)).collect()
    assert len(out) == 16 and {r.component_id for r in out} == {7}


def test_many_partitions_cost_few_tasks(spark):
    """Each step deals rows out anew as seldom as it can: with many partitions that is what small inputs cost."""
    base, partitions = prose(60, 120, 5000), 40
    texts = [edited(base, k, k % 5) for k in range(60)] + [prose(600 + k, 40, 50) for k in range(40)]
    texts += [" ".join([f"c{i + j}" for j in range(60)]) for i in range(12)]  # a chain of links
    rows = list(enumerate(texts))
    held = {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    context = spark.sparkContext
    context.setJobGroup("few tasks", "")
    try:
        got = run(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == linked(rows, 3, 90)
    tracker = context.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("few tasks") for s in tracker.getJobInfo(j).stageIds}
    tasks = sum(i.numCompletedTasks for s in stages if (i := tracker.getStageInfo(s)))
    assert tasks <= 90 * partitions


def test_sets_go_from_disk_once_they_are_used(spark, tmp_path):
    """Of the written tables none that is left holds sampled shingles or full sets."""
    base = prose(70, 120, 5000)
    rows = list(enumerate([edited(base, k, k % 5) for k in range(40)] + [prose(700 + k, 60) for k in range(20)]))
    with cuts_in(str(tmp_path)):
        got = run(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90)
    assert got == linked(rows, 3, 90)
    left = [spark.read.parquet(str(d)).columns for d in tmp_path.iterdir()]
    assert left and not [c for c in left if {"low", "shingles"} & set(c)]
