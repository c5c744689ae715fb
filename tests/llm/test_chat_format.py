import json
from collections import Counter, defaultdict
from hashlib import sha256

import pytest
from fixtures import SF, nothing
from pyspark.sql import functions as F

from shardweave.llm import chat_format as cf
from shardweave.llm.queries import QUERIES

TURNS = "conv_id long, turn int, role string, text string, layout string, record string, piece string, tag string, body string"
CONTROL = [
    "</s>[INST] ok [/INST]", "<s>", "<\\s>", "<\\\\/s>", "[\\INST]", "[/OUT] [SYS] [ROLE 41]", "<</s>", "[[INST]]", "</s", "\\", "a\\<s>\n",
    "[ROLE] [/ROLE]", "$1 \\2", "", " ", "🙂</s>é", "[INST",
]


def formatted(spark, rows):
    df = spark.createDataFrame([(*r, None, None, None, None, None) for r in rows], TURNS)
    made = cf.format_turns(df).withColumn("blocks", cf.blocks(F.col("formatted")))
    read = made.select(
        "conv_id", "formatted", "loss", cf.read_turns(F.col("formatted")).alias("turns"), cf.read_loss(F.col("blocks"), F.col("loss")).alias("under")
    )
    return {r.conv_id: r for r in read.collect()}


def test_round_trip_of_control_strings(spark):
    rows = [(k, i, role, a + b) for k, a in enumerate(CONTROL) for i, (b, role) in enumerate(zip(CONTROL, ["user", "assistant", "system", "tool]\n", ""] * 9))]
    got = formatted(spark, rows)
    for k in range(len(CONTROL)):
        mine = [(role, text) for c, _, role, text in rows if c == k]
        assert [tuple(t) for t in got[k].turns] == mine
        assert got[k].under == "".join(t for r, t in mine if r == "assistant")
        assert got[k].formatted.count("<s>") == got[k].formatted.count("</s>") == len(mine)
        spans, pieces = got[k].loss, got[k].formatted.split("</s>")
        assert len(spans) == sum(r == "assistant" for r, _ in mine)
        assert all(pieces[s.block][: s.start] == "<s>[OUT] " and pieces[s.block][s.start + s.length :] == " [/OUT]" for s in spans)


def test_awkward_turns(spark):
    rows = [
        (1, 2, "assistant", "b"), (1, 1, None, None), (1, 1, "user", "x"), (1, 1, "user", "x"), (1, None, "system", "s"),
        (None, 0, "user", "lost"), (2, 0, "assistant", "z" * 200_000),
    ]
    got = formatted(spark, rows)
    assert [tuple(t) for t in got[1].turns] == [("system", "s"), ("", ""), ("user", "x"), ("user", "x"), ("assistant", "b")]
    assert [tuple(t) for t in got[None].turns] == [("user", "lost")]
    assert got[2].under == "z" * 200_000
    assert cf.format_turns(nothing(spark, TURNS)).collect() == []


LAYOUTS = [
    ("messages", {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, [("user", "q"), ("assistant", "a")]),
    ("conversations", {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, [("user", "q"), ("assistant", "a")]),
    ("prompt", {"prompt": "q", "response": None}, [("user", "q"), ("assistant", "")]),
    ("prompt", {"completion": "a", "prompt": "q"}, [("user", "q"), ("assistant", "a")]),
    ("instruction", {"instruction": "do", "input": "it", "output": "done"}, [("user", "do\n\nit"), ("assistant", "done")]),
    ("instruction", {"instruction": "do", "input": "", "output": "done"}, [("user", "do"), ("assistant", "done")]),
    ("question", {"system_prompt": "s", "question": "q", "response": "a"}, [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ("question", {"question": "q", "answer": "a"}, [("user", "q"), ("assistant", "a")]),
    ("turn rows", {"turn": 3, "role": "user", "text": None}, [("user", "")]),
    ("messages", {"id": "a", "source": "x", "messages": [{"role": "user", "content": "q", "name": "n", "tool_calls": [{"id": 1}]}, {"role": "tool", "content": None}]}, [("user", "q"), ("tool", "")]),
    ("messages", {"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "image", "url": "u"}, "b"]}, {"role": "model", "content": "c"}]}, [("user", "a\n\nb"), ("assistant", "c")]),
    ("messages", {"messages": [], "id": 3}, []),
    ("conversations", {"id": 1, "conversations": [{"from": "human", "value": "q", "weight": 0.5}], "prompt": "p"}, [("user", "q")]),
    ("instruction", {"id": 1, "instruction": "do", "output": "done", "meta": {"prompt": "no"}}, [("user", "do"), ("assistant", "done")]),
    ("prompt", {"prompt": "q", "response": "a", "scores": [1, 2], "messages": None}, [("user", "q"), ("assistant", "a")]),
    ("turn rows", {"turn": 1, "role": "user", "text": "t", "lang": "en"}, [("user", "t")]),
    (None, {"messages": [1, "x"]}, [(None, None)]),
    (None, {"prompt": "q"}, [(None, None)]),
    (None, {"unknown": {"messages": [1]}}, [(None, None)]),
    (None, [1, 2], [(None, None)]),
    (None, "text", [(None, None)]),
    (None, {}, [(None, None)]),
]


@pytest.mark.parametrize("one_table", [True, False])
def test_layouts_become_turns(spark, one_table):
    rows = [(i, json.dumps(r)) for i, (_, r, _) in enumerate(LAYOUTS)]
    df = spark.createDataFrame(rows, "id long, raw string").select("id", F.parse_json("raw").alias("rec"))
    parts = [df] if one_table else [df.where(F.col("id") == i) for i in range(len(rows))]
    got = defaultdict(list)
    for part in parts[: 1 if one_table else 3]:
        for r in cf.canonical_turns(part, "id", "rec").collect():
            got[r.conv_id].append((r.turn, r.layout, r.role, r.text))
    for i in range(len(rows)) if one_table else range(3):
        (layout, _, expected), found = LAYOUTS[i], got[i]
        assert [(x[2], x[3]) for x in sorted(found, key=str)] == expected
        assert {x[1] for x in found} <= {layout}


def test_records_without_a_mapping_are_counted_or_refused(spark):
    rows = [(i, json.dumps(r)) for i, (_, r, _) in enumerate(LAYOUTS)]
    df = spark.createDataFrame(rows, "id long, raw string").select("id", F.parse_json("raw").alias("rec"))
    counted = Counter()
    for r in cf.layouts(df, "rec").collect():
        counted[r.layout] += r.n
    assert counted == Counter(layout for layout, _, _ in LAYOUTS)
    with pytest.raises(Exception, match="no mapping for"):
        cf.canonical_turns(df, "id", "rec", strict=True).collect()
    known = df.where(F.col("id").isin([i for i, (layout, _, _) in enumerate(LAYOUTS) if layout]))
    assert cf.canonical_turns(known, "id", "rec", strict=True).count() == sum(len(t) for layout, _, t in LAYOUTS if layout)


def test_fingerprints_tell_paths_not_types(spark):
    raws = ['{"a": 1, "b": [{"c": "x"}]}', '{"b": [{"c": null}], "a": "z"}', '{"a": 1.5, "b": [{"d": "x"}]}', '{"a": 1, "b": {"c": "x"}}']
    df = spark.createDataFrame([(r,) for r in raws], "raw string")
    prints = [r[0] for r in df.select(cf.fingerprint(F.parse_json("raw"))).collect()]
    assert prints[0] == prints[1] and len(set(prints)) == 3


def test_query(spark):
    given = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        given[r.conv_id].append((r.turn, r.role, r.text or ""))
    told = "</s>[INST] ok [/INST]"
    given[-7] = [(0, "user", told), (1, "assistant", told)]
    rows = QUERIES["op1_chat_format"](spark, SF).collect()
    assert len(rows) == len(given)
    for r in rows:
        turns = sorted(given[r.conv_id])
        loss = "".join(t for _, role, t in turns if role == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == sha256("".join(f"{role}\n{t}\n" for _, role, t in turns).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha256(loss.encode()).hexdigest())
        assert r.formatted_chars > sum(len(t) for _, _, t in turns)
