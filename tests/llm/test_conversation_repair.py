import random
import re
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from fixtures import SF
from pyspark.sql import functions as F

from shardweave.llm import conversation_repair as cr
from shardweave.llm.queries import QUERIES

ROWS = "conv_id long, turn long, role string, text string"


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired rows) by trying every edit that may still end well."""
    faults, best = faults_of(rows), None

    def go(k, out, audit, cost, inserts):
        nonlocal best
        told = "".join(r[:1] or "?" for r, _ in out)
        if not re.fullmatch(r"s?(ua)*u?", told) or (best and cost > best[0]) or cost > 3 * len(rows):
            return
        if k == len(rows) and re.fullmatch(r"(s?(ua)+)?", told) and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, out)
        if inserts < 3:
            for r in ("user", "assistant"):
                go(k, [*out, (r, "")], audit + "I", cost + 2, inserts + 1)
        if k < len(rows):
            if faults[k] not in ("blank", "duplicate"):
                more = faults[k] == "truncated"
                go(k + 1, [*out, rows[k]], audit + "K", cost + more, 0)
                for r in ("user", "assistant"):
                    go(k + 1, [*out, (r, rows[k][1])], audit + "R", cost + 2 + more, 0)
            go(k + 1, out, audit + "D", cost + 3, 0)

    go(0, [], "", 0, 0)
    return best


def digest(rows):
    return sha256("\n".join(f"{r}:{t}" for r, t in rows).encode()).hexdigest()


def some_rows(rng, n):
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", " ", "su"]
    texts = ["a.", "b!", "c?", "no end", "", " \t", "x. \n", "é漢。", "a."]
    return [(rng.choice(roles), rng.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("held_bytes", [1, 40, 1 << 20])
def test_cheapest_edits_by_brute_force(held_bytes):
    rng, program = random.Random(held_bytes), cr.Program()
    for _ in range(400):
        rows = some_rows(rng, rng.randrange(6))
        walk = cr.Walk(program, held_bytes)
        for k, ((role, text), fault) in enumerate(zip(rows, faults_of(rows), strict=True)):
            walk.add(k, role, text, fault == "blank", fault != "truncated")
        audit, repaired = walk.finish()
        told = [(r.decode(), t.decode()) for _, r, t in repaired]
        assert (walk.cost, audit, told) == cheapest(rows)
        assert [walk.blank, walk.duplicate, walk.truncated] == [faults_of(rows).count(f) for f in ("blank", "duplicate", "truncated")]
        walk.close()


def test_a_long_conversation_spills_and_gives_the_same(spark):
    rng = random.Random(5)
    rows = [(1, k, *some_rows(rng, 1)[0]) if k % 3 else (1, k, rng.choice(["user", "assistant"]), f"t{rng.randrange(4000)}.") for k in range(12_000)]
    df = spark.createDataFrame(rows, ROWS)
    small = cr.repair_report(df, held_bytes=2000).collect()
    assert small == cr.repair_report(df).collect() and len(small[0].audit) >= 12_000


def test_seen_with_many_runs():
    rng = random.Random(2)
    seen, plain = cr.Seen(bound=3000), set()
    for _ in range(5000):
        d = rng.randrange(2500).to_bytes(16, rng.choice(["big", "little"]))
        assert seen.add(d) == (d in plain)
        plain.add(d)
    assert 1 < len(seen._runs) < 12
    seen.close()


def test_awkward_conversations(spark):
    rows = [
        (1, None, "user", "late?"), (1, 0, "user", "hi."), (1, 0, "user", "hi."), (1, 4, None, None), (1, 2, "assistant", "yes"),
        (None, 1, "user", "a."), (None, 2, "assistant", "b."), (2**62 + 1, 2**60 + 1, "assistant", "x."), (2**62 + 2, None, None, ""),
    ]
    df = spark.createDataFrame(rows, ROWS).withColumns({"cost": F.lit("x"), "id_known": F.lit(1), "present": F.lit(2)})
    out = {r.conv_id: r for r in cr.repair_report(df).collect()}
    assert set(out) == {1, None, 2**62 + 1, 2**62 + 2}
    first = [("user", "late?"), ("user", "hi."), ("user", "hi."), ("assistant", "yes"), (" ", " ")]
    cost, audit, told = cheapest(first)
    assert (out[1].cost, out[1].audit, out[1].repaired_sha256) == (cost, audit, digest(told))
    assert (out[1].gaps, out[1].blank, out[1].duplicate, out[1].truncated, out[1].illegal) == (2, 1, 1, 1, 3)
    assert (out[None].cost, out[None].audit) == (0, "KK")
    assert (out[2**62 + 1].cost, out[2**62 + 1].audit, out[2**62 + 1].gaps) == (2, "IK", 0)
    assert (out[2**62 + 2].gaps, out[2**62 + 2].blank, out[2**62 + 2].audit) == (0, 1, "D")
    turns = sorted((r.position, r.role, r.text, r.edit) for r in cr.repaired_turns(df).where("conv_id = 1").collect())
    assert [t[1:3] for t in turns] == told
    empty = spark.createDataFrame([], ROWS)
    assert cr.repair_report(empty).collect() == [] and cr.repaired_turns(empty).collect() == []
    absent = cr.repair_report(df, present=F.lit(False)).collect()
    assert {(r.gaps, r.cost, r.audit, r.repaired_sha256) for r in absent} == {(0, 0, "", sha256(b"").hexdigest())} and len(absent) == 4


def test_ids_of_text(spark):
    df = spark.createDataFrame([("b", 1, "user", "x."), (None, 1, "user", "y.")], ROWS.replace("conv_id long", "conv_id string"))
    assert {r.conv_id: r.audit for r in cr.repair_report(df).collect()} == {"b": "KI", None: "KI"}


def test_query_next_to_brute_force(spark):
    conversations = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        conversations[r.conv_id].append((r.turn, r.role, r.text))
    got = {r.conv_id: r for r in QUERIES["op11_conversation_repair"](spark, SF).collect()}
    assert set(got) == set(conversations)
    for key, rows in conversations.items():
        kept, turns = [], []
        for turn, role, text in sorted(rows):
            kind = zlib.crc32(f"{key}:{turn}".encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            row = ("user" if kind == 4 else role, text)
            for _ in range((1, 2)[kind == 3] if kind else 0):
                kept.append(row)
                turns.append(turn)
        if len(kept) > 7:
            continue  # too many ways; the SQL twin compares them all
        cost, audit, told = cheapest(kept)
        r = got[key]
        assert (r.cost, r.audit, r.repaired_sha256) == (cost, audit, digest(told))
        assert r.gaps == (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0)
