import random
import re

from fixtures import DOCS, awkward, nothing, prose
from pyspark.sql import functions as F

from shardweave.llm import decontamination as dc
from shardweave.llm.queries import QUERIES

ITEMS = "item_id long, text string, h long, words string, doc_id long"


def find(spark, docs, items):
    d = spark.createDataFrame([(i, t, None, None, None) for i, t in docs], DOCS)
    b = spark.createDataFrame([(i, t, None, None, None) for i, t in items], ITEMS)
    return {(r.doc_id, r.item_id): r for r in dc.contaminated(d, b).collect()}


QUESTION = "If Anna buys 12 apples for 3 dollars and Peter sells 5 km of rope to Anna, how many apples does Peter need to own before noon?"


def test_exact_and_changed_questions(spark):
    other = QUESTION.replace("Anna", "Berta").replace("Peter", "Otto").replace("12", "70").replace(" 5 ", " 8 ")
    swapped = QUESTION.replace("Peter", "Anna")  # two names became one
    mixed = QUESTION.replace("to Anna", "to Carla")  # one name became two, where windows overlap
    docs = [
        (1, prose(1, 50) + ". " + QUESTION + " " + prose(2, 50)),
        (2, prose(3, 20) + ". " + other),
        (3, prose(4, 300)),
        (4, QUESTION.upper()),
        (5, "  \n".join(QUESTION.split(" "))),
        (6, "so " + swapped),
        (7, "so " + mixed),
    ]
    got = find(spark, docs, [(9, QUESTION)])
    assert {d for d, _ in got} >= {1, 2, 5} and 3 not in {d for d, _ in got}
    assert got[1, 9].is_exact and not got[2, 9].is_exact and got[2, 9].n_values > 0
    assert (6, 9) not in got and (7, 9) not in got


def test_windows_of_placeholders_alone_do_not_count(spark):
    assert find(spark, [(1, "1 2 3 4 5 6 7 8 9 10 11 12")], [(1, "20 21 22 23 24 25 26 27 28 29")]) == {}


def test_short_items_match_whole_texts_only(spark):
    got = find(spark, [(1, "what is love"), (2, "tell me what is love now"), (3, "What is love?")], [(1, "What is love")])
    assert set(got) == {(1, 1), (3, 1)}


def test_short_items_with_values_are_found_in_longer_texts(spark):
    items = [(1, "Compute 17 + 25"), (2, "Add 3 apples to 4 green pears"), (3, "What is love")]
    docs = [
        (1, "Question: Compute 17 + 25 Answer 42"), (2, "Question: Compute 17 + 26 Answer 43"), (3, prose(70, 3000) + " compute 17 25 " + prose(71, 3000)),
        (4, "Please add 3 apples to 4 green pears, then stop and look around"), (5, "Please add 9 apples to 8 green pears, then stop and look around"),
        (6, "Please add nine apples to two green pears, then stop and look around"), (7, "tell me what is love 4 now"), (8, "add 3 apples to 4 green pears"),
        (9, "Please add 9 apples to 4 red pears, then stop and look around"),
    ]
    got = find(spark, docs, items)
    assert set(got) == {(1, 1), (3, 1), (4, 2), (5, 2), (6, 2), (8, 2)}
    assert got[4, 2].is_exact and got[8, 2].is_exact and not got[5, 2].is_exact and not got[6, 2].is_exact and got[6, 2].n_values == 2


def test_number_words_are_numbers(spark):
    item = "Tom has 3 red apples and buys 5 more from the small shop near his old house"
    docs = [
        (1, item.replace("3", "three").replace("5", "five")), (2, "so " + item.replace("3", "Seven").replace("5", "ninety")),
        (3, item.replace("apples", "plums").replace("buys", "gets").replace("shop", "inn").replace("small", "big").replace("3", "three")),
    ]
    got = find(spark, docs, [(1, item)])
    assert set(got) == {(1, 1), (2, 1)} and got[1, 1].is_exact and not got[2, 1].is_exact
    assert find(spark, [(1, item)], [(1, docs[0][1])])[1, 1].is_exact


def test_changed_figures_next_to_brute_force(spark):
    """Questions of a template with other figures, in words or digits, against a
    matcher that knows the template."""
    rng = random.Random(8)
    words = [w for w, n in dc.NUMBER_WORDS.items() if n < 20]
    frame = "a farmer sells {} brown hens and buys {} white geese at the market, then {} hens fly away over the hill"
    items = [(k, frame.format(*rng.sample(range(20, 90), 3))) for k in (1, 2)]
    docs, want = [], set()
    for k in range(60):
        fill = [rng.choice([str(n), w]) for n, w in zip(rng.sample(range(100, 900), 3), rng.sample(words, 3), strict=True)]
        text = frame.format(*fill)
        if changed := rng.random() < 0.4:  # other words throughout
            text = " ".join(w if i % 3 else w + "x" for i, w in enumerate(text.split()))
        docs.append((100 + k, f"{prose(k, 20)} {text} {prose(k + 500, 20)}"))
        if not changed:
            want.add(100 + k)
    assert {d for d, _ in find(spark, docs, items)} == want


def test_shared_windows_belong_to_the_least_item(spark):
    preamble = prose(50, 12)
    items = [(k, preamble + " " + prose(60 + k, 12)) for k in range(5)] + [(9, preamble)]
    got = find(spark, [(1, "x " + items[3][1]), (2, preamble)], items)
    assert {d for d, _ in got} == {1, 2} and (1, 3) in got and (1, 0) in got and (1, 1) not in got


def test_copies_in_any_case(spark):
    docs = [(4, QUESTION.upper()), (5, "so " + QUESTION.lower()), (6, "So " + QUESTION.title()), (7, QUESTION)]
    got = find(spark, docs, [(9, QUESTION)])
    assert set(got) == {(4, 9), (5, 9), (6, 9), (7, 9)} and all(r.is_exact for r in got.values())
    got = find(spark, docs, [(9, QUESTION.lower())])
    assert set(got) == {(4, 9), (5, 9), (6, 9), (7, 9)}


def test_copies_of_items_of_numbers(spark):
    items = [(1, "What is 12 + 30 + 7 + 9 + 11 + 4 + 8"), (2, "Is 12 + 30 right?")]
    docs = [(1, "so " + items[0][1].lower() + " then"), (2, "is 12 + 30 right"), (3, items[0][1].replace("30", "31")), (4, "Is 12 + 31 right?")]
    assert set(find(spark, docs, items)) == {(1, 1), (2, 2)}


def test_variants_of_a_template_are_items_of_their_own(spark):
    items = [(1, "Add 3 and 3 to the red box today"), (2, "Add 3 and 5 to the red box today")]
    got = find(spark, [(1, items[0][1]), (2, items[1][1]), (3, "add 7 and 9 to the red box today")], items)
    assert (2, 2) in got and got[2, 2].is_exact and (2, 1) not in got  # 3 cannot be 3 and 5
    assert (1, 1) in got and got[1, 1].is_exact
    assert (3, 2) in got and not got[3, 2].is_exact and (3, 1) not in got


def test_item_of_others_windows_is_found(spark):
    a, b, c = "put 3 red and two blue balls in", "box 4 and close the small lid now", "then walk home"
    items = [(1, f"{a} {b} {c}"), (2, f"{a} box 5 and close the small lid now {c}"), (3, f"put 9 red and two blue balls in {b} {c}")]
    items = [*items, (4, f"{a} {b}"), (5, f"{a} {b}")]  # all windows are item 1's
    got = find(spark, [(7, f"so {a} {b}")], items)
    assert (7, 1) in got and (7, 4) in got and (7, 5) not in got


def test_template_words(spark):
    texts = ["He ran 5 km, then 1,000.5 m with Tom Smith. Then 7%!", None, "", "...", "in 3 Hours And"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(dc.template_words(F.coalesce("t", F.lit("")))).collect()]
    n, m, u = dc.NUMBER, dc.NAME, dc.UNIT
    assert got[0][:6] == ["he", "ran", f"{n}5", f"{u}km", "then", f"{n}10005"]
    assert f"{m}tom" in got[0] and f"{m}smith" in got[0] and got[0][-1] == f"{u}%" and "then" in got[0]
    assert got[1] == got[2] == got[3] == []
    assert got[4][:3] == ["in", f"{n}3", f"{u}hours"]


def test_awkward_and_empty(spark):
    docs = awkward(spark)
    items = spark.createDataFrame([(1, prose(2, 60), None, None, None), (None, prose(4, 40), None, None, None), (2, None, None, None, None)], ITEMS)
    got = {r.doc_id: r for r in dc.contaminated(docs, items).collect()}
    assert set(got) == {5, 6}
    assert dc.contaminated(nothing(spark, DOCS), items).collect() == []
    assert dc.contaminated(docs, nothing(spark, ITEMS)).collect() == []


def test_both_ways_of_joining(spark, monkeypatch):
    docs = spark.createDataFrame([(1, prose(5, 60), None, None, None)], DOCS)
    items = spark.createDataFrame([(1, prose(5, 60), None, None, None)], ITEMS)
    one = dc.contaminated(docs, items).collect()
    monkeypatch.setattr(dc, "MAX_BROADCAST_WINDOWS", 0)
    assert dc.contaminated(docs, items).collect() == one and len(one) == 1


def test_query(spark):
    sf = "/root/testdata/sf0.01"

    def words(t):
        return re.findall(r"\w+", t.lower())

    windows = set()
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[k : k + 8]) for k in range(len(w) - 7)}
    literal = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        w = words(r.text)
        if any(tuple(w[k : k + 8]) in windows for k in range(len(w) - 7)):
            literal.add(r.doc_id)
    assert {r.doc_id for r in QUERIES["op4_decontamination"](spark, sf).collect()} == literal
