import html
import math
import random
import re
from itertools import product

import pytest
from fixtures import SF, nothing

from shardweave.llm import html_extract as he
from shardweave.llm.queries import QUERIES

PAGES = "page_id long, url string, html string, main_text string, text string"


@pytest.fixture(scope="module")
def model():
    return he.train()


def article(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    inner = re.sub(r"</?(?:p|h1|div)\b[^>]*>", "\0", inner)
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in inner.split("\0")]
    return "\n\n".join(b for b in blocks if b)


def test_query(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = QUERIES["op7_html_extract"](spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == article(pages[r.page_id]) and r.n_chars == len(r.text)


def test_messages_give_exact_marginals():
    rng = random.Random(2)
    for _ in range(20):
        nodes = [he.Node("#root", -1, ["f0"])]
        for i in range(1, 8):
            n = he.Node("x", rng.randrange(i), [f"f{i}"])
            n.text = "t" if rng.random() < 0.4 else None
            nodes.append(n)
        own = {f"f{i}": rng.gauss(0, 2) for i in range(8)}
        between = tuple(tuple(tuple(rng.gauss(0, 2) for _ in range(2)) for _ in range(2)) for _ in range(2))
        weight, total = [0.0] * 8, 0.0
        for states in product((0, 1), repeat=8):
            score = sum(own[f"f{i}"] * s for i, s in enumerate(states))
            score += sum(between[nodes[i].text is not None][states[nodes[i].parent]][states[i]] for i in range(1, 8))
            total += math.exp(score)
            weight = [w + math.exp(score) * s for w, s in zip(weight, states, strict=True)]
        got = he.TreeModel(own, between).marginals(nodes)
        assert got == pytest.approx([w / total for w in weight], rel=1e-9)


def test_held_out_layouts(model):
    right = total = 0
    for page in he.written_pages(60, seed=99):
        for n, p in zip(page, model.marginals(page), strict=True):
            if n.text is not None:
                total += 1
                right += (p > 0.5) == n.label
    assert right >= 0.97 * total


def test_raw_elements_lose_no_more_than_themselves(model):
    text = "A long enough sentence that tells the reader something worth reading, twice over."
    for inside in ('<svg width="9"/>', "<math/>", "<svg><text>no</text></svg>", "<select><option>no"):
        page = f"<html><body><article><p>{text}</p><div>{inside}</div><p>After it: {text}</p></article></body></html>"
        got = model.text(page)
        assert got.startswith(text) and got.endswith(f"After it: {text}") and "no" not in got.split(), inside
    for tag in ("object", "noscript", "math"):
        assert model.text(f"<article><p>{text}</p><{tag}>{text}</{tag}><p>{text}</p></article>").count(text) == 3, tag
    assert "name=sidebar" in he._names('class="' + "p-4 flex m-2 " * 6 + 'sidebar"')


def test_parts_that_are_no_article(model):
    text = "A long enough sentence that tells the reader something worth reading, twice over."
    page = f"""<!DOCTYPE html><title>T</title><script>var a = "<p>no</p>";</script><style>p {{}}</style>
      <header class=site-header><p>Site name</p></header><nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>
      <div id="cookie-notice"><p>We use cookies.</p></div>
      <main><h1>Head &amp; line</h1><p>{text}<p>Second&nbsp;one:   {text}<br>after <b>that</b>
      <div class="ad-banner"><p>Buy this now.</p></div>
      <section id="comments"><p>First! I like this very much, it is a good article.</p></section></main>
      <aside class="sidebar"><p>Related things.</p></aside><form><label>Search</label><input><button>Go</button></form>
      <!-- <p>hidden</p> --><footer>&copy; somebody</footer>"""
    assert model.text(page) == f"Head & line\n\n{text}\n\nSecond one: {text} after that"


PROSE = "A long enough sentence that tells the reader something worth reading, twice over."
SHORT = "Two words."
NAV = "<nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>"


@pytest.mark.parametrize(
    ("page", "blocks"),
    [
        (PROSE, [PROSE]),
        (f"{PROSE}\n{PROSE}", [f"{PROSE} {PROSE}"]),
        (f"<p>{SHORT}</p>", [SHORT]),
        (f"<p>{PROSE}</p>", [PROSE]),
        (f"<html><body><p>{PROSE}</p></body></html>", [PROSE]),
        (f"<article><p>{PROSE}</p><p><a href=/x>A linked line</a></p><ul><li><a href=/1>One source</a></li><li><a href=/2>Other source</a></li></ul></article>",
         [PROSE, "A linked line", "One source", "Other source"]),
        (f"<html><body>{NAV}<article><h1>Head</h1><p>{PROSE}</p><h2>References</h2><ol><li><a href=/1>One source</a>, 1999</li><li><a href=/2>Other</a></li></ol></article></body></html>",
         ["Head", PROSE, "References", "One source, 1999", "Other"]),
        (f"<article><p>{PROSE}</p><section class=discussion><h2>Discussion</h2><p>{PROSE}</p></section><div class=notice-of-intent><p>{PROSE}</p></div></article>",
         [PROSE, "Discussion", PROSE, PROSE]),
        (f"<html><body>{NAV}<main><p>{PROSE}</p><p>{PROSE}</p><p>{PROSE}</p><div id=legal-notice><p>{PROSE}</p></div><section class=discussion><p>{PROSE}</p></section>"
         f"<ul><li><a href=/1>One source</a></li></ul></main><footer>&copy; x</footer></body></html>", [PROSE] * 5 + ["One source"]),
    ],
)
def test_no_text_of_an_article_is_lost(spark, model, page, blocks):
    assert model.text(page) == "\n\n".join(blocks)


def test_no_text_is_lost_with_the_model_of_the_tables_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    model = he.train(pages)
    test = test_no_text_of_an_article_is_lost
    for mark in test.pytestmark:
        for page, blocks in mark.args[1]:
            assert model.text(page) == "\n\n".join(blocks)
    test_parts_that_are_no_article(model)


@pytest.mark.parametrize(
    "page",
    [
        "", " ", "<", "<p", "</p></div>", "<!--", "<script>", "plain words", "<p>" * 3000, "<div>" * 3000 + "x", "a<b>c<", '<p class="x>y',
        "<a href='" + "x" * 5000, "&#xZZ; &am &nosuch;", "\0<p>\0", "<" * 5000, "<p a=\"" * 500,
    ],
)
def test_broken_pages_do_not_fail(model, page):
    assert isinstance(model.text(page), str)


def test_awkward_and_empty(spark, model):
    rows = [(1, None, None, "a", "b"), (None, "u", "", None, None), (2, "u", "<article><p>word</article>", None, None)] + [
        (3, "u", "<article><p>twice</article>", None, None)
    ] * 2
    rows.append((4, "u", "<article>" + "<p>many words here</p>" * 20_000 + "</article>", None, None))
    out = he.extract(spark.createDataFrame(rows, PAGES), model)
    found = sorted((str(r.page_id), r.main_text) for r in out.collect())
    assert found[0] == ("1", "") and found[1] == ("2", "word") and found[2] == found[3] == ("3", "twice") and found[-1] == ("None", "")
    assert found[4][1] == "\n\n".join(["many words here"] * 20_000)
    assert he.extract(nothing(spark, PAGES), model).collect() == []
