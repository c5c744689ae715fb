import random
import re
import time

import pytest
from fixtures import DOCS, awkward, nothing

from shardweave.llm import license_scan as ls
from shardweave.llm.oracles import _expression
from shardweave.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_expression(text, markup):
    """Places of a template by a regular expression over all words."""
    told = "".join(f" {w} " for w in words_of(text))
    return [
        (told.count(" ", 0, m.start()) // 2, told.count(" ", 0, m.end()) // 2) for m in re.finditer(_expression(markup), told)
    ]


def test_words_are_as_stated():
    for text in ("", "  ", "A-b_c9é!", "ÀÉ ﬁ漢 字", "a\x00b\x7fc{d}", "\ud800x"):
        assert [w for w in ls.normalize(text).decode("utf-8", "surrogatepass").split(" ") if w] == words_of(text)


@pytest.mark.parametrize(
    "markup",
    [
        "a b c",
        "<<beginOptional>>a<<endOptional>> b c <<beginOptional>>a b<<endOptional>>",
        "a <<var;name=x;match=.+;min=1;max=3>> b",
        "<<var;name=x;match=[ab];min=0;max=2>> c a",
        "<<beginOptional>>a <<beginOptional>>b<<endOptional>> c<<endOptional>> a <<var;name=x;match=(?:b|c);min=0;max=1>> b",
        "a <<beginOptional>>b <<var;name=x;match=.+;min=1;max=2>><<endOptional>> c",
    ],
)
def test_automaton_finds_what_the_expression_finds(markup):
    rng = random.Random(markup)
    template = (ls.Template("t", markup),)
    for _ in range(1500):
        text = " ".join(rng.choice("aabbccd") for _ in range(rng.randrange(14)))
        n, found = ls.scan(text, (), template)
        # the expression takes an optional region where it can, the automaton the longest match:
        # they may end elsewhere only if both are matches from one start
        want, got = by_expression(text, markup), [(s, e) for s, e, _ in found]
        assert n == len(text.split())
        assert [s for s, _ in got[:1]] == [s for s, _ in want[:1]]
        for s, e in got:
            assert re.fullmatch(_expression(markup), "".join(f" {w} " for w in text.split()[s:e]))
        assert all(a[1] <= b[0] for a, b in zip(got, got[1:], strict=False))
        if markup == "a b c":
            assert got == want


def test_mandatory_wording_must_be_exact():
    told = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."

    def labels(text):
        return {ls.TEMPLATES[k].label for _, _, k in ls.scan(text, (), ls.TEMPLATES)[1]}

    assert "isc" in labels(f"x {told} y") and "isc" in labels(told.replace("and/or", "and"))
    assert "isc" not in labels(told.replace("any purpose", "some purpose"))
    assert labels("This work is licensed under the GNU General Public License, version 3.") == {"gpl-3.0"}
    assert labels("Released under the MIT License.") == {"mit-notice"}
    assert labels("Licensed under CC BY-NC 4.0.") == {"cc-by-nc-4.0"}
    assert labels("Licensed under the Apache License, Version 2.0.") == {"apache-2.0"}
    assert labels("the Apache license of 2.0") == set()
    name = "Neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    assert labels(name.format("the University of Somewhere")) == {"bsd-3-clause"}
    assert labels(name.format("x " * 17)) == set()


@pytest.mark.parametrize("markup", ["", "<<beginOptional>>a<<endOptional>>", "<<beginOptional>>a", "a <<endOptional>>", "a <<other>>", "a <<var;min=3;max=2>>"])
def test_bad_markup_is_refused(markup):
    with pytest.raises(ValueError):
        ls.Automaton(ls.Template("t", markup))


def test_long_texts_take_linear_time():
    for text in ("under " * 300_000, "under the mit " * 100_000, "mit license " * 100_000, "(c) \n" * 500_000, "a" * 3_000_000):
        start = time.time()
        n, _ = ls.scan(text, ls.BASE_PHRASES, ls.TEMPLATES)
        assert n == len(words_of(text))
        assert time.time() - start < 20


def test_awkward_and_empty(spark):
    docs = awkward(spark).withColumnRenamed("words", "license_places")
    out = ls.find_licenses(docs)
    assert out.columns == [*[c for c in docs.columns if c != "license_places"], "n_words", "license_places"]
    got = sorted((repr(r.doc_id), r.text or "", r.n_words) for r in out.collect())
    assert got == sorted((repr(r.doc_id), r.text or "", len(words_of(r.text))) for r in docs.collect())
    assert ls.find_licenses(nothing(spark, DOCS)).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    asked = [(p.label, True, p.words) for p in ls.BASE_PHRASES] + [(t.label, False, t.markup) for t in ls.TEMPLATES]
    rows = QUERIES["op12_license_scan"](spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        words = words_of(docs[r.doc_id])
        found = [(label, base, s, e) for label, base, m in asked for s, e in by_expression(docs[r.doc_id], m)]
        base = sorted(s for _, b, s, _ in found if b)
        assert (r.n_words, r.n_base) == (len(words), len(base))
        assert (r.first_word, r.last_word) == ((base[0], base[-1]) if base else (None, None))
        assert r.base_labels == ",".join(sorted({x for x, b, _, _ in found if b}))
        assert r.labels == ",".join(sorted({x for x, _, _, _ in found}))
        covered = {w for _, _, s, e in found for w in range(s, e)}
        assert r.score == (len(covered) / len(words) if words else 0.0)
    assert {"gpl-3.0", "apache-2.0", "cc-by-nc-4.0", "mit-notice"} <= {x for r in rows for x in r.labels.split(",")}
