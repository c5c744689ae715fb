"""License scans by template markup.

A template is wording with optional regions and replaceable ones, in the public
markup of license lists:

    <<beginOptional>> ... <<endOptional>>      may be left out; may be nested
    <<var;name=year;match=[0-9]+;min=1;max=4>> min to max words, each as ``match``

All other words are mandatory and have to be there exactly, in order.  A template
is compiled to an automaton over words.  It is made deterministic as texts ask for
it; its input is a word of the template or a word's answers to the ``match``
expressions.

Most texts hold no template: the longest run of consecutive mandatory words is
looked for first, as plain bytes, and the automaton starts only where the run
stands, at as many words before it as the template can have there.  A text
without the run cannot match, so nothing is lost.  Every replaceable region has a
greatest length, so a match is of bounded length and the work grows with the text.
"""

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import ship
from .common import in_slices

#: A-Z to a-z; digits, a-z and all bytes of other characters stay; the rest parts words.
_WORD_BYTES = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b in _WORD_BYTES else 32 for b in range(256))


def normalize(text: str) -> bytes:
    """The words of a text, each between single spaces (a word is
    ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` once A-Z are lower case)."""
    data = b" " + text.encode("utf-8", "surrogatepass").translate(_TO_WORDS) + b" "
    while b"  " in data:
        data = data.replace(b"  ", b" ")
    return data


@dataclass(frozen=True)
class Phrase:
    label: str
    words: str


@dataclass(frozen=True)
class Template:
    label: str
    markup: str


#: The phrases that the contract of the query states.
BASE_PHRASES = (
    Phrase("gpl", "gnu general public license"),
    Phrase("apache", "apache license"),
    Phrase("cc-by", "cc by"),
    Phrase("mit", "mit license"),
)

_BY = (
    "<<beginOptional>><<beginOptional>>this work is<<endOptional>>"
    "<<beginOptional>>this software is<<endOptional>> licensed<<endOptional>>"
    "<<beginOptional>>released<<endOptional>> under <<beginOptional>>the<<endOptional>>"
)
#: Notices by which works name their license, and wordings of short licenses, from their public texts.
TEMPLATES = (
    Template("gpl-2.0", f"{_BY} gnu general public license <<beginOptional>>version<<endOptional>> <<var;name=v;match=v?2;min=1;max=1>>"),
    Template("gpl-3.0", f"{_BY} gnu general public license <<beginOptional>>version<<endOptional>> <<var;name=v;match=v?3;min=1;max=1>>"),
    Template(
        "gpl-or-later",
        "redistribute it and or modify it under the terms of the gnu <<var;name=kind;match=(?:lesser|library|affero);min=0;max=1>>"
        " general public license as published by the free software foundation"
        " either version <<var;name=v;match=[0-9]+;min=1;max=2>> of the license or at your option any later version",
    ),
    Template("apache-2.0", f"{_BY} apache license version 2.0"),
    Template(
        "apache-2.0",
        "licensed under the apache license version 2.0 the license you may not use"
        " <<var;name=what;match=.+;min=1;max=4>> except in compliance with the license",
    ),
    Template("cc-by-4.0", f"{_BY} <<beginOptional>>creative commons attribution<<endOptional>> cc by 4.0"),
    Template("cc-by-sa-4.0", f"{_BY} cc by sa 4.0"),
    Template("cc-by-nc-4.0", f"{_BY} cc by nc 4.0"),
    Template(
        "cc-by-nc-variant", f"{_BY} cc by nc <<var;name=more;match=(?:sa|nd);min=1;max=1>> <<var;name=v;match=[0-9]+;min=2;max=2>>"
    ),
    Template(
        "cc-by-legal",
        "licensed under <<beginOptional>>a<<endOptional>><<beginOptional>>the<<endOptional>> creative commons attribution"
        " <<var;name=terms;match=(?:noncommercial|sharealike|noderivatives|noderivs|share|alike|non|commercial|no|derivatives);min=0;max=6>>"
        " <<var;name=v;match=[0-9]+;min=2;max=2>> <<var;name=port;match=(?:international|generic|unported);min=0;max=1>> license",
    ),
    Template("mit-notice", f"{_BY} mit license"),
    Template(
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction including without limitation the"
        " rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit"
        " persons to whom the software is furnished to do so subject to the following conditions the above copyright notice"
        " and this permission notice <<beginOptional>>including the next paragraph<<endOptional>> shall be included in all"
        " copies or substantial portions of the software",
    ),
    Template(
        "bsd-2-clause",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the"
        " following conditions are met <<var;name=bullet;match=1;min=0;max=1>> redistributions of source code must retain the"
        " above copyright notice this list of conditions and the following disclaimer <<var;name=bullet;match=2;min=0;max=1>>"
        " redistributions in binary form must reproduce the above copyright notice this list of conditions and the following"
        " disclaimer in the documentation and or other materials provided with the distribution",
    ),
    Template(
        "bsd-3-clause",
        "<<beginOptional>>3<<endOptional>> neither the name of <<var;name=holder;match=.+;min=1;max=16>> nor the names of its contributors may"
        " be used to endorse or promote products derived from this software without specific prior written permission",
    ),
    Template(
        "isc",
        "permission to use copy modify and <<beginOptional>>or<<endOptional>> distribute this software for any purpose with or"
        " without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    Template(
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable"
        " for any damages arising from the use of this software",
    ),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2.0"),
    Template("spdx", "spdx license identifier <<var;name=id;match=.+;min=1;max=4>>"),
)

# ---- markup to regions: ("word", w), ("optional", regions), ("var", expression, least, most)

_MARK = re.compile(r"<<(.*?)>>", re.DOTALL)
#: Words a replaceable region takes where its markup says nothing else.
DEFAULT_WORDS = (1, 32)


def parse(markup: str) -> list[tuple]:
    """The regions of a template's markup.  ValueError on markup that is not closed or known."""
    stack: list[list[tuple]] = [[]]
    for k, part in enumerate(_MARK.split(markup)):
        if k % 2 == 0:
            stack[-1] += [("word", w) for w in normalize(part).split()]
        elif part == "beginOptional":
            stack.append([])
        elif part == "endOptional" and len(stack) > 1:
            inner = stack.pop()
            stack[-1].append(("optional", inner))
        elif part.startswith("var;"):
            told = dict(p.split("=", 1) for p in part.split(";")[1:])
            least, most = int(told.get("min", DEFAULT_WORDS[0])), int(told.get("max", DEFAULT_WORDS[1]))
            if not 0 <= least <= most or not most:
                raise ValueError(f"a region of {least} to {most} words: {part!r}")
            stack[-1].append(("var", told.get("match", ".+"), least, most))
        else:
            raise ValueError(f"unexpected <<{part}>>")
    if len(stack) > 1:
        raise ValueError("an optional region is not closed")
    return stack[0]


def _most_words(regions: list[tuple]) -> int:
    return sum(1 if r[0] == "word" else r[3] if r[0] == "var" else _most_words(r[1]) for r in regions)


def _longest_run(regions: list[tuple]) -> tuple[list[bytes], int]:
    """The longest run of mandatory words, and how many words may precede it at most."""
    best, best_before, run, before = [], 0, [], 0
    for region in [*regions, ("optional", [])]:
        if region[0] == "word":
            run.append(region[1])
            continue
        if len(run) > len(best):
            best, best_before = run, before
        before += len(run) + _most_words([region])
        run = []
    return best, best_before


class Automaton:
    """A template's regions as a deterministic automaton over words, made as it is used."""

    def __init__(self, template: Template):
        regions = parse(template.markup)
        run, self.before = _longest_run(regions)
        if not run:
            raise ValueError(f"template {template.label!r} has no mandatory word")
        self.run = b" " + b" ".join(run) + b" "
        self.most = _most_words(regions)
        self._words: list[dict[bytes, int]] = []  # per state of the non-deterministic automaton
        self._any: list[list[tuple[int, int]]] = []  # (expression, next)
        self._skip: list[list[int]] = []
        self._expressions: list[re.Pattern] = []
        first = self._state()
        self._last = self._build(regions, first)
        self._literals = {w for words in self._words for w in words}
        self._sets: dict[frozenset[int], int] = {}
        self._members: list[frozenset[int]] = []
        self._next: list[dict] = []
        self.accepts: list[bool] = []
        self.dead = self._number(frozenset())
        self.start = self._number(self._closed([first]))

    def _state(self) -> int:
        self._words.append({})
        self._any.append([])
        self._skip.append([])
        return len(self._words) - 1

    def _build(self, regions: list[tuple], at: int) -> int:
        for region in regions:
            if region[0] == "word":
                to = self._state()
                self._words[at][region[1]] = to
            elif region[0] == "optional":
                inner = self._state()
                self._skip[at].append(inner)
                end, to = self._build(region[1], inner), self._state()
                self._skip[at].append(to)
                self._skip[end].append(to)
            else:
                _, expression, least, most = region
                self._expressions.append(re.compile(expression.encode()))
                to = self._state()
                for k in range(most):
                    if k >= least:
                        self._skip[at].append(to)
                    after = self._state()
                    self._any[at].append((len(self._expressions) - 1, after))
                    at = after
                self._skip[at].append(to)
            at = to
        return at

    def _closed(self, states: Iterable[int]) -> frozenset[int]:
        seen, todo = set(), list(states)
        while todo:
            s = todo.pop()
            if s not in seen:
                seen.add(s)
                todo += self._skip[s]
        return frozenset(seen)

    def _number(self, states: frozenset[int]) -> int:
        if states not in self._sets:
            self._sets[states] = len(self._members)
            self._members.append(states)
            self._next.append({})
            self.accepts.append(self._last in states)
        return self._sets[states]

    def step(self, state: int, word: bytes) -> int:
        answers = tuple(e.fullmatch(word) is not None for e in self._expressions)
        key = (word if word in self._literals else None, answers)
        to = self._next[state].get(key)
        if to is None:
            reached = []
            for s in self._members[state]:
                if word in self._words[s]:
                    reached.append(self._words[s][word])
                reached += [n for e, n in self._any[s] if answers[e]]
            to = self._next[state][key] = self._number(self._closed(reached))
        return to

    def longest(self, data: bytes, at: int) -> int:
        """Where the longest match that begins at the space ``at`` ends (at a space); -1 if there is none."""
        state, end = self.start, -1
        while state != self.dead:
            if self.accepts[state]:
                end = at
            after = data.find(b" ", at + 1)
            if after < 0:
                break
            state, at = self.step(state, data[at + 1 : after]), after
        return end

    def places(self, data: bytes) -> Iterator[tuple[int, int]]:
        """Leftmost longest matches in normalized words that do not overlap, as
        places of the spaces around them."""
        free, run = 0, data.find(self.run)
        while run >= 0:
            starts = [run]
            while len(starts) <= self.before and starts[-1] > free:
                starts.append(data.rfind(b" ", free, starts[-1]))
            end = -1
            for start in reversed(starts):
                end = self.longest(data, start)
                if end > run:
                    yield start, end
                    free = end
                    break
            run = data.find(self.run, max(run + 1, free))


@lru_cache(maxsize=8)
def _compiled(phrases: tuple[Phrase, ...], templates: tuple[Template, ...]) -> tuple[list[bytes], list[Automaton]]:
    return [normalize(p.words) for p in phrases], [Automaton(t) for t in templates]


def _phrase_places(data: bytes, phrase: bytes) -> Iterator[tuple[int, int]]:
    at = data.find(phrase)
    while at >= 0:
        yield at, at + len(phrase) - 1
        at = data.find(phrase, at + 1)


def scan(text: str, phrases: tuple[Phrase, ...], templates: tuple[Template, ...]) -> tuple[int, list[tuple[int, int, int]]]:
    """Number of words, and (start, end, which) of every place, in words, end
    exclusive; ``which`` counts the phrases and then the templates."""
    data = normalize(text)
    wordings, automata = _compiled(phrases, templates)
    found = [(s, e, k) for k, p in enumerate(wordings) for s, e in _phrase_places(data, p)]
    for k, automaton in enumerate(automata, len(phrases)):
        found += [(s, e, k) for s, e in automaton.places(data)]
    # places of spaces to numbers of words, in one walk
    number, words, at = {}, 0, 0
    for place in sorted({p for s, e, _ in found for p in (s, e)}):
        words += data.count(b" ", at, place)
        number[place], at = words, place
    return data.count(b" ") - 1, sorted((number[s], number[e], k) for s, e, k in found)


PLACES = T.ArrayType(
    T.StructType(
        [
            T.StructField("label", T.StringType()),
            T.StructField("base", T.BooleanType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
        ]
    )
)
_ARROW = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("end", pa.int64())]))


def find_licenses(
    docs: DataFrame,
    text_col: str = "text",
    templates: tuple[Template, ...] = TEMPLATES,
    phrases: tuple[Phrase, ...] = BASE_PHRASES,
    words_col: str = "n_words",
    out_col: str = "license_places",
) -> DataFrame:
    """All rows and columns of ``docs`` with the number of words of each whole
    text and ``out_col``: the places of phrases (``base``) and templates as
    (label, base, start, end), in words, by start, end and order of the lists.

    Places of a phrase may overlap; those of a template are leftmost, longest
    and apart.  Null and empty texts have no words and no places.  Existing
    columns of the two names are replaced; repeated rows are searched each."""
    docs, phrases, templates = docs.drop(words_col, out_col), tuple(phrases), tuple(templates)
    ship(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, T.StructField(words_col, T.LongType()), T.StructField(out_col, PLACES)])
    column, labels = docs.columns.index(text_col), [t.label for t in (*phrases, *templates)]

    def run(batches):
        for batch in in_slices(batches):
            found = [scan(t or "", phrases, templates) for t in batch.column(column).to_pylist()]
            places = [
                [{"label": labels[k], "base": k < len(phrases), "start": s, "end": e} for s, e, k in f] for _, f in found
            ]
            columns = [*batch.columns, pa.array([n for n, _ in found], pa.int64()), pa.array(places, type=_ARROW)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema)


def covered_share(places: Column, n_words: Column) -> Column:
    """The share of a text's words that lie in a place; 0 without words.
    ``places`` are in order of their starts."""
    zero = F.lit(0).cast("long")

    def take(so_far, place):
        start = F.greatest(so_far["reach"], place["start"])
        return F.struct(
            (so_far["covered"] + F.greatest(place["end"] - start, zero)).alias("covered"),
            F.greatest(so_far["reach"], place["end"]).alias("reach"),
        )

    covered = F.aggregate(places, F.struct(zero.alias("covered"), zero.alias("reach")), take)["covered"]
    return F.when(n_words > 0, covered / n_words).otherwise(F.lit(0.0))
