"""Secret scan with a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived:
what text must hold for the rule to match at all.  Documents are indexed in
segments (512 at a time): a posting list per trigram that some rule asks
for, built in one pass over the segment's bytes.  The lists are intersected and
united as the queries say, and only the documents that remain are searched with
the expression itself.  A rule without a mandatory trigram scans its segment fully.

Segments have the same size whatever the input, and a task keeps one at a time;
nothing is shuffled and a lost task is simply run again.
"""

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..plans import ship
from .common import in_slices

try:  # the parser of regular expressions has moved between versions of Python
    from re import _constants as sre
    from re import _parser as parser
except ImportError:
    import sre_constants as sre
    import sre_parse as parser

MAX_SET = 64  # strings a node may stand for before only their trigrams are kept
MAX_CLASS = 6  # members a character class may have to be spelled out


@dataclass(frozen=True)
class Rule:
    """``least`` characters (code points) in ``group``, else the match is dropped
    after it was made: matches never overlap, dropped ones included."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    ignore_case: bool = False

    @property
    def regex(self) -> re.Pattern:
        # with ASCII no letter outside A-Z equals one within it in another case
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))


BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)
#: Public formats of further credentials.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    # up to the END line, if no prose is between; else the headers and lines of base64 that follow;
    # nothing is gone back over, and no scan passes the next header, so time grows with the text
    Rule(
        "pem",
        r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"
        r"(?:(?:[A-Za-z0-9+/=\s\\:,\"'<>|#*&;_]++|-(?!----(?:BEGIN |END (?:[A-Z]+ )*PRIVATE KEY-----)))*+"
        r"-----END (?:[A-Z]+ )*PRIVATE KEY-----"
        r"|(?:(?:[\s>|#*\"',]|\\[nr])++(?:[A-Za-z-]++: [^\r\n]*+|[A-Za-z0-9+/=]{16,}+|[A-Za-z0-9+/]{2,}+={1,2}))*+)",
    ),
)
RULES = BASE_RULES + MORE_RULES

# ---- Boolean trigram queries: True, ("and", ...), ("or", ...) or a trigram

ANY = True


def _both(parts: Iterable):
    parts = [p for p in dict.fromkeys(parts) if p is not ANY]
    return ANY if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _either(parts: Iterable):
    parts = list(dict.fromkeys(parts))
    return ANY if ANY in parts else parts[0] if len(parts) == 1 else ("or", *parts)


def _of_strings(strings: frozenset[str]):
    """What holds if one of the strings is there."""
    return _either(_both(s[i : i + 3] for i in range(len(s) - 2)) for s in sorted(strings))


def _sequence(nodes):
    """(strings, query): the strings the nodes can stand for, or None if they
    are not a small set, and a query that holds whenever the nodes match."""
    run, queries, exact = frozenset([""]), [], True
    for op, arg in nodes:
        strings, query = _node(op, arg)
        if strings is not None and len(run) * len(strings) <= MAX_SET:
            run = frozenset(a + b for a in run for b in strings)
            continue
        exact = False  # the run of literals ends here; the next begins
        queries += [_of_strings(run), query]
        run = frozenset([""]) if strings is None else strings
    return (run if exact else None), _both([*queries, _of_strings(run)])


def _node(op, arg):
    if op is sre.LITERAL:
        return (frozenset([chr(arg).lower()]) if arg < 128 else None), ANY
    if op is sre.IN and arg[0][0] is not sre.NEGATE:
        members = set()
        for kind, value in arg:
            if kind is sre.LITERAL and value < 128:
                members.add(chr(value).lower())
            elif kind is sre.RANGE and value[1] < 128 and value[1] - value[0] < 2 * MAX_CLASS:
                members.update(chr(c).lower() for c in range(value[0], value[1] + 1))
            else:
                return None, ANY
        return (frozenset(members), ANY) if len(members) <= MAX_CLASS else (None, ANY)
    if op is sre.SUBPATTERN:
        return _sequence(arg[-1])
    if op is sre.BRANCH:
        parts = [_sequence(b) for b in arg[1]]
        strings = None
        if all(s is not None for s, _ in parts) and sum(len(s) for s, _ in parts) <= MAX_SET:
            strings = frozenset().union(*(s for s, _ in parts))
        return strings, _either(q for _, q in parts)
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        least, most, body = arg
        strings, query = _sequence(body)
        if least == 0:
            return (strings | {""} if strings is not None and most == 1 else None), ANY
        return (strings if least == most == 1 else None), query
    if op is sre.AT:
        return frozenset([""]), ANY
    return None, ANY


def trigram_query(rule: Rule):
    """The rule's query over lower-case trigrams; True if it has none."""
    return _sequence(parser.parse(rule.pattern))[1]


def trigrams_of(query) -> set[str]:
    return set() if query is ANY else {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1:]))


# ---- segments


def _code(trigram: str) -> int:
    a, b, c = trigram.encode("ascii")
    return a | b << 8 | c << 16


@lru_cache(maxsize=8)
def _prepared(rules: tuple[Rule, ...]):
    queries = [trigram_query(r) for r in rules]
    asked = sorted(set().union(*map(trigrams_of, queries)))
    wanted = np.zeros(1 << 24, dtype=bool)
    wanted[[_code(t) for t in asked]] = True
    return queries, {t: _code(t) for t in asked}, wanted, [r.regex for r in rules]


def _postings(data: np.ndarray, ends: np.ndarray, codes: dict[str, int], wanted: np.ndarray) -> dict[str, np.ndarray]:
    """The documents (by place in the segment) of each asked trigram.  ``data``:
    all bytes of the segment, ``ends``: where each document ends."""
    lower = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data).astype(np.uint32)
    if len(lower) < 3:
        return {}
    code = lower[:-2] | lower[1:-1] << np.uint32(8) | lower[2:] << np.uint32(16)
    at = np.flatnonzero(wanted[code])
    doc = np.searchsorted(ends, at, side="right")
    inside = at + 3 <= ends[doc]  # not across two documents
    code, doc = code[at[inside]], doc[inside]
    pairs = np.unique(code.astype(np.uint64) << np.uint64(32) | doc.astype(np.uint64))
    code, doc = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return {t: doc[np.searchsorted(code, c) : np.searchsorted(code, c, side="right")] for t, c in codes.items()}


def _candidates(query, postings: dict[str, np.ndarray], n: int) -> np.ndarray:
    if query is ANY:
        return np.arange(n)
    if isinstance(query, str):
        return postings.get(query, np.empty(0, dtype=np.int64))
    lists = [_candidates(q, postings, n) for q in query[1:]]
    if query[0] == "or":
        return np.unique(np.concatenate(lists))
    out = lists[0]
    for other in sorted(lists[1:], key=len):
        out = np.intersect1d(out, other, assume_unique=True)
    return out


def scan_segment(texts: list[str], rules: tuple[Rule, ...]) -> list[list[tuple[int, int, int]]]:
    """(start, place of the rule, end) of every span, by document, in order."""
    queries, codes, wanted, regexes = _prepared(rules)
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(b) for b in raw], dtype=np.int64)
    postings = _postings(np.frombuffer(b"".join(raw), dtype=np.uint8), ends, codes, wanted)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, (rule, query, regex) in enumerate(zip(rules, queries, regexes, strict=True)):
        for i in _candidates(query, postings, len(texts)).tolist():
            for m in regex.finditer(texts[i]):
                start, end = m.span(rule.group)
                if end - start >= rule.least:
                    found[i].append((m.start(), k, m.end()))
    for spans in found:
        spans.sort()
    return found


SPANS = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
)
_SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scan(docs: DataFrame, text_col: str, rules: tuple[Rule, ...], schema: T.StructType, finish) -> DataFrame:
    ship(docs.sparkSession)
    place, names = docs.columns.index(text_col), schema.names

    def run(batches):
        for batch in in_slices(batches):
            texts = [t or "" for t in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays(finish(batch, texts, scan_segment(texts, rules)), names=names)

    return docs.mapInArrow(run, schema)


def find_secrets(
    docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, out_col: str = "secret_spans"
) -> DataFrame:
    """All rows and columns of ``docs`` with ``out_col``: the spans of each
    whole text, an array of (kind, start, end) by start and then by the order of
    the rules; code points, end exclusive.

    Null and empty texts have no spans.  An existing column named ``out_col``
    is replaced.  Rows keep their number: repeated rows are searched each."""
    docs, rules = docs.drop(out_col), tuple(rules)

    def finish(batch, texts, found):
        spans = [[{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in doc] for doc in found]
        return [*batch.columns, pa.array(spans, type=_SPANS_ARROW)]

    return _scan(docs, text_col, rules, T.StructType([*docs.schema.fields, T.StructField(out_col, SPANS)]), finish)


def redact(text: str, spans: list[tuple[int, int, int]], rules: tuple[Rule, ...]) -> str:
    """Each stretch of spans, in order of start, as one ``[kind]`` of its first."""
    out, at, k = [], 0, 0
    while k < len(spans):
        start, rule, end = spans[k]
        k += 1
        while k < len(spans) and spans[k][0] < end:
            end = max(end, spans[k][2])
            k += 1
        out += [text[at:start], f"[{rules[rule].kind}]"]
        at = end
    return "".join([*out, text[at:]])


def redact_secrets(
    docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``docs`` with the same columns and rows, every secret in the text replaced
    by ``[kind]``.  ``chars_col``, where there is one, is the length of the new
    text in rows that changed.  Null texts stay null."""
    rules = tuple(rules)
    text_at = docs.columns.index(text_col)
    chars_at = docs.columns.index(chars_col) if chars_col in docs.columns else None

    def finish(batch, texts, found):
        columns = list(batch.columns)
        if any(found):
            new = [redact(t, f, rules) if f else None for t, f in zip(texts, found, strict=True)]
            old = columns[text_at].to_pylist()
            columns[text_at] = pa.array([o if n is None else n for n, o in zip(new, old, strict=True)], type=columns[text_at].type)
            if chars_at is not None:
                old = columns[chars_at].to_pylist()
                sizes = [o if n is None else len(n) for n, o in zip(new, old, strict=True)]
                columns[chars_at] = pa.array(sizes, type=columns[chars_at].type)
        return columns

    return _scan(docs, text_col, rules, docs.schema, finish)
