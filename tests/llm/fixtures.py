"""Awkward rows that every operator must take, and brute-force twins."""

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import Row

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_az(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def awkward(spark, **columns):
    """Documents with null id, null, empty, blank, very short, very long and
    repeated texts, and further columns whose names operators might use."""
    long = prose(1, 30_000, 9_000)
    texts = [None, "", " \t\n", "a", "Word", prose(2, 60), prose(2, 60), long, "!!! 123 ...", "é ü ñ 漢字", prose(3, 7)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, prose(4, 40)), (5, prose(2, 60)), (None, None)]
    extra = "n long, h long, words string, score double, cid long, gid long, component string, seg string, lang_pred string"
    names = {c.split()[0] for c in extra.split(", ")}
    schema = f"doc_id long, text string, lang string, source string, n_chars int, {extra}"
    data = [(i, t, None if k % 4 == 0 else "en", None, None, *([None] * len(names))) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, schema)


def nothing(spark, schema):
    return spark.createDataFrame([], schema)


DOCS = "doc_id long, text string, lang string, source string, n_chars int"


def shingles(text, words):
    w = WORD.findall(lower_az(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + words]) for k in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)])


def linked(rows, words, percent):
    """doc_id -> (set size, least id reachable)."""
    sets = {i: shingles(t, words) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for i, s in sets.items():
        for j, k in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


__all__ = ["Row"]
