"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams.

Features are hashed n-grams of one to three lower-cased characters.  Their
document frequencies are counted over all documents that may be learned from;
the weights are fitted on a bounded sample of them, with follow-the-regularised-
leader updates under L1 and L2 penalties, and a temperature is chosen on the part
of the sample that the fit did not see.  The model has a fixed size, whatever the
input; documents are scored where they are read, in blocks of bounded size.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import cut_lineage, ship
from .common import in_slices

BITS = 16
ORDERS = 3
BLOCK = 1 << 18  # characters that are hashed at a time
UNDETERMINED = "und"
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)
_SALTS = (0x27D4EB2F, 0x165667B1, 0x7FEB352D)


@dataclass(frozen=True)
class Training:
    """``per_language`` bounds (in the mean) the labelled documents of one
    language that are fitted on, a fifth of them for the temperature."""

    per_language: int = 1200
    epochs: int = 3
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.5
    scale: float = 50.0  # of features, which sum to this


def _buckets(text: str):
    """Hashed n-grams of a text, block by block; an n-gram that begins in a
    block is counted with it."""
    data = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    for at in range(0, len(data), BLOCK):
        block = data[at : at + BLOCK + ORDERS - 1]
        own = min(BLOCK, len(data) - at)
        scrambled = block * _MULTIPLIERS[0]
        scrambled ^= scrambled >> np.uint32(15)
        for order in range(1, ORDERS + 1):
            n = min(own, len(block) - order + 1)
            if n <= 0:
                continue
            h = scrambled[:n] ^ np.uint32(_SALTS[order - 1])
            for k in range(1, order):
                h = h * _MULTIPLIERS[k] + scrambled[k : k + n]
            h ^= h >> np.uint32(16)
            yield (h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)


_LEARNED = "kind int, place long, lang string, buckets array<int>, counts array<int>"


def _read_training(docs: DataFrame) -> DataFrame:
    """One pass over (place, lang, text, chosen): per task the document
    frequency of every n-gram (kind 0), and each chosen document's n-gram counts (kind 1)."""

    def rows(items):
        kinds, places, langs, buckets, counts = zip(*items, strict=True)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(kinds, type=pa.int32()),
                pa.array(places, type=pa.int64()),
                pa.array(langs, type=pa.string()),
                pa.array([b.astype(np.int32) for b in buckets], type=pa.list_(pa.int32())),
                pa.array([c.astype(np.int32) for c in counts], type=pa.list_(pa.int32())),
            ],
            names=["kind", "place", "lang", "buckets", "counts"],
        )

    def run(batches):
        frequency = np.zeros(1 << BITS, dtype=np.int64)
        seen = np.zeros(1 << BITS, dtype=bool)
        for batch in in_slices(batches):
            place, lang, text, chosen = (batch.column(i).to_pylist() for i in range(4))
            out = []
            for p, name, t, c in zip(place, lang, text, chosen, strict=True):
                parts = list(_buckets(t))
                seen[:] = False
                for h in parts:
                    seen[h] = True
                frequency += seen
                if c:
                    counts = np.bincount(np.concatenate([*parts, np.empty(0, dtype=np.uint32)]).astype(np.int64), minlength=1 << BITS)
                    at = np.flatnonzero(counts)
                    out.append((1, p, name, at, counts[at]))
            if out:
                yield rows(out)
        at = np.flatnonzero(frequency)
        yield rows([(0, 0, None, at, frequency[at])])

    ship(docs.sparkSession)
    return docs.mapInArrow(run, _LEARNED)


class Ftrl:
    """Multinomial logistic regression, one coordinate-wise learning rate each."""

    def __init__(self, classes: int, t: Training):
        self.t = t
        self.z = np.zeros((1 << BITS, classes))
        self.n = np.zeros((1 << BITS, classes))
        self.bias = np.zeros(classes)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, t = self.z[at], self.t
        w = -(z - np.sign(z) * t.l1) / ((t.beta + np.sqrt(self.n[at])) / t.alpha + t.l2)
        return np.where(np.abs(z) <= t.l1, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int, weight: float) -> None:
        w = self.weights(at)
        p = softmax((x @ w + self.bias)[None])[0]
        p[label] -= 1
        p *= weight
        g = x[:, None] * p
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.t.alpha * w
        self.n[at] = n + g * g
        self.bias -= 0.01 * p


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """Of a grid, the one with the least log loss against labels of which one
    more than seen may be wrong, so that a faultless part makes no certainty."""
    n, classes = logits.shape
    if not n:
        return 1.0
    doubt = 1 / (n + 2)
    target = np.full((n, classes), doubt / classes)
    target[np.arange(n), labels] += 1 - doubt
    loss = {t: -(target * np.log(np.maximum(softmax(logits / t), 1e-12))).sum() for t in np.geomspace(0.1, 10, 81)}
    return float(min(loss, key=loss.get))


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    table: np.ndarray  # a row per n-gram: idf times each weight, then idf
    bias: np.ndarray
    scale: float
    temperature: float

    def logits(self, text: str) -> np.ndarray:
        total = np.zeros(self.table.shape[1])
        for h in _buckets(text):
            total += self.table[h].sum(axis=0, dtype=np.float64)
        return self.scale * total[:-1] / max(total[-1], 1e-12) + self.bias

    def predict(self, text: str) -> tuple[str, float]:
        p = softmax(self.logits(text)[None] / self.temperature)[0]
        k = int(np.argmax(p))
        return self.languages[k], float(p[k])


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", training: Training = Training()
) -> LanguageModel | None:
    """Fit on the rows with text and language; None where there is none.
    Document frequencies come from all of them, weights from a sample by hash of the id."""
    rows = docs.select(
        F.xxhash64(F.lit("sample"), docs[id_col].cast("string")).alias("place"),
        docs[lang_col].cast("string").alias("lang"),
        docs[text_col].cast("string").alias("text"),
    ).where("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    span = 1 << 20
    rate = F.lit(0)
    for lang, n in sizes.items():
        rate = F.when(F.col("lang") == lang, int(span * min(1.0, training.per_language / n))).otherwise(rate)
    read = cut_lineage(_read_training(rows.select("place", "lang", "text", (F.pmod("place", F.lit(span)) < rate).alias("chosen"))))
    counted = (
        read.where("kind = 0")
        .select(F.explode(F.arrays_zip("buckets", "counts")).alias("x"))
        .groupBy("x.buckets")
        .agg(F.sum("x.counts").alias("n"))
        .toArrow()
    )
    frequency = np.zeros(1 << BITS)
    frequency[counted["buckets"].to_numpy()] = counted["n"].to_numpy()
    idf = np.log((1 + sum(sizes.values())) / (1 + frequency)) + 1
    sample = read.where("kind = 1").select("place", "lang", "buckets", "counts").toArrow().combine_chunks()
    model = fit(sample, idf, tuple(sorted(sizes)), training)
    del sample, counted
    pa.default_memory_pool().release_unused()  # the driver goes on with other work
    return model


def _items(sample: pa.Table, idf: np.ndarray, languages: tuple[str, ...], scale: float) -> list[tuple]:
    """(n-grams, features, place of the language) of every row that has n-grams,
    in the order of place and language.  All are parts of a few large arrays,
    whose memory goes back when the fit is done."""
    if not sample.num_rows:
        return []
    index = {lang: k for k, lang in enumerate(languages)}
    place, lang = sample["place"].to_pylist(), sample["lang"].to_pylist()
    buckets, counts = (sample[c].combine_chunks() for c in ("buckets", "counts"))
    buckets, counts = (c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in (buckets, counts))
    at = buckets.flatten().to_numpy()
    x = idf[at]
    x *= counts.flatten().to_numpy()
    ends = np.cumsum(buckets.value_lengths().to_numpy())
    items = []
    for k in sorted(range(len(place)), key=lambda k: (place[k], lang[k])):
        part = slice(ends[k - 1] if k else 0, ends[k])
        if part.stop > part.start:
            x[part] *= scale / x[part].sum()
            items.append((at[part], x[part], index[lang[k]]))
    return items


def fit(sample: pa.Table, idf: np.ndarray, languages: tuple[str, ...], training: Training) -> LanguageModel:
    """``sample``: rows of (place, lang, buckets, counts)."""
    items = _items(sample, idf, languages, training.scale)
    held = [i for k, i in enumerate(items) if k % 5 == 4]
    used = [i for k, i in enumerate(items) if k % 5 != 4]
    model = Ftrl(len(languages), training)
    share = np.bincount([i[2] for i in used], minlength=len(languages)) / max(1, len(used))
    weights = 1 / np.maximum(share * len(languages), 0.05)
    order = np.random.default_rng(7)
    for _ in range(training.epochs):
        for k in order.permutation(len(used)):
            at, x, label = used[k]
            model.learn(at, x, label, min(10.0, weights[label]))
    w = model.weights()
    logits = np.array([x @ w[at] + model.bias for at, x, _ in held]).reshape(-1, len(languages))
    temperature = _temperature(logits, np.array([i[2] for i in held], dtype=np.int64))
    table = np.column_stack([w * idf[:, None], idf]).astype(np.float32)
    return LanguageModel(languages, table, model.bias, training.scale, temperature)


def predict(
    docs: DataFrame,
    model: LanguageModel | None,
    text_col: str = "text",
    lang_out: str = "lang_pred",
    score_out: str = "lang_score",
) -> DataFrame:
    """All rows and columns of ``docs`` with the language of the whole text and
    the calibrated probability of it.  Columns of these names are replaced.

    Null texts, texts without a letter, and all texts where there is no model,
    are undetermined (``und``) with a score of 0."""
    docs = docs.drop(lang_out, score_out)
    letter = "__has_letter"
    rows = docs.withColumn(letter, F.coalesce(docs[text_col].rlike(r"\p{L}"), F.lit(False)))
    if model is None:
        return docs.withColumn(lang_out, F.lit(UNDETERMINED)).withColumn(score_out, F.lit(0.0))
    place, names = docs.columns.index(text_col), [*docs.columns, lang_out, score_out]

    def run(batches):
        for batch in in_slices(batches):
            texts, letters = batch.column(place).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            found = [model.predict(t) if y else (UNDETERMINED, 0.0) for t, y in zip(texts, letters, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array([f[0] for f in found], type=pa.string()),
                    pa.array([f[1] for f in found], type=pa.float64()),
                ],
                names=names,
            )

    ship(docs.sparkSession)
    added = [T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())]
    return rows.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))
