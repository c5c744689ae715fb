"""Toxicity scores from a bidirectional gated recurrent network in numpy.

A word's input is an embedding of the word and the mean embedding of its
character n-grams, both hashed.  Two gated recurrent units read a window of words
forwards and backwards, attention pools their states, and a logistic unit scores
the window.  A text's score is the greatest of all its overlapping windows,
calibrated on labelled texts that the fit did not see.

The network is fitted on a bounded, documented number of labelled texts.  It
learns from texts, not windows: each step takes the window of a text that scores
highest.  Texts are scored where they are read; nothing is shuffled.
"""

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import ship
from .common import in_slices

ROWS = 1 << 15  # of either embedding
WORD = re.compile(r"\w{1,24}")
CACHED_WORDS = 150_000
BATCH = 1024  # windows that are scored at a time


@dataclass(frozen=True)
class Training:
    """``per_label`` bounds (in the mean) the texts of either label that are
    used, a quarter of them for calibration."""

    per_label: int = 1500
    epochs: int = 8
    batch: int = 32
    rate: float = 0.02
    size: int = 8  # of either embedding
    hidden: int = 12  # of either direction
    attention: int = 8
    window: int = 64
    stride: int = 48
    seed: int = 11


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def window_starts(n: int, window: int, stride: int) -> list[int]:
    """Starts of overlapping windows that cover ``n`` words; the last one ends with the text."""
    return [0] if n <= window else [*range(0, n - window, stride), n - window]


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def hashed(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embedding row of each word, those of its n-grams (3 to 5 characters, the
    ends of the word marked), and where each word's n-grams begin."""
    marked = "".join(f"<{w}>" for w in words)
    codes = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    length = np.array([len(w) + 2 for w in words], dtype=np.int64)
    start = np.cumsum(length) - length
    owner = np.repeat(np.arange(len(words)), length)
    left = (start + length)[owner] - np.arange(len(codes))  # characters to the word's end
    rolling, grams, owners = np.zeros(len(codes), dtype=np.uint64), [], []
    for k in range(5):
        n = len(codes) - k
        rolling = _scramble(rolling[:n] * np.uint64(0x9E3779B97F4A7C15) + codes[k:] + np.uint64(1))
        if k >= 2:
            at = np.flatnonzero(left[:n] > k)
            grams.append(rolling[at] & np.uint64(ROWS - 1))
            owners.append(owner[at])
    order = np.argsort(np.concatenate(owners), kind="stable")
    gram, own = np.concatenate(grams)[order].astype(np.int64), np.concatenate(owners)[order]
    total = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(_scramble(codes * np.uint64(0x9E3779B97F4A7C15) + (np.arange(len(codes)) - start[owner]).astype(np.uint64)), out=total[1:])
    word = _scramble(total[start + length] - total[start]) & np.uint64(ROWS - 1)
    return word.astype(np.int64), gram, np.searchsorted(own, np.arange(len(words)))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Weights by name in ``w``; windows are (time, window) arrays of rows of a
    table of word inputs, -1 for no word."""

    def __init__(self, t: Training):
        rng, d, h = np.random.default_rng(t.seed), 2 * t.size, t.hidden
        scale = lambda *s: (rng.standard_normal(s) / np.sqrt(s[-2] if len(s) > 1 else s[0])).astype(np.float32)
        self.t = t
        self.w = {
            "word": 0.1 * scale(ROWS, t.size) * np.float32(np.sqrt(ROWS / t.size)),
            "gram": 0.1 * scale(ROWS, t.size) * np.float32(np.sqrt(ROWS / t.size)),
            "input": scale(2, d, 3 * h),
            "bias": np.zeros((2, 3 * h), dtype=np.float32),
            "gates": scale(2, h, 2 * h),
            "state": scale(2, h, h),
            "attend": scale(2 * h, t.attention),
            "attend_bias": np.zeros(t.attention, dtype=np.float32),
            "focus": scale(t.attention),
            "out": scale(2 * h),
            "out_bias": np.zeros(1, dtype=np.float32),
        }

    def inputs(self, words: list[str]):
        """The input vector of each word, and what it was made from."""
        word, gram, begin = hashed(words)
        count = np.diff(np.append(begin, len(gram)))[:, None].astype(np.float32)
        chars = np.add.reduceat(self.w["gram"][gram], begin, axis=0) / count
        return np.concatenate([self.w["word"][word], chars], axis=1), (word, gram, count)

    def projected(self, x: np.ndarray) -> np.ndarray:
        """(2, rows + 1, 3 h): inputs of the gates, by direction; the last row is for no word."""
        p = np.einsum("nd,kdg->kng", x, self.w["input"], optimize=True) + self.w["bias"][:, None]
        return np.concatenate([p, np.zeros((2, 1, p.shape[2]), dtype=p.dtype)], axis=1)

    def forward(self, p: np.ndarray, rows: np.ndarray, keep: bool = False):
        """The logit of each window; with ``keep``, also what ``backward`` needs."""
        w, h = self.w, self.t.hidden
        steps, n = rows.shape
        there = rows >= 0
        whole = there.all()
        state = np.zeros((2, n, h), dtype=np.float32)
        states = np.empty((steps, n, 2 * h), dtype=np.float32)
        kept = []
        for s in range(steps):
            at = (s, steps - 1 - s)
            x = np.stack([p[0][rows[at[0]]], p[1][rows[at[1]]]])
            zr = _sigmoid(x[..., : 2 * h] + state @ w["gates"])
            z, r = zr[..., :h], zr[..., h:]
            c = np.tanh(x[..., 2 * h :] + (r * state) @ w["state"])
            new = state + z * (c - state)
            if not whole:
                mask = np.stack([there[at[0]], there[at[1]]])[..., None]
                new = np.where(mask, new, state)
            if keep:
                kept.append((state, z, r, c))
            state = new
            states[at[0], :, :h], states[at[1], :, h:] = state[0], state[1]
        a = np.tanh(states @ w["attend"] + w["attend_bias"])
        e = np.where(there, a @ w["focus"], -1e9)
        e = np.exp(e - e.max(axis=0))
        share = e / e.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", share, states, optimize=True)
        logit = pooled @ w["out"] + w["out_bias"][0]
        return (logit, (rows, there, kept, states, a, share, pooled)) if keep else logit

    def backward(self, p_shape, cache, d_logit: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the sum of ``d_logit`` times the logits; ``projected`` for its input."""
        rows, there, kept, states, a, share, pooled = cache
        w, h, steps = self.w, self.t.hidden, len(rows)
        g = {"out": pooled.T @ d_logit, "out_bias": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * w["out"]
        d_states = share[..., None] * d_pooled
        d_share = np.einsum("tnh,nh->tn", states, d_pooled, optimize=True)
        d_e = share * (d_share - (share * d_share).sum(axis=0))
        g["focus"] = np.einsum("tna,tn->a", a, d_e, optimize=True)
        d_a = d_e[..., None] * w["focus"] * (1 - a * a)
        g["attend"] = np.einsum("tnh,tna->ha", states, d_a, optimize=True)
        g["attend_bias"] = d_a.sum(axis=(0, 1))
        d_states = d_states + d_a @ w["attend"].T
        g |= {k: np.zeros_like(w[k]) for k in ("gates", "state")}
        g["projected"] = np.zeros(p_shape, dtype=np.float32)
        carried = np.zeros((2, rows.shape[1], h), dtype=np.float32)
        for s in range(steps - 1, -1, -1):
            at = (s, steps - 1 - s)
            state, z, r, c = kept[s]
            d = carried + np.stack([d_states[at[0], :, :h], d_states[at[1], :, h:]])
            mask = np.stack([there[at[0]], there[at[1]]])[..., None]
            live = np.where(mask, d, 0)
            d_c = live * z * (1 - c * c)
            d_rs = d_c @ w["state"].transpose(0, 2, 1)
            g["state"] += (r * state).transpose(0, 2, 1) @ d_c
            d_z = live * (c - state) * z * (1 - z)
            d_r = d_rs * state * r * (1 - r)
            d_zr = np.concatenate([d_z, d_r], axis=2)
            g["gates"] += state.transpose(0, 2, 1) @ d_zr
            carried = np.where(mask, live * (1 - z) + d_rs * r + d_zr @ w["gates"].transpose(0, 2, 1), d)
            d_x = np.concatenate([d_zr, d_c], axis=2)
            np.add.at(g["projected"][0], rows[at[0]], d_x[0])
            np.add.at(g["projected"][1], rows[at[1]], d_x[1])
        return g

    def input_gradients(self, x, made, d_projected) -> dict[str, np.ndarray]:
        word, gram, count = made
        d = d_projected[:, :-1]
        d_x = np.einsum("kng,kdg->nd", d, self.w["input"], optimize=True)
        size = self.t.size
        g = {
            "input": np.einsum("nd,kng->kdg", x, d, optimize=True),
            "bias": d.sum(axis=1),
            "word": np.zeros_like(self.w["word"]),
            "gram": np.zeros_like(self.w["gram"]),
        }
        np.add.at(g["word"], word, d_x[:, :size])
        np.add.at(g["gram"], gram, np.repeat(d_x[:, size:] / count, count[:, 0].astype(np.int64), axis=0))
        return g


def stacked(windows: list[np.ndarray]) -> np.ndarray:
    """(time, window) of windows of any lengths; -1 after a window's end."""
    out = np.full((max(map(len, windows)), len(windows)), -1, dtype=np.int64)
    for k, x in enumerate(windows):
        out[: len(x), k] = x
    return out


def cut_windows(rows: np.ndarray, t: Training) -> list[np.ndarray]:
    return [rows[s : s + t.window] for s in window_starts(len(rows), t.window, t.stride)]


def _log_odds(rows: list[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    """How much likelier each row is in toxic texts, shrunk; a start for the embeddings."""
    seen = np.full((2, size), 1.0)
    for r, y in zip(rows, labels, strict=True):
        seen[int(y), np.unique(r)] += 1
    share = seen / (np.bincount(labels.astype(int), minlength=2)[:, None] + 2)
    evidence = (seen.sum(axis=0) - 2) / (seen.sum(axis=0) + 2)
    return (np.log(share[1] / share[0]) * evidence).astype(np.float32)


@dataclass
class ToxicityModel:
    network: Network
    slope: float
    offset: float
    _rows: dict = field(default_factory=dict, repr=False)
    _table: list = field(default_factory=list, repr=False)

    def _look_up(self, texts: list[list[str]]) -> tuple[list[np.ndarray], np.ndarray]:
        """Rows of the words in a table of gate inputs, which keeps words for the next call."""
        if len(self._rows) > CACHED_WORDS:
            self._rows.clear()
            self._table.clear()
        known = self._rows
        new = list(dict.fromkeys(w for t in texts for w in t if w not in known))
        if new:
            known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
            fresh = np.concatenate(
                [self.network.projected(self.network.inputs(new[k : k + 20_000])[0])[:, :-1] for k in range(0, len(new), 20_000)], axis=1
            )
            self._table[:] = [np.concatenate([*self._table, fresh], axis=1) if self._table else fresh]
        return [np.fromiter(map(known.__getitem__, t), dtype=np.int64, count=len(t)) for t in texts], self._table[0] if self._table else None

    def logits(self, texts: list[str]) -> np.ndarray:
        """The greatest logit of each text's windows; -inf where there is no word."""
        words = [words_of(t) for t in texts]
        out = np.full(len(texts), -np.inf)
        rows, table = self._look_up(words)
        t = self.network.t
        whole, short = [], []  # windows of full length are scored together
        for k, r in enumerate(rows):
            for x in cut_windows(r, t) if len(r) else []:
                (whole if len(x) == t.window else short).append((k, x))
        short.sort(key=lambda kx: len(kx[1]))
        for some in (whole, short):
            for at in range(0, len(some), BATCH):
                part = some[at : at + BATCH]
                np.maximum.at(out, [k for k, _ in part], self.network.forward(table, stacked([x for _, x in part])))
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        x = self.logits(texts)
        return np.where(np.isfinite(x), _sigmoid(self.slope * np.where(np.isfinite(x), x, 0) + self.offset), 0.0)


def fit(texts: list[str], labels: np.ndarray, share: float, t: Training = Training()) -> ToxicityModel | None:
    """``share``: how often a text is toxic where the model will be used.  None
    unless both labels occur among texts with words."""
    kept = [(w, y) for w, y in ((words_of(x), y) for x, y in zip(texts, labels, strict=True)) if w]
    if len({y for _, y in kept}) < 2:
        return None
    words, labels = [w for w, _ in kept], np.array([y for _, y in kept], dtype=np.float32)
    held = np.arange(len(words)) % 4 == 3
    if len(set(labels[~held])) < 2 or len(set(labels[held])) < 2:
        held[:] = False
    vocabulary = {w: k for k, w in enumerate(dict.fromkeys(w for x in words for w in x))}
    names = list(vocabulary)
    rows = [np.array([vocabulary[w] for w in x], dtype=np.int64) for x in words]
    net = Network(t)
    word, gram, begin = hashed(names)
    ends = np.append(begin[1:], len(gram))
    used = np.flatnonzero(~held)
    odds = _log_odds([word[rows[k]] for k in used], labels[used], ROWS)
    net.w["word"][:, 0] = 0.5 * odds
    by_word = [gram[a:b] for a, b in zip(begin, ends, strict=True)]
    odds = _log_odds([np.concatenate([by_word[r] for r in np.unique(rows[k])]) for k in used], labels[used], ROWS)
    net.w["gram"][:, 0] = 0.5 * odds
    windows = [cut_windows(r, t) for r in rows]
    rng = np.random.default_rng(t.seed)
    # Adam for the small weights, one rate per row's history for the embeddings
    first, second, step = {}, {}, 0
    weight = {y: 0.5 / max(1e-9, (labels[used] == y).mean()) for y in (0.0, 1.0)}
    for epoch in range(t.epochs):
        rate = t.rate * (1 - epoch / t.epochs)
        for part in np.array_split(rng.permutation(used), max(1, len(used) // t.batch)):
            cut = [x for k in part for x in windows[k]]
            owner = np.repeat(np.arange(len(part)), [len(windows[k]) for k in part])
            present = np.unique(np.concatenate(cut))
            x, made = net.inputs([names[k] for k in present])
            p = net.projected(x)
            local = [np.searchsorted(present, c) for c in cut]
            logit = net.forward(p, stacked(local))
            best = np.full(len(part), -1)
            for k in np.argsort(logit, kind="stable"):
                best[owner[k]] = k
            logit, cache = net.forward(p, stacked([local[k] for k in best]), keep=True)
            y = labels[part]
            d = ((_sigmoid(logit) - y) * np.where(y == 1, weight[1.0], weight[0.0]) / len(part)).astype(np.float32)
            g = net.backward(p.shape, cache, d)
            g |= net.input_gradients(x, made, g.pop("projected"))
            step += 1
            for name, grad in g.items():
                m, v = first.get(name, 0.0), second.get(name, 0.0)
                if name in ("word", "gram"):
                    at = np.flatnonzero(np.abs(grad).sum(axis=1))
                    if name not in second:
                        second[name] = np.full(ROWS, 1e-6, dtype=np.float32)
                    second[name][at] += (grad[at] ** 2).mean(axis=1)
                    net.w[name][at] -= rate * grad[at] / np.sqrt(second[name][at])[:, None]
                    continue
                first[name], second[name] = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
                net.w[name] = (
                    net.w[name]
                    - rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                ).astype(np.float32)
    model = ToxicityModel(net, 1.0, 0.0)
    check = np.flatnonzero(held) if held.any() else used
    logit = model.logits([" ".join(words[k]) for k in check])
    model.slope, model.offset = _calibrated(logit, labels[check], share)
    model._rows.clear()
    model._table.clear()
    return model


def _calibrated(x: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and offset of a logistic curve, fitted by Newton steps on labels
    softened by one doubtful text each; toxic texts weigh ``share``."""
    n1, n0 = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(y == 1, share / n1, (1 - share) / n0) * len(y)
    a = np.column_stack([x, np.ones_like(x)])
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(a @ theta)
        hessian = (a * (weight * p * (1 - p))[:, None]).T @ a + np.diag([1e-3, 1e-6])
        move = np.linalg.solve(hessian, a.T @ (weight * (p - target)) + np.array([1e-3 * theta[0], 0]))
        theta = theta - np.clip(move, -1, 1)
    return float(max(theta[0], 1e-3)), float(theta[1])


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    training: Training = Training(),
) -> ToxicityModel | None:
    """Fit on ``docs`` that ``labels`` (id, 0 or 1) marks; where an id has
    several labels, 1 counts.  A sample by hash of the id, of a bounded size, is
    joined with the texts.  Null labels and null texts are left out; None unless
    both labels occur."""
    marks = labels.select(labels[id_col].alias("doc_id"), labels[label_col].cast("int").alias("toxic"))
    marks = marks.where("doc_id is not null and toxic is not null")
    sizes = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return None
    span = 1 << 20
    place = F.xxhash64(F.lit("sample"), F.col("doc_id").cast("string"))
    rate = F.when(F.col("toxic") == 1, int(span * min(1.0, training.per_label / sizes[1]))).otherwise(
        int(span * min(1.0, training.per_label / sizes[0]))
    )
    chosen = (
        marks.withColumn("place", place)
        .where(F.pmod("place", F.lit(span)) < rate)
        .groupBy("doc_id", "place")
        .agg(F.max("toxic").alias("toxic"))
    )
    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text")).where("text is not null")
    rows = sorted(texts.join(F.broadcast(chosen), "doc_id").select("place", "toxic", "text").collect())
    return fit([r["text"] for r in rows], np.array([r["toxic"] for r in rows]), sizes[1] / (sizes[0] + sizes[1]), training)


def score(docs: DataFrame, model: ToxicityModel | None, text_col: str = "text", out_col: str = "toxicity") -> DataFrame:
    """All rows and columns of ``docs`` with the score, from 0 to 1, of the whole text.

    Null texts and texts without a word score 0, as all do where there is no
    model.  A column named ``out_col`` is replaced; rows keep their number."""
    docs = docs.drop(out_col)
    if model is None:
        return docs.withColumn(out_col, F.lit(0.0))
    place, names = docs.columns.index(text_col), [*docs.columns, out_col]

    def run(batches):
        for batch in in_slices(batches, 256):
            found = model.scores([t or "" for t in batch.column(place).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, type=pa.float64())], names=names)

    ship(docs.sparkSession)
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out_col, T.DoubleType())]))
