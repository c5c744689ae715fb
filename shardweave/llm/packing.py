"""Vector bin packing of token sequences.

A sequence has room for three things at once: tokens, segments (pieces) and
loss-bearing tokens.  An open sequence takes, of all waiting items that fit in
every dimension, the one with the greatest dot product of its size and the
sequence's free room, both as shares of the limits.  Where cutting is allowed,
items longer than a sequence are cut into full ones first, and room that no
whole item fits is filled with the head of a waiting item.

Each task packs the rows it reads, in a pool of bounded size, and writes whole
sequences; nothing is shuffled and no sequence spans tasks, so a task that runs
again replaces all of its sequences.  Per task at most the last few sequences
are padded.
"""

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ..plans import ship

POOL = 2048  # items that wait at a time
FLUSH_TOKENS = 1 << 20  # tokens of finished pieces that are kept before they are handed on


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold."""

    tokens: int = 1024
    segments: int = 64
    loss_tokens: int = 1024


class _Item:
    __slots__ = ("key", "ids", "loss", "start", "total")

    def __init__(self, key, ids, loss, start, total):
        self.key, self.ids, self.loss, self.start, self.total = key, ids, loss, start, total

    def head(self, n: int) -> "_Item":
        return _Item(self.key, self.ids[:n], self.loss[:n], self.start, self.total)

    def tail(self, n: int) -> "_Item":
        return _Item(self.key, self.ids[n:], self.loss[n:], self.start + n, self.total)


class Packer:
    """Packs items as they come; ``emit(sequence, offset, item)`` gets each placed piece.

    An item over a limit that cannot be cut is refused with ValueError."""

    def __init__(self, limits: Limits, cut: bool, min_piece: int, emit: Callable, pool: int = POOL):
        self.limits, self.cut, self.min_piece, self.emit, self.pool = limits, cut, min_piece, emit, pool
        self.room = np.array([limits.tokens, limits.segments, limits.loss_tokens], dtype=np.float64)
        self.items: list[_Item] = []
        self.sequence = 0

    def add(self, item: _Item) -> None:
        tokens, loss = len(item.ids), int(item.loss.sum())
        if self.cut:
            step = self.limits.tokens
            while len(item.ids) >= step and int(item.loss[:step].sum()) <= self.limits.loss_tokens:
                self.emit(self.sequence, 0, item.head(step))
                self.sequence += 1
                item = item.tail(step)
            while len(item.ids) and (
                len(item.ids) > step or int(item.loss.sum()) > self.limits.loss_tokens
            ):  # as much as one sequence may hold, by tokens and by loss
                n = min(step, int(np.searchsorted(np.cumsum(item.loss), self.limits.loss_tokens, "right")))
                self.items.append(item.head(n))
                item = item.tail(n)
        elif tokens > self.limits.tokens or loss > self.limits.loss_tokens:
            raise ValueError(f"item {item.key!r} of {tokens} tokens, {loss} with loss, does not fit {self.limits}")
        if len(item.ids):
            self.items.append(item)
        if len(self.items) >= 2 * self.pool:
            self.drain(self.pool)

    def drain(self, keep: int = 0) -> None:
        """Fill sequences until at most ``keep`` items wait.  A sequence is
        closed when nothing that waits fits."""
        items = self.items
        size = np.array([(len(i.ids), 1, int(i.loss.sum())) for i in items], dtype=np.float64).reshape(-1, 3)
        share, waiting, left = size / self.room, np.ones(len(items), dtype=bool), len(items)
        while left > keep:
            free, at = self.room.copy(), 0
            while True:
                fits = waiting & (size <= free).all(axis=1)
                if fits.any():
                    k = int(np.argmax(np.where(fits, share @ (free / self.room), -1.0)))
                    piece = items[k]
                    waiting[k], left = False, left - 1
                else:
                    k, n = self._cut_at(waiting, size, free)
                    if not n:
                        break
                    piece, items[k] = items[k].head(n), items[k].tail(n)
                    size[k] = len(items[k].ids), 1, int(items[k].loss.sum())
                    share[k] = size[k] / self.room
                self.emit(self.sequence, at, piece)
                at += len(piece.ids)
                free -= (len(piece.ids), 1, int(piece.loss.sum()))
            self.sequence += 1
        self.items = [i for i, w in zip(items, waiting, strict=True) if w]

    def _cut_at(self, waiting, size, free) -> tuple[int, int]:
        """The longest waiting item and how much of it fills the room, if both
        parts are worth a piece."""
        room = int(min(free[0], free[2]))
        if not self.cut or free[1] < 1 or room < self.min_piece or not waiting.any():
            return 0, 0
        k = int(np.argmax(np.where(waiting, size[:, 0], -1.0)))
        n = min(room, int(size[k, 0]) - self.min_piece)
        return (k, n) if n >= self.min_piece else (0, 0)


@lru_cache(maxsize=2)
def byte_bpe(path: str):
    """An encoder of ``path``, a byte-level BPE file of the ``tokenizers``
    format.  Its vocabulary runs in tiktoken, which gives the same ids in a
    fifth of the time (a test compares them)."""
    import json

    import tiktoken
    from public_tokenizers import PATTERN

    file = json.load(open(path, encoding="utf-8"))
    model, added = file["model"], {t["content"]: t["id"] for t in file.get("added_tokens", [])}
    # bytes that print stand for themselves in such files, the others for 256 and on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    to_byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    ranks = {
        bytes(map(to_byte.__getitem__, token)): i
        for token, i in model["vocab"].items()
        if all(c in to_byte for c in token) and token not in added
    }
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)


#: What ``\s`` of the tokenizer's pattern is.  Its look-ahead keeps a place to go
#: back to for each character of a run, which tiktoken refuses from some 900,000 on.
_LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")

_LONG_TEXT = 100_000  # shorter texts have no such run; they are not searched


def encode(encoder, text: str) -> list[int]:
    """The ids of a text; added tokens are themselves wherever their text is, as
    in ``tokenizers``.  A long run of white space is cut out where the pattern cuts
    too: it is one piece, less its last character if something follows."""
    if len(text) < _LONG_TEXT or not _LONG_SPACE.search(text):
        return encoder.encode(text, allowed_special="all")
    added = sorted(encoder.special_tokens_set, key=len, reverse=True)
    parts = re.split(f"({'|'.join(map(re.escape, added))})", text) if added else [text]
    ids: list[int] = []
    for k, part in enumerate(parts):
        if k % 2:
            ids.append(encoder.encode_single_token(part))
            continue
        at = 0
        for run in _LONG_SPACE.finditer(part):
            end = run.end() - (run.end() < len(part))
            ids += encoder.encode_ordinary(part[at : run.start()])
            ids += encoder._encode_single_piece(part[run.start() : end])
            at = end
        ids += encoder.encode_ordinary(part[at:])
    return ids


def _read_items(batch, tokenizer: str | None, end_id: int | None) -> Iterator[_Item]:
    columns = [batch.column(i) for i in range(batch.num_columns)]
    encoder = byte_bpe(tokenizer) if tokenizer else None
    for row in range(batch.num_rows):
        key, value = columns[0][row].as_py(), columns[1][row].as_py()
        if encoder:
            ids = np.array(encode(encoder, value or ""), dtype="<u4")
        else:
            ids = np.array(value or [], dtype="<u4")
        loss = np.ones(len(ids), dtype=np.int8)
        if len(columns) > 2 and (mask := columns[2][row].as_py()) is not None:
            loss[:] = mask
        if end_id is not None:  # the end of a document bears no loss
            ids, loss = np.append(ids, np.uint32(end_id)).astype("<u4"), np.append(loss, np.int8(0))
        yield _Item(key, ids, loss, 0, len(ids))


def _pack(df: DataFrame, limits: Limits, cut: bool, min_piece: int, tokenizer, end_id) -> DataFrame:
    ship(df.sparkSession)
    key_type = df.schema[0].dataType.simpleString()

    def run(batches):
        out: list[tuple] = []
        held = 0
        base = TaskContext.get().partitionId() << 40

        def emit(sequence, at, piece):
            nonlocal held
            out.append(
                (piece.key, piece.start, len(piece.ids), piece.total, base + sequence, at, int(piece.loss.sum()), piece.ids.tobytes())
            )
            held += len(piece.ids)

        packer, schema = Packer(limits, cut, min_piece, emit), None

        def flush():
            nonlocal held
            columns = list(zip(*out, strict=True))
            arrays = [pa.array(columns[0], type=schema.field(0).type)]
            arrays += [pa.array(c, type=pa.int64()) for c in columns[1:-1]] + [pa.array(columns[-1], type=pa.binary())]
            out.clear()
            held = 0
            return pa.RecordBatch.from_arrays(arrays, names=OUT)

        for batch in batches:
            schema = batch.schema
            for item in _read_items(batch, tokenizer, end_id):
                packer.add(item)
                if held >= FLUSH_TOKENS:
                    yield flush()
        packer.drain()
        if out:
            yield flush()

    kinds = [key_type, *["long"] * 6, "binary"]
    return df.mapInArrow(run, ", ".join(f"`{n}` {k}" for n, k in zip(OUT, kinds, strict=True)))


OUT = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "loss_tokens", "ids"]


def pack_examples(
    df: DataFrame, id_col: str, ids_col: str, mask_col: str | None = None, limits: Limits = Limits(), cut: bool = False, min_piece: int = 8
) -> DataFrame:
    """Pack token ids (array of int) with an optional loss mask (array of 0 and 1).

    A row per piece: doc_id, start and length in its example, doc_tokens (all of
    its example), sequence_id, offset in the sequence, loss_tokens, and ids as
    little-endian unsigned 32-bit integers.  Without ``cut`` an example over a
    limit is an error.  Null or empty examples give no piece; repeated rows are
    packed as often as they come; a null id stays null."""
    columns = [df[id_col].alias("doc_id"), df[ids_col].cast("array<int>").alias("ids")]
    if mask_col:
        columns.append(df[mask_col].cast("array<int>").alias("mask"))
    return _pack(df.select(columns), limits, cut, min_piece, None, None)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    limits: Limits = Limits(),
    min_piece: int = 8,
) -> DataFrame:
    """Tokenize whole texts, end each with ``end_id``, cut and pack them.

    ``tokenizer`` is the path of a byte-level BPE file that every executor can
    open.  Rows as from ``pack_examples``.  Null and empty texts are the end
    alone: one piece of one token, without loss.  Repeated rows are packed as
    often as they come, an empty table gives no rows."""
    pairs = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return _pack(pairs, limits, True, min_piece, tokenizer, end_id)
