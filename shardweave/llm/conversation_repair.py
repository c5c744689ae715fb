"""Repair of the structure of conversations, as a stream of sorted rows.

Rows are dealt by conversation and sorted by turn; mapInPandas walks through the
Arrow batches of a task and carries, from batch to batch, what was seen so far and
the state of a dynamic program: for each state of the grammar ``(s?(ua)+)?`` the
cost of the cheapest edits that lead there, and the order of their audits.  What a
row does to that state depends on the row's class alone (first letter of the role,
fault), and the states that occur are few once costs are taken relative to the least
one, so a step is a lookup in a table that is made as it is used.

The cheapest edits are known only at the end of a conversation.  Each row leaves
four bytes of back pointers; these, the rows that may stay and the digests of the
rows seen are held in memory up to a bound and go to files of the task beyond
it.  So a conversation of any length takes memory of bounded size (but for its
audit, which is one value), and a task that runs again does so from its rows.
"""

import hashlib
import struct
import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import ship
from .common import NO_SPACE

# Edits of a row, and inserts before it.  Their costs:
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
#: Where the output may stand: nothing yet, after a system, a user, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
_AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The user or assistant turn that may come next, and what an inserted or changed row becomes.
_ROLE_NEXT = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
_ENDS = (START, ASSISTANT)
#: No state that costs so much more than the cheapest leads to cheapest edits: with
#: at most two inserts and a deletion that one gives whatever the other can.
_HOPELESS = 2 * INSERT_COST + DELETE_COST + 1
_INSERTS = 2  # in one place; more would only go round the grammar

#: Faults of a row; the first that holds counts.
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
_INITIALS = "sua?"  # the last stands for all others
_LETTERS = KEEP + REROLE + DELETE


def _inserted(state: int, n: int) -> int:
    for _ in range(n):
        state = _AFTER[state, _ROLE_NEXT[state][0]]
    return state


def _edits(state: int, initial: str, fault: int) -> Iterator[tuple[int, int, str]]:
    """(next state, cost, letter) of the edits of a row."""
    yield state, DELETE_COST, DELETE
    if fault in (BLANK, DUPLICATE):
        return
    more = TRUNCATED_COST if fault == TRUNCATED else 0
    if (state, initial) in _AFTER:
        yield _AFTER[state, initial], more, KEEP
    yield _AFTER[state, _ROLE_NEXT[state][0]], REROLE_COST + more, REROLE


@dataclass(frozen=True)
class _Step:
    to: int  # the state of the program after the row
    cost: int  # what is added to the least cost
    back: bytes  # per state of the grammar: where it came from, inserts, edit, and the row's fault


class Program:
    """The dynamic program, as a table made as it is used.

    A state of it is, for each state of the grammar that can be reached, the cost
    above the least one and the place of its audit in order.  The audit of one
    state is never the beginning of another's: all have an edit for each row and
    end with one, and an audit tells its state."""

    def __init__(self):
        self._number: dict[tuple, int] = {}
        self._members: list[tuple] = []
        self._steps: list[dict[int, _Step]] = []
        self.first = self._state(((0, 0), None, None, None))

    def _state(self, members: tuple) -> int:
        if members not in self._number:
            self._number[members] = len(self._members)
            self._members.append(members)
            self._steps.append({})
        return self._number[members]

    def step(self, state: int, kind: int) -> _Step:
        """``kind``: 4 * place of the initial + fault."""
        found = self._steps[state].get(kind)
        if found is None:
            found = self._steps[state][kind] = self._make(state, _INITIALS[kind // 4], kind % 4)
        return found

    def _make(self, state: int, initial: str, fault: int) -> _Step:
        best: list[tuple | None] = [None] * 4
        for origin, member in enumerate(self._members[state]):
            if member is None:
                continue
            for n in range(_INSERTS + 1):
                for to, cost, letter in _edits(_inserted(origin, n), initial, fault):
                    way = (member[0] + n * INSERT_COST + cost, member[1], INSERT * n + letter, origin)
                    if best[to] is None or way < best[to]:
                        best[to] = way
        least = min(w[0] for w in best if w)
        live = {s: w for s, w in enumerate(best) if w and w[0] - least < _HOPELESS}
        order = {s: k for k, s in enumerate(sorted(live, key=lambda s: live[s][1:3]))}
        members = tuple((live[s][0] - least, order[s]) if s in live else None for s in range(4))
        back = bytes(
            (live[s][3] | (len(live[s][2]) - 1) << 2 | _LETTERS.index(live[s][2][-1]) << 4 | fault << 6) if s in live else 0
            for s in range(4)
        )
        return _Step(self._state(members), least, back)

    def end(self, state: int) -> tuple[int, int, int]:
        """(cost added, state of the grammar, inserts after the last row) of the cheapest end."""
        ways = [
            (member[0] + n * INSERT_COST, member[1], n, origin)
            for (origin, member), n in product(enumerate(self._members[state]), range(_INSERTS + 1))
            if member is not None and _inserted(origin, n) in _ENDS
        ]
        cost, _, n, origin = min(ways)
        return cost, origin, n


class Spool:
    """Bytes in memory up to a bound, beyond it in a file of the task."""

    def __init__(self, bound: int):
        self._file = tempfile.SpooledTemporaryFile(max_size=bound)
        self.size = 0

    def add(self, data: bytes) -> None:
        self._file.write(data)
        self.size += len(data)

    def backwards(self, block: int) -> Iterator[bytes]:
        """Its blocks from the last to the first; all but the first of ``block`` bytes."""
        end = self.size
        while end > 0:
            at = max(0, end - block)
            self._file.seek(at)
            yield self._file.read(end - at)
            end = at

    def read(self) -> Callable[[int], bytes]:
        self._file.seek(0)
        return self._file.read

    def close(self) -> None:
        self._file.close()


class Seen:
    """Digests that came before: a set up to a bound, then sorted runs in files
    of the task, merged as they double, so there are few of them."""

    WIDTH = 16

    def __init__(self, bound: int):
        self.bound, self._new, self._runs = bound, set(), []

    def add(self, digest: bytes) -> bool:
        """Whether the digest was there already; it is from now on."""
        if digest in self._new or any(self._in_run(digest, run) for _, run in self._runs):
            return True
        self._new.add(digest)
        if len(self._new) * 8 * self.WIDTH >= self.bound:  # a set takes some eight times its digests
            self._spill()
        return False

    @staticmethod
    def _in_run(digest: bytes, run: np.ndarray) -> bool:
        wanted = np.array([digest], dtype=run.dtype)
        at = int(np.searchsorted(run, wanted)[0])
        return at < len(run) and run[at] == wanted[0]

    def _spill(self) -> None:
        run = np.sort(np.array(list(self._new), dtype=f"S{self.WIDTH}"))
        self._new = set()
        self._runs.append(self._written([run]))
        while len(self._runs) > 1 and len(self._runs[-2][1]) <= len(self._runs[-1][1]):
            (old_file, old), (file, run) = self._runs[-2:]
            # one first byte after the other, so that little of the runs is in memory
            firsts = np.array([bytes([b]) for b in range(256)], dtype=run.dtype)
            ends = [[*np.searchsorted(r, firsts).tolist(), len(r)] for r in (old, run)]
            parts = (np.sort(np.concatenate([old[o:p], run[n:m]])) for o, p, n, m in zip(ends[0], ends[0][1:], ends[1], ends[1][1:], strict=False))
            self._runs[-2:] = [self._written(parts)]
            old_file.close()
            file.close()

    @staticmethod
    def _written(parts) -> tuple:
        file = tempfile.TemporaryFile()
        for part in parts:
            file.write(part.tobytes())
        file.flush()
        return file, np.memmap(file, dtype=f"S{Seen.WIDTH}", mode="r")

    def close(self) -> None:
        for file, _ in self._runs:
            file.close()


#: Bytes that a conversation holds in memory of back pointers, of rows and of digests, each.
HELD_BYTES = 8 << 20
_LENGTHS = struct.Struct("<QQ")


class Walk:
    """One conversation, row by row."""

    def __init__(self, program: Program, held_bytes: int = HELD_BYTES):
        self.program, self.state, self.cost = program, program.first, 0
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.least = self.most = self.last_turn = None
        self.turns = 0
        self._initial = None
        self._back, self._kept, self._seen = Spool(held_bytes), Spool(held_bytes), Seen(held_bytes)

    def add(self, turn: int | None, role: str, text: str, blank: bool, ended: bool) -> None:
        initial = role[:1]
        if self.rows and self._initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.rows, self._initial = self.rows + 1, initial
        if turn is not None and turn != self.last_turn:
            self.least = turn if self.least is None else self.least
            self.most = self.last_turn = turn
            self.turns += 1
        name, body = role.encode("utf-8", "surrogatepass"), text.encode("utf-8", "surrogatepass")
        if blank:
            fault = BLANK
            self.blank += 1
        elif self._seen.add(hashlib.blake2b(_LENGTHS.pack(len(name), len(body)) + name + body, digest_size=Seen.WIDTH).digest()):
            fault = DUPLICATE
            self.duplicate += 1
        else:
            fault = FINE if ended else TRUNCATED
            self.truncated += fault == TRUNCATED
            self._kept.add(_LENGTHS.pack(len(name), len(body)) + name + body)
        place = _INITIALS.find(initial or "?") % len(_INITIALS)  # -1 is the last
        step = self.program.step(self.state, 4 * place + fault)
        self.state, self.cost = step.to, self.cost + step.cost
        self._back.add(step.back)

    @property
    def gaps(self) -> int:
        return 0 if self.least is None else self.most - self.least + 1 - self.turns

    def finish(self) -> tuple[str, Iterator[tuple[str, bytes, bytes]]]:
        """The audit, and the repaired rows as (edit, role, text)."""
        cost, at, inserts = self.program.end(self.state)
        self.cost += cost
        audit, faults = bytearray(INSERT.encode() * inserts), bytearray()
        for block in self._back.backwards(4 * 65536):
            for k in range(len(block) - 4, -1, -4):
                pointer = block[k + at]
                audit += (_LETTERS[pointer >> 4 & 3] + INSERT * (pointer >> 2 & 3)).encode()
                faults.append(pointer >> 6)
                at = pointer & 3
        audit.reverse()
        faults.reverse()
        return audit.decode(), self._repaired(audit, faults)

    def _repaired(self, audit: bytearray, faults: bytearray) -> Iterator[tuple[str, bytes, bytes]]:
        read, state, row = self._kept.read(), START, 0
        for letter in map(chr, audit):
            if letter == INSERT:
                role, text = _ROLE_NEXT[state].encode(), b""
            else:
                row += 1
                if faults[row - 1] in (BLANK, DUPLICATE):
                    continue
                sizes = _LENGTHS.unpack(read(_LENGTHS.size))
                role, text = read(sizes[0]), read(sizes[1])
                if letter == DELETE:
                    continue
                if letter == REROLE:
                    role = _ROLE_NEXT[state].encode()
            state = _AFTER[state, role[:1].decode()]
            yield letter, role, text

    def close(self) -> None:
        for held in (self._back, self._kept, self._seen):
            held.close()


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_ROWS_AT_ONCE = 1024


def _report(walk: Walk) -> tuple:
    audit, repaired = walk.finish()
    digest, first = hashlib.sha256(), True
    for _, role, text in repaired:
        digest.update((b"" if first else b"\n") + role + b":" + text)
        first = False
    return walk.gaps, walk.blank, walk.duplicate, walk.truncated, walk.illegal, walk.cost, audit, digest.hexdigest()


def _sorted(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, present: Column | None) -> DataFrame:
    role, text = (F.coalesce(rows[c].cast("string"), F.lit(" ")) for c in (role_col, text_col))
    key, turn = rows[id_col], rows[turn_col].cast("long")
    # a null would turn a whole column of a frame to floating point
    whole = isinstance(rows.schema[id_col].dataType, T.IntegralType)
    taken = rows.select(
        (F.coalesce(key, F.lit(0).cast(rows.schema[id_col].dataType)) if whole else key).alias("conv_id"),
        key.isNotNull().alias("id_known"),
        F.coalesce(turn, F.lit(0)).cast("long").alias("turn"),
        turn.isNotNull().alias("turn_known"),
        role.alias("role"),
        text.alias("text"),
        (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("present"),
        (~text.rlike(NO_SPACE)).alias("blank"),
        text.rlike(rf"[.!?][\x20\x09-\x0D]*\z").alias("ended"),
    )
    together = taken.repartition("id_known", "conv_id")
    return together.sortWithinPartitions("id_known", "conv_id", "turn_known", "turn", "role", "text")


_TAKEN = ["conv_id", "id_known", "turn", "turn_known", "role", "text", "blank", "ended", "present"]


def _walks(frames: Iterator[pd.DataFrame], held_bytes: int) -> Iterator[tuple[object, Walk]]:
    """(conversation, its finished walk), as the sorted rows end it."""
    program, walk, current = Program(), None, None
    for frame in frames:
        columns = [frame[c].tolist() for c in _TAKEN]
        for key, id_known, turn, turn_known, role, text, blank, ended, present in zip(*columns, strict=True):
            key = key if id_known else None
            if walk is None or key != current:
                if walk is not None:
                    yield current, walk
                    walk.close()
                walk, current = Walk(program, held_bytes), key
            if present:
                walk.add(turn if turn_known else None, role, text, blank, ended)
    if walk is not None:
        yield current, walk
        walk.close()


def repair_report(
    rows: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    present: Column | None = None,
    held_bytes: int = HELD_BYTES,
) -> DataFrame:
    """One row per conversation: id, numbers of missing turns, of blank, repeated
    and truncated rows and of neighbours that may not follow each other, the cost
    of the cheapest edits, their letters in order (of equal costs the least in
    ASCII), and the SHA-256 of the repaired ``role:text`` lines.

    A role's first letter is its initial; an empty role has none and cannot be kept.
    Null roles and texts count as one space; rows without a turn come first; rows
    of one turn are taken by role and text.  Rows where ``present`` is not true
    only make their conversation known: one without other rows has zeros, no edits
    and the digest of nothing.  A null id is a conversation of its own.  Other
    columns are not read."""
    ship(rows.sparkSession)
    taken = _sorted(rows, id_col, turn_col, role_col, text_col, present)
    names = ["conv_id", *(c.split()[0] for c in REPORT.split(", "))]
    kind = taken.schema["conv_id"].dataType.simpleString()

    def run(frames):
        out: list[tuple] = []
        for key, walk in _walks(frames, held_bytes):
            out.append((key, *_report(walk)))
            if len(out) >= _ROWS_AT_ONCE or len(out[-1][-2]) > HELD_BYTES:
                yield _frame(out, names)
                out = []
        if out:
            yield _frame(out, names)

    return taken.mapInPandas(run, f"conv_id {kind}, {REPORT}")


def _frame(out: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(out, columns=names, dtype=object)
    return frame.astype({n: "int64" for n in names if n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "position")})


def repaired_turns(
    rows: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    present: Column | None = None,
    held_bytes: int = HELD_BYTES,
) -> DataFrame:
    """The repaired conversations: id, position from 0, role, text and the letter
    of the edit that gave the row.  Rows are taken as in :func:`repair_report`; a
    conversation of which nothing is left has none."""
    ship(rows.sparkSession)
    taken = _sorted(rows, id_col, turn_col, role_col, text_col, present)
    names, kind = ["conv_id", "position", "role", "text", "edit"], taken.schema["conv_id"].dataType.simpleString()

    def run(frames):
        out, held = [], 0
        for key, walk in _walks(frames, held_bytes):
            for k, (letter, role, text) in enumerate(walk.finish()[1]):
                out.append((key, k, role.decode("utf-8", "surrogatepass"), text.decode("utf-8", "surrogatepass"), letter))
                held += len(text)
                if len(out) >= _ROWS_AT_ONCE or held > HELD_BYTES:
                    yield _frame(out, names)
                    out, held = [], 0
        if out:
            yield _frame(out, names)

    return taken.mapInPandas(run, f"conv_id {kind}, position long, role string, text string, edit string")


def damaged(rows: DataFrame) -> DataFrame:
    """The conversations with known damage, for tests of a repair: what happens to
    a row depends on the crc32 of ``conv_id:turn`` modulo 20.  It goes (0; the row
    stays here with ``present`` false), loses its text (1) or its ends of sentences
    (2), comes twice (3), or gets the role user (4).  Nulls count as one space."""
    told = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    kind = F.crc32(F.concat_ws(":", *told[:2]).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(told[3], "[.!?]", "")).otherwise(told[3])
    copies = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(told[2]).alias("role"), text.alias("text"),
        (kind != 0).alias("present"), copies.alias("copies"),
    ).select("conv_id", "turn", "role", "text", "present", F.explode("copies").alias("copy")).drop("copy")
