"""Chat formatting: records of any known layout become canonical turns, turns
become one training text with a loss mask.

A record is a VARIANT.  Of its nested field paths those that a mapping knows are
hashed; the hash selects the declarative mapping to turns, whatever ids, sources or
tool fields lie beside them.  Conversations are then written in one template whose control strings are escaped inside texts, so the
text can be read back exactly.

Built-in functions only.  Turns are mapped and escaped row by row; only finished
pieces of a conversation meet, as its text is one value."""

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<turn:bigint,role:string,text:string>>"


@dataclass(frozen=True)
class Mapping:
    """``paths``: the field paths that the layout knows (``list[].field`` is there if
    some member has it, ``list[]`` if the list is empty); ``shapes``: which of them
    together make the layout; ``turns``: record -> array of (turn, role, text)."""

    name: str
    paths: tuple[str, ...]
    shapes: tuple[tuple[str, ...], ...]
    turns: Callable[[Column], Column]

    def fits(self, record: Column) -> Column:
        return known_print(record, self.paths).isin([_print(s, self.paths) for s in self.shapes])


def _has(record: Column, path: str) -> Column:
    if "[]" not in path:
        return _field(record, f"$.{path}", "variant").isNotNull()
    name, _, field = path.partition("[]")
    members = _field(record, f"$.{name}", "array<variant>")
    there = F.exists(members, lambda m: _field(m, f"${field}", "variant").isNotNull()) if field else F.size(members) == 0
    return F.coalesce(members.isNotNull() & there, F.lit(False))


def known_print(record: Column, paths: tuple[str, ...]) -> Column:
    """The fingerprint of a record as far as ``paths`` tell it."""
    there = F.array(*[F.when(_has(record, p), F.lit(p)) for p in paths])
    return F.md5(F.array_join(there, "\n").cast("binary"))


def _print(shape: tuple[str, ...], paths: tuple[str, ...]) -> str:
    return hashlib.md5("\n".join(p for p in paths if p in shape).encode()).hexdigest()


def _field(record: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(record, path, kind)


def _turn(turn, role, text) -> Column:
    return F.struct(turn.cast("long").alias("turn"), role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _text(value: Column) -> Column:
    """The text of a message: a string, or the texts of a list of parts, of which
    those without text are left out."""
    parts = _field(value, "$", "array<variant>")
    of_part = lambda p: F.when(F.schema_of_variant(p) == "STRING", _field(p, "$")).otherwise(_field(p, "$.text"))
    texts = F.filter(F.transform(parts, of_part), lambda t: t.isNotNull())
    return F.when(parts.isNotNull(), F.array_join(texts, "\n\n")).otherwise(F.coalesce(_field(value, "$.text"), _field(value, "$")))


def _list(name: str, role: str, text: str) -> Mapping:
    """The layout with a list of messages under ``name``."""
    paths = (f"{name}[].{role}", f"{name}[].{text}", f"{name}[]")
    shapes = (paths[:2], paths[:1], paths[2:])

    def turns(record):
        members = _field(record, f"$.{name}", "array<variant>")
        return F.transform(members, lambda m, i: _turn(i, _role(_field(m, f"$.{role}")), _text(_field(m, f"$.{text}", "variant"))))

    return Mapping(name, paths, shapes, turns)


def _fixed(*parts: tuple[str, tuple[str, ...]]) -> Callable[[Column], Column]:
    """Turns from fields: (role, paths); several paths are joined by a blank
    line, empty ones left out, and a turn without any text is left out."""

    def turns(record):
        made = []
        for k, (role, paths) in enumerate(parts):
            texts = F.filter(F.array(*[_field(record, p) for p in paths]), lambda t: t != "")
            made.append(_turn(F.lit(k), F.lit(role), F.array_join(texts, "\n\n")))
        return F.filter(F.array(*made), lambda t: (t["text"] != "") | (t["role"] != "system"))

    return turns


#: Names that other layouts give to the roles.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def _role(role: Column) -> Column:
    out = role
    for other, name in ROLE_NAMES.items():
        out = F.when(role == other, name).otherwise(out)
    return out


MAPPINGS = (
    Mapping(
        "turn rows",
        ("role", "text", "turn"),
        (("role", "text", "turn"),),
        lambda r: F.array(_turn(_field(r, "$.turn", "long"), _field(r, "$.role"), _field(r, "$.text"))),
    ),
    _list("messages", "role", "content"),
    _list("conversations", "from", "value"),
    Mapping(
        "instruction",
        ("instruction", "input", "output"),
        (("instruction", "output"), ("instruction", "input", "output")),
        _fixed(("user", ("$.instruction", "$.input")), ("assistant", ("$.output",))),
    ),
    Mapping(
        "question",
        ("question", "response", "answer", "system_prompt"),
        tuple((*s, a) for s in (("question",), ("question", "system_prompt")) for a in ("response", "answer")),
        lambda r: _question(r),
    ),
    Mapping("prompt", ("prompt", "response", "completion"), (("prompt", "response"), ("prompt", "completion")), lambda r: _prompt(r)),
)


def _prompt(r: Column) -> Column:
    return F.array(
        _turn(F.lit(0), F.lit("user"), _field(r, "$.prompt")),
        _turn(F.lit(1), F.lit("assistant"), F.coalesce(_field(r, "$.response"), _field(r, "$.completion"))),
    )


def _question(r: Column) -> Column:
    turns = F.array(
        _turn(F.lit(0), F.lit("system"), _field(r, "$.system_prompt")),
        _turn(F.lit(1), F.lit("user"), _field(r, "$.question")),
        _turn(F.lit(2), F.lit("assistant"), F.coalesce(_field(r, "$.response"), _field(r, "$.answer"))),
    )
    return F.filter(turns, lambda t: (t["role"] != "system") | (t["text"] != ""))


def field_paths(record: Column) -> Column:
    """The record's nested field paths as one text: its schema without the
    types of values, so that a null and a number differ in nothing."""
    schema = F.schema_of_variant(record)
    schema = F.regexp_replace(schema, r": (?!OBJECT<|ARRAY<)[A-Z_ ]+(\([0-9, ]+\))?", "")
    return F.regexp_replace(schema, r"ARRAY<(?!OBJECT<|ARRAY<)[A-Z_ ]+(\([0-9, ]+\))?>", "ARRAY<>")


def fingerprint(record: Column) -> Column:
    return F.md5(field_paths(record).cast("binary"))


def _layout(record: Column, mappings: tuple[Mapping, ...]) -> Column:
    out = F.lit(None).cast("string")
    for m in reversed(mappings):  # the first that fits counts
        out = F.when(m.fits(record), F.lit(m.name)).otherwise(out)
    return out


def canonical_turns(
    records: DataFrame, id_col: str, record_col: str, mappings: tuple[Mapping, ...] = MAPPINGS, strict: bool = False
) -> DataFrame:
    """(conv_id, layout, turn, role, text), a row per turn.

    Null texts are empty, null roles stay.  An empty list of messages has no turns
    and no rows.  A record that fits no mapping gives one row with layout, turn,
    role and text null, so that nothing is lost unseen (:func:`layouts` counts
    them); with ``strict`` it fails the job.  Repeated records give their turns
    again."""
    rows = records.select(records[id_col].alias("conv_id"), records[record_col].alias("record"))
    rows = rows.withColumn("layout", _layout(F.col("record"), mappings))
    if strict:
        told = F.concat(F.lit("no mapping for "), F.coalesce(field_paths(F.col("record")), F.lit("a null record")))
        rows = rows.withColumn("layout", F.coalesce("layout", F.raise_error(told).cast("string")))
    turns = F.lit(None).cast(TURNS)
    for m in mappings:
        turns = F.when(F.col("layout") == m.name, m.turns(F.col("record")).cast(TURNS)).otherwise(turns)
    nothing = F.when(F.col("layout").isNull(), F.array(F.lit(None).cast(TURNS[6:-1])))
    return rows.select("conv_id", "layout", F.inline(F.coalesce(turns, nothing)))


def layouts(records: DataFrame, record_col: str, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """(layout, paths, n): how many records have each layout and set of nested field
    paths; those that no mapping takes have layout null."""
    record = records[record_col]
    told = records.select(_layout(record, mappings).alias("layout"), field_paths(record).alias("paths"))
    return told.groupBy("layout", "paths").agg(F.count("*").alias("n"))


def turn_records(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """A table of turns (turn, role, text) as records of their own."""
    fields = [df[c].alias(c) for c in ("turn", "role", "text")]
    return df.select(df[id_col].alias("conv_id"), F.to_variant_object(F.struct(*fields)).alias("record"))


# ---- template

#: Marks of the roles; others are written as ROLE and the hex digits of their name.
TAGS = {"user": "INST", "assistant": "OUT", "system": "SYS"}
BEGIN, END = "<s>", "</s>"
_CONTROL = r"(?=/?s>|/?(?:INST|OUT|SYS|ROLE)(?: [0-9A-F]*)?\])"


def escape(text: Column) -> Column:
    """A backslash behind the bracket of every control string, those that have
    some there already included; ``unescape`` takes one away."""
    return F.regexp_replace(text, r"([<\[])(\\*)" + _CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _CONTROL, r"$1$2")


def _tag(role: Column) -> Column:
    out = F.concat(F.lit("ROLE "), F.hex(role.cast("binary")))
    for name, tag in TAGS.items():
        out = F.when(role == name, tag).otherwise(out)
    return out


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): a row per conversation of ``conv_id, turn,
    role, text``.

    Each turn is ``<s>[TAG] text [/TAG]</s>``.  ``loss`` is the mask, an array of
    (block, start, length): code points of the block'th turn that bear loss,
    which are those of the assistant's escaped text.  Turns go by number (null
    first), equal numbers by role and text; null roles and texts are empty.
    Turns without a conversation form one of their own."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    body = escape(F.col("text"))
    rows = rows.withColumn("tag", _tag(F.col("role"))).withColumn("body", body)
    block = F.concat(
        F.lit(f"{BEGIN}["), "tag", F.lit("] "), "body", F.lit(" [/"), F.split_part("tag", F.lit(" "), F.lit(1)), F.lit(f"]{END}")
    )
    marked = F.when(F.col("role") == "assistant", F.char_length("body"))
    pieces = rows.select("conv_id", F.struct("turn", "role", "text", block.alias("block"), marked.alias("marked")).alias("piece"))
    whole = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    start = len(f"{BEGIN}[OUT] ")
    spans = F.transform(
        "pieces",
        lambda p, i: F.struct(
            i.cast("long").alias("block"), F.lit(start).cast("long").alias("start"), p["marked"].cast("long").alias("length")
        ),
    )
    return whole.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: p["block"]), "").alias("formatted"),
        F.filter(spans, lambda s: s["length"].isNotNull()).alias("loss"),
    )


def blocks(formatted: Column) -> Column:
    """The turns of a formatted text, each up to its end mark."""
    parts = F.split(formatted, END, -1)
    return F.slice(parts, F.lit(1), F.size(parts) - 1)


def read_turns(formatted: Column) -> Column:
    """Array of (role, text), read back from a formatted text."""

    def read(block):
        tag = F.regexp_extract(block, r"^<s>\[([^\]]*)\]", 1)
        before = F.char_length(tag) + len(f"{BEGIN}[] ")
        after = F.char_length(F.split_part(tag, F.lit(" "), F.lit(1))) + len(" [/]")
        role = F.decode(F.unhex(F.split_part(tag, F.lit(" "), F.lit(2))), "utf-8")
        for name, own in TAGS.items():
            role = F.when(tag == own, name).otherwise(role)
        text = F.substring(block, before + 1, F.char_length(block) - before - after)
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return F.transform(blocks(formatted), read)


def read_loss(formatted_blocks: Column, loss: Column) -> Column:
    """The text under the loss mask, unescaped, in order; ``formatted_blocks``
    as from ``blocks``, kept in a column."""
    under = F.transform(
        loss,
        lambda s: unescape(
            F.substring(F.get(formatted_blocks, s["block"].cast("int")), (s["start"] + 1).cast("int"), s["length"].cast("int"))
        ),
    )
    return F.array_join(under, "")
