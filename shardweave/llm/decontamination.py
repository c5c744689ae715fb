"""Benchmark decontamination by templates.

Numbers, units behind numbers and names are replaced by typed placeholders, in
documents and in benchmark items alike, so that a question with other figures
has the same template.  Windows of eight template words are joined by hash.
Where matched windows hold placeholders, the values must agree: along one
alignment of a document with an item each value of the item stands for one value
in the document, and no two names for the same one.

Built-in functions only.  A document's windows are made and probed in place
against the benchmark's, whose number is checked before they are broadcast; only
matches are shuffled.  Of windows that several items share word for word, values
included, the least item holds them, so a preamble of many items does not
multiply matches; windows that differ in values are each item's own.  What is a
name depends on the case of letters, so windows with values are also matched by
their lower-cased words alone.  An item shorter than a window that holds values is
looked for at its own length."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import cut_lineage

WINDOW = 8
MAX_BROADCAST_WINDOWS = 1_000_000  # about 200 MB at most; beyond it the windows are shuffled
NUMBER, NAME, UNIT = "\x01", "\x02", "\x03"  # mark a value; white space in no text's words

#: Units as they follow a number.
UNITS = (
    "kilometers? kilometres? meters? metres? centimeters? centimetres? millimeters? millimetres? miles? yards? feet foot inch inches "
    "kilograms? grams? milligrams? tons? tonnes? pounds? ounces? liters? litres? milliliters? millilitres? gallons? "
    "seconds? minutes? hours? days? weeks? months? years? dollars? euros? cents? percent degrees? "
    "km cm mm kg mg ml mph kmh lbs oz mi ft hrs? min sec %"
).split()


#: Words that are numbers, one by one ("one" is rather a pronoun).
NUMBER_WORDS = dict(
    zip(
        "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty "
        "thirty forty fifty sixty seventy eighty ninety hundred thousand million".split(),
        [*range(2, 20), *range(20, 100, 10), 100, 1000, 1_000_000],
        strict=True,
    )
)


@dataclass(frozen=True)
class Options:
    """``literal``: words of a window that must not be placeholders."""

    literal: int = 4


_PAIRS = "array<struct<item:string,doc:string>>"


def template_words(text: Column) -> Column:
    """Lower-cased words (runs of letters and digits) of a text; those that are
    values begin with a mark: NUMBER, UNIT (behind a number) or NAME (a
    capitalised word that does not begin a sentence)."""
    clean = F.translate(text, NUMBER + NAME + UNIT, "   ")
    units = "|".join(sorted(UNITS, key=len, reverse=True))
    begin, end = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"  # not within a word
    # separators within a number go, so that it stays one word
    marked = F.regexp_replace(clean, r"(?<=[0-9])[.,](?=[0-9])", "")
    marked = F.regexp_replace(marked, rf"(?i){begin}([0-9]+)({units}){end}", "$1 $2")
    marked = F.regexp_replace(marked, rf"{begin}([0-9]+){end}", f" {NUMBER}$1 ")
    marked = F.regexp_replace(marked, rf"(?i)({NUMBER}[0-9]+)\s+({units}){end}", f"$1 {UNIT}$2")
    with_numbers = F.when(clean.rlike("[0-9]"), marked).otherwise(clean)
    with_names = F.regexp_replace(with_numbers, r"(\s+)(?=\p{Lu}\p{Ll})(?<=[\p{L}\p{N},;]\s{1,9})", f"$1{NAME}")
    return F.filter(F.split(F.lower(with_names), rf"[^\p{{L}}\p{{N}}%{NUMBER}{NAME}{UNIT}]+", -1), lambda w: w != "")


def _is_marked(word: Column) -> Column:
    return word.startswith(NUMBER) | word.startswith(NAME) | word.startswith(UNIT)


def _is_value(word: Column) -> Column:
    return _is_marked(word) | word.isin(*NUMBER_WORDS)


def _word_hash(word: Column) -> Column:
    kind = F.when(_is_marked(word), F.substring(word, 1, 1)).when(word.isin(*NUMBER_WORDS), NUMBER)
    return F.xxhash64(kind.otherwise(word))


def _literal(word: Column) -> Column:
    return F.when(_is_marked(word), F.substring(word, 2, 1 << 30)).otherwise(word)


def _value(word: Column) -> Column:
    """A marked word; words that are numbers as those in digits."""
    digits = F.create_map(*[F.lit(x) for w, n in NUMBER_WORDS.items() for x in (w, f"{NUMBER}{n}")])
    return F.coalesce(digits[word], word)


def _with_windows(df: DataFrame, lengths: tuple[int, ...] = ()) -> DataFrame:
    """``df`` with ``words``, ``has_values`` and ``windows``, the hashes of every
    window, of the whole text where it has fewer words: ``h`` of its template
    words and, in texts with values, ``l`` of the words themselves, in any case.
    ``inner``: the same of windows of other ``lengths`` within texts with values."""
    df = df.withColumn("words", template_words(F.col("text"))).drop("text")
    df = df.withColumn("has_values", F.exists("words", _is_value))
    kept = df.columns

    def hashes(h, literal):
        return F.struct(h.alias("h"), literal.alias("l"))

    # texts without values, most of them, have one hash per window; h and g are null for the other kind
    valued, plain = F.when(F.col("has_values"), F.col("words")), F.when(~F.col("has_values"), F.col("words"))
    df = df.withColumn("h1", F.transform(valued, lambda w: hashes(_word_hash(w), F.xxhash64(_literal(w)))))
    df = df.withColumn("g1", F.transform(plain, lambda w: F.xxhash64(w)))
    joins = {
        "h": lambda a, b: hashes(F.xxhash64(a["h"], b["h"]), F.xxhash64(a["l"], b["l"])),
        "g": lambda a, b: F.xxhash64(a, b),
    }
    for level, apart in ((2, 1), (4, 2), (8, 4)):  # the last ones lack their second half and are cut off in the end
        for kind, join in joins.items():
            of = f"{kind}{level // 2}"
            df = df.withColumn(f"{kind}{level}", F.zip_with(of, F.slice(of, F.lit(1 + apart), F.lit(1 << 30)), join))
    n = F.size("words")

    def of_all(pairs):
        return hashes(F.xxhash64(F.transform(pairs, lambda w: w["h"])), F.xxhash64(F.transform(pairs, lambda w: w["l"])))

    def inside(m):
        def at(i):
            return F.struct(i.alias("pos"), F.lit(m).alias("m"), of_all(F.slice("h1", i + 1, F.lit(m))).alias("w"))

        return F.when(F.col("has_values") & (n > m), F.transform(F.sequence(F.lit(0), n - m), at))

    if lengths:
        nothing = F.array().cast("array<struct<pos:int,m:int,w:struct<h:bigint,l:bigint>>>")
        df = df.withColumn("inner", F.concat(*[F.coalesce(inside(m), nothing) for m in lengths]))
        kept = [*kept, "inner"]
    no_literal = F.lit(None).cast("long")
    whole = F.when(F.col("has_values"), of_all(F.col("h1"))).otherwise(hashes(F.xxhash64("g1"), no_literal))
    each = F.coalesce("h8", F.transform("g8", lambda g: hashes(g, no_literal)))
    windows = F.when(n >= WINDOW, F.slice(each, F.lit(1), F.greatest(n - F.lit(WINDOW - 1), F.lit(0))))
    return df.select(*kept, windows.when(n > 0, F.array(whole)).otherwise(F.filter(F.array(whole), lambda w: F.lit(False))).alias("windows"))


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", options: Options = Options()) -> DataFrame:
    """(h, item_id, item_pos, item_words, item_windows, verbatim, valued): every window of
    the items once for each of its values, with the least item that has it so;
    windows with values also as they are, without placeholders: ``verbatim``.  An item whose
    windows would all be others' keeps its own; of items of the same words the
    least stands for all.  Windows with fewer literal words than asked for, or than
    all words of a shorter item, are there as they are only."""
    rows = items.select(items[id_col].alias("item_id"), F.coalesce(items[text_col].cast("string"), F.lit("")).alias("text"))
    each = (
        _with_windows(rows.where("item_id is not null"))
        .withColumn("item_windows", F.size("windows"))
        .select("item_id", F.xxhash64("words").alias("whole"), "words", "item_windows", F.posexplode("windows").alias("item_pos", "w"))
        .withColumn("item_words", F.expr(f"slice(words, item_pos + 1, {WINDOW})"))
    )
    valued = F.exists("item_words", _is_value)
    literal = F.size(F.filter("item_words", lambda w: ~_is_value(w)))
    enough = literal >= F.least(F.lit(options.literal), F.size("item_words"))
    template = F.struct(F.col("w.h").alias("h"), "item_words", F.lit(False).alias("verbatim"))
    verbatim = F.struct(F.col("w.l").alias("h"), F.transform("item_words", _literal).alias("item_words"), F.lit(True).alias("verbatim"))
    both = F.when(~enough, F.array(verbatim)).when(valued, F.array(template, verbatim)).otherwise(F.array(template))
    each = cut_lineage(each.select("item_id", "whole", "item_pos", "item_windows", valued.alias("valued"), F.inline(both)))

    def first(df):  # by the words too: windows with other values are other windows
        least = F.min(F.struct("item_id", "item_pos", "item_windows", "verbatim", "valued")).alias("w")
        return df.groupBy("h", "item_words", *[c for c in ("own",) if c in df.columns]).agg(least).select("h", "w.*", "item_words")

    held = cut_lineage(first(each))
    alone = each.groupBy("whole").agg(F.min("item_id").alias("item_id")).select("item_id").distinct()
    alone = alone.join(held.select("item_id").distinct(), "item_id", "left_anti")
    return held.unionByName(first(each.join(alone, "item_id", "left_semi").withColumn("own", F.col("item_id"))))


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    options: Options = Options(),
) -> DataFrame:
    """A row per document and item found in it: doc_id, item_id, n_windows
    (distinct windows of the item that it holds along its longest alignment),
    item_windows (all of the item's), n_values (placeholders checked) and
    is_exact (no value differs).  Windows of the same words match in any case of
    letters, unless values elsewhere along the alignment disagree.

    A text of fewer than eight words is one window.  An item that short is found
    within longer texts if it holds values, otherwise only in a text that is it.  Null and empty texts match nothing, and rows
    without an id are left out.  Rows with the same doc_id are one document; an
    empty table gives no rows."""
    known = cut_lineage(benchmark_windows(items, item_id_col, item_text_col, options))
    short = known.where(F.col("valued") & (F.size("item_words") < WINDOW)).select(F.size("item_words")).distinct()
    lengths = tuple(sorted(r[0] for r in short.collect()))  # fewer than WINDOW
    if known.count() <= MAX_BROADCAST_WINDOWS:
        known = F.broadcast(known)
    rows = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    rows = _with_windows(rows.where("doc_id is not null"), lengths)

    def probe(w, i, size, within):  # only windows of texts with values carry their words; one without values is the same in both
        own, inside = F.when(F.col("has_values"), F.slice("words", i + 1, size)), F.lit(within).alias("within")
        template = F.struct(i.alias("pos"), w["h"].alias("h"), own.alias("own"), inside)
        literal = F.struct(i.alias("pos"), w["l"].alias("h"), F.lit(None).cast("array<string>").alias("own"), inside)
        return F.when(w["l"] != w["h"], F.array(template, literal)).otherwise(F.array(template))

    asked = F.flatten(F.transform("windows", lambda w, i: probe(w, i, WINDOW, False)))
    if lengths:
        asked = F.concat(asked, F.flatten(F.transform("inner", lambda x: probe(x["w"], x["pos"], x["m"], True))))
    windows = rows.select("doc_id", F.inline(asked))
    pairs = F.zip_with("item_words", "own", lambda a, b: F.struct(_value(a).alias("item"), _value(b).alias("doc")))
    values = F.coalesce(F.filter(pairs, lambda p: _is_marked(p["item"])), F.array().cast(_PAIRS))
    same_kind = F.forall(values, lambda p: F.substring(p["item"], 1, 1) == F.substring(p["doc"], 1, 1))
    found = windows.join(known, "h").where(~F.col("within") | F.col("valued"))
    matches = found.select(
        "doc_id", "item_id", "item_windows", "item_pos", "verbatim", (F.col("pos") - F.col("item_pos")).alias("shift"), same_kind.alias("same"), values.alias("values")
    )
    matches = matches.where("same").drop("same")
    # an alignment has at most as many windows and values as the item
    aligned = matches.groupBy("doc_id", "item_id", "item_windows", "shift").agg(
        F.count_distinct("item_pos").alias("n_windows"),
        F.count_if((F.size("values") == 0) & ~F.col("verbatim")).alias("plain"),
        F.array_distinct(F.flatten(F.collect_set("values"))).alias("values"),
    )

    def distinct(side, kinds):
        return F.size(F.array_distinct(F.transform(F.filter("values", kinds), lambda p: p[side])))

    def any_kind(p):
        return p["item"].isNotNull()

    def names(p):
        return p["item"].startswith(NAME)

    agree = (distinct("item", any_kind) == F.size("values")) & (distinct("doc", names) == distinct("item", names))
    kept = aligned.where((F.col("plain") > 0) | agree)
    best = F.max(
        F.struct(
            "n_windows",
            F.forall("values", lambda p: p["item"] == p["doc"]).alias("is_exact"),
            F.size("values").alias("n_values"),
            "item_windows",
        )
    )
    return (
        kept.groupBy("doc_id", "item_id")
        .agg(best.alias("b"))
        .select(
            "doc_id",
            "item_id",
            F.col("b.n_windows").cast("long").alias("n_windows"),
            F.col("b.item_windows").cast("long").alias("item_windows"),
            F.col("b.n_values").cast("long").alias("n_values"),
            F.col("b.is_exact").alias("is_exact"),
        )
    )
