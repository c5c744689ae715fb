"""Fill-in-middle transformation of whole documents, as one Arrow pipeline.

A text is cut into units (lines with their line feed).  Two hashes of the
document's id pick the units where the prefix and the middle end, two more its
form.  A batch is split into lists of units once; they are flattened beside the
number of their document, get their ordinal in it and from that a role (prefix,
middle, suffix), are filtered by role, put back into lists and joined.  All of it
is compute functions over whole batches: no Python runs per document or line.

Nothing is shuffled, and the hashes depend on the id alone, so a task that runs
again gives the same rows.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import ship
from .common import in_slices

PLAIN, PSM, SPM = "plain", "psm", "spm"
SLICE_BYTES = 16 << 20  # of text that are cut at a time; one longer text is a slice of its own


@dataclass(frozen=True)
class Options:
    """``percent`` of the documents are transformed, ``spm_percent`` of these
    with the suffix first.  ``marks``: what stands before prefix, suffix and
    middle; none may be a part of another or overlap one."""

    seed: int = 7
    percent: int = 100
    spm_percent: int = 50
    marks: tuple[str, str, str] = ("<P>", "<S>", "<M>")


def _hashes(id_col: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the id."""
    told = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    digest = F.sha2(told, 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def _modulo(a, b):
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def _joined(values, counts) -> pa.Array:
    """Consecutive ``counts`` of the values, each joined to one text."""
    ends = np.cumsum(counts.to_numpy(zero_copy_only=False), dtype=np.int32)
    offsets = pa.array(np.concatenate([np.zeros(1, dtype=np.int32), ends]))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, values), pa.scalar("", pa.large_string()))


def transform(text: pa.Array, hashes: list[pa.Array], options: Options = Options()) -> dict[str, pa.Array]:
    """``n_units``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``
    of a batch of texts."""
    text = pc.fill_null(text.cast(pa.large_string()), "")
    pieces = pc.split_pattern(text, "\n")  # one more than there are line feeds
    flat, parent = pc.list_flatten(pieces), pc.list_parent_indices(pieces)
    sizes = pc.cast(pc.list_value_length(pieces), pa.int64())
    before = pc.subtract(pc.cumulative_sum(sizes), sizes)
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), pc.take(before, parent))
    last = pc.equal(ordinal, pc.subtract(pc.take(sizes, parent), 1))
    keep = pc.or_(pc.invert(last), pc.greater(pc.binary_length(flat), 0))
    line_feed = pa.scalar("\n", pa.large_string())
    units = pc.if_else(last, flat, pc.binary_join_element_wise(flat, line_feed, pa.scalar("", pa.large_string())))
    units, parent, ordinal = units.filter(keep), parent.filter(keep), ordinal.filter(keep)
    ended = pc.or_(pc.equal(pc.binary_length(text), 0), pc.ends_with(text, "\n"))
    n = pc.subtract(sizes, pc.cast(ended, pa.int64()))

    cuts = [_modulo(h, pc.add(n, 1)) for h in hashes[:2]]
    first, second = pc.min_element_wise(*cuts), pc.max_element_wise(*cuts)
    role = pc.add(
        pc.cast(pc.greater_equal(ordinal, pc.take(first, parent)), pa.int8()),
        pc.cast(pc.greater_equal(ordinal, pc.take(second, parent)), pa.int8()),
    )
    counts = (first, pc.subtract(second, first), pc.subtract(n, second))
    prefix, middle, suffix = (_joined(units.filter(pc.equal(role, k)), c) for k, c in enumerate(counts))

    plain = pc.or_(pc.equal(n, 0), pc.greater_equal(_modulo(hashes[2], pa.scalar(100, pa.int64())), options.percent))
    for mark in options.marks:
        plain = pc.or_(plain, pc.match_substring(text, mark))
    spm = pc.less(_modulo(hashes[3], pa.scalar(100, pa.int64())), options.spm_percent)
    p, s, m = (pa.scalar(mark, pa.large_string()) for mark in options.marks)
    none = pa.scalar("", pa.large_string())
    as_psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, none)
    as_spm = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, none)
    no_chars = pa.scalar(None, pa.int64())
    return {
        "n_units": n,
        "form": pc.if_else(plain, PLAIN, pc.if_else(spm, SPM, PSM)),
        "prefix_chars": pc.if_else(plain, no_chars, pc.cast(pc.utf8_length(prefix), pa.int64())),
        "middle_chars": pc.if_else(plain, no_chars, pc.cast(pc.utf8_length(middle), pa.int64())),
        "output": pc.if_else(plain, text, pc.if_else(spm, as_spm, as_psm)),
    }


def _by_bytes(batch: pa.RecordBatch, column: int):
    """Slices of a batch with at most SLICE_BYTES of text, or one row."""
    sizes = pc.fill_null(pc.cast(pc.binary_length(batch.column(column)), pa.int64()), 0)
    ends, at = np.cumsum(sizes.to_numpy(zero_copy_only=False)), 0
    while at < batch.num_rows:
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", options: Options = Options()
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_units, form (plain, psm or spm),
    prefix_chars and middle_chars (code points, null if plain) and the output.

    psm is prefix, suffix, middle, spm is suffix, prefix, middle, each after its
    mark.  A text stays as it is (plain) if it is null (then it counts as empty),
    empty or holds a mark.  Rows that repeat an id with one text get one result;
    a null id is hashed as an empty one.  Other columns are not read."""
    pairs = docs.select(
        docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"), *_hashes(docs[id_col], options.seed)
    )
    ship(docs.sparkSession)
    names = ["n_units", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches):
        for batch in in_slices(batches, 4096):
            for part in _by_bytes(batch, 1):
                made = transform(part.column(1), [part.column(k) for k in range(2, 6)], options)
                columns = [part.column(0), *(made[n] for n in names[:-1]), made["output"].cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *names])

    kind = pairs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_units long, form string, prefix_chars long, middle_chars long, output string"
    return pairs.mapInArrow(run, schema)


def restored(output: Column, form: Column, options: Options = Options()) -> Column:
    """The exact text, from the output and its form."""
    p, s, m = (F.lit(mark) for mark in options.marks)
    one, two = F.lit(1), F.lit(2)

    def between(start, end):  # what stands between two marks
        return F.split_part(F.split_part(output, start, two), end, one)

    middle = F.split_part(output, m, two)
    return (
        F.when(form == PSM, F.concat(between(p, s), middle, between(s, m)))
        .when(form == SPM, F.concat(between(p, m), middle, between(s, p)))
        .otherwise(output)
    )
