"""Grouped prefix join: documents whose word-shingle sets are alike, exactly.

1. Documents with equal sets become one class, which goes on alone.
2. Shingles are put in one order for all documents: those whose hash lies in a
   fixed share of all hash values come first, rare ones before common ones (they
   are counted over all documents), then the others by hash.  Two sets of a
   Jaccard similarity of at least t share a shingle among the first
   n - ceil(t n) + 1 of each, whatever the order; this one keeps passages that
   many documents share out of these prefixes.
3. Classes with the same prefix and size form a group.  Groups that share a
   prefix shingle and whose sizes allow t are pairs; pairs are expanded to
   members, and those that a parity sketch does not rule out are verified on
   the full sets.  (A set's sketch is the parity, by bucket, of its shingles;
   sketches differ in no more places than sets do.)

What is asked for are the classes that links connect, so a pair that links
already connect needs no check.  Members are first compared with their group's
head; those that do not link with it stand alone, so a group is one component
and all its members lie near the head.  In a few rounds each group is compared
with the nearest of some groups that share a prefix shingle with it; then all
pairs of groups still apart are, unless their heads' sketches are farther apart
than any two members can be.  A group of a million near copies costs about a
million checks, and no partner or candidate is left out.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans import cut_lineage, drop_cut, ship
from .common import id_and_text, in_slices
from .components import components
from .wordhash import mix, windows, word_hashes

SKETCH = 16  # longs of a parity sketch
PIVOTS = 32  # groups of a prefix shingle that the others of it are compared with in a round
SALTS = 16  # parts in which the groups of a prefix shingle are ranked
MAX_ROUNDS = 3  # of these comparisons; they save work, what they do not connect is compared in full
BATCH_ROWS = 1_024  # texts that a Python worker gets at once
WORTH = 0.005  # components for each group that a round must merge for another one


@dataclass(frozen=True)
class Similarity:
    """Shingles of ``words`` words, alike from ``percent`` on; ``share`` percent
    of the hash values are counted for the order."""

    words: int = 5
    percent: int = 80

    @property
    def share(self) -> float:
        return min(1.0, 1.06 - self.percent / 100)  # somewhat more than a prefix

    def prefix(self, n):
        """Shingles in the prefix of ``n``, in integers."""
        return n - (self.percent * n + 99) // 100 + 1


def _sets(texts: list[str], words: int) -> list[np.ndarray]:
    hashes, ends = word_hashes(texts)
    starts = np.concatenate([[0], ends[:-1]])
    return [np.unique(windows(hashes[a:b], words)) for a, b in zip(starts, ends, strict=True)]


def _long_lists(arrays: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate([*arrays, np.empty(0, dtype=np.uint64)]).astype(np.uint64).view(np.int64)
    return pa.ListArray.from_arrays(np.cumsum([0, *map(len, arrays)], dtype=np.int32), pa.array(flat))


def _class_id(s: np.ndarray) -> np.uint64:
    """64 bits of a set; two different sets among 10^8 share one with a chance of 1 in 3,000."""
    return np.uint64(0) if not len(s) else mix(np.array([mix(s).sum(dtype=np.uint64) + np.uint64(len(s))]))[0]


def _signatures(docs: DataFrame, sim: Similarity) -> DataFrame:
    """doc_id, row, cid, n, s (sampled shingles), low (the first of them by hash) and sketch."""
    limit = np.uint64(int(sim.share * (1 << 64)) - 1 if sim.share < 1 else (1 << 64) - 1)

    def run(batches):
        for batch in in_slices(batches):
            sets = _sets(batch.column(1).to_pylist(), sim.words)
            sampled = [int(np.searchsorted(s, limit, side="right")) for s in sets]
            low = [s[: max(k, sim.prefix(len(s)))] if len(s) else s for s, k in zip(sets, sampled, strict=True)]
            sketches = []
            for s in sets:
                bits = np.bincount((mix(s) >> np.uint64(54)).astype(np.int64), minlength=64 * SKETCH) & 1
                sketches.append(np.packbits(bits.astype(bool)).view(np.uint64))
            ids = np.array([_class_id(s) for s in sets], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(ids),
                    pa.array([len(s) for s in sets], type=pa.int64()),
                    pa.array(sampled, type=pa.int64()),
                    _long_lists(low),
                    _long_lists(sketches),
                ],
                names=["doc_id", "row", "cid", "n", "s", "low", "sketch"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, row long, cid long, n long, s long, low array<long>, sketch array<long>")


def _classes(signed: DataFrame) -> DataFrame:
    """cid, doc_id (the least), row (of one member), n, s, low and sketch of the
    sets with shingles; members of a class share all but id and row."""
    found = signed.where("n > 0").groupBy("cid").agg(
        F.min("doc_id").alias("doc_id"), F.min_by(F.struct("row", "n", "s", "low", "sketch"), "row").alias("one")
    )
    return found.select("cid", "doc_id", "one.*")


def _full_sets(docs: DataFrame, classes: DataFrame, cids: DataFrame, sim: Similarity) -> DataFrame:
    """(cid, shingles) of the classes in ``cids``, from the text of one member each."""
    wanted = classes.join(cids, "cid", "left_semi").select("cid", "row")
    texts = docs.join(wanted, "row").select("row", "cid", "text").distinct()  # repeated rows; all lie where the join left them

    def run(batches):
        for batch in in_slices(batches):
            sets = _sets(batch.column(1).to_pylist(), sim.words)
            own = np.array([_class_id(s) for s in sets], dtype=np.uint64).view(np.int64)
            right = own == batch.column(0).to_numpy()  # two rows may have one hash
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[right]), _long_lists([s for s, r in zip(sets, right, strict=True) if r])],
                names=["cid", "shingles"],
            )

    return texts.select("cid", "text").mapInArrow(run, "cid long, shingles array<long>")


def _sizes_allow(sim: Similarity, a: str, b: str) -> Column:
    return (F.col(a) * 100 >= F.col(b) * sim.percent) & (F.col(b) * 100 >= F.col(a) * sim.percent)


def _distance(a: str, b: str) -> Column:
    """Places in which two sketches differ; at most the size of the sets' difference."""
    return sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(SKETCH)), F.lit(0))


def _difference_allows(sim: Similarity, difference: Column) -> Column:
    """|x| + |y| - 2 |x & y| is at most (1 - t) / (1 + t) (|x| + |y|) for a link."""
    return difference * (100 + sim.percent) <= (F.col("na") + F.col("nb")) * (100 - sim.percent)


def _verified(close: DataFrame, docs: DataFrame, classes: DataFrame, sim: Similarity) -> DataFrame:
    """Those of the pairs (a, b) of classes, with their sizes and what else they
    carry, that link, written; ``close`` is read more than once.  The full sets
    are the largest table of all and go at once."""
    sets = cut_lineage(
        _full_sets(docs, classes, close.select(F.col("a").alias("cid")).union(close.select("b")).distinct(), sim),
        BATCH_ROWS,
    )
    common = F.size(F.array_intersect("xa", "xb"))
    links = cut_lineage(
        close.join(sets.toDF("a", "xa"), "a")
        .join(sets.toDF("b", "xb"), "b")
        .select(*close.columns, common.alias("common"))
        .where("100 * common >= {p} * (na + nb - common)".format(p=sim.percent))
        .drop("na", "nb", "common")
    )
    drop_cut(sets)
    return links


def _prefixes(classes: DataFrame, sim: Similarity) -> DataFrame:
    """cid, n, sketch, tokens (those of the prefix that another class has among
    its candidates for a prefix), gid, the group's head, and away: how far the
    sketch is from the head's."""
    each = classes.select("cid", F.posexplode("low").alias("pos", "h"))
    counts = each.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    shared = (
        each.join(counts, "h").groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("df", "h", "pos"))).alias("found"))
    )
    out = classes.select("cid", "n", "s", "sketch").join(shared, "cid", "left")
    found = F.coalesce("found", F.array().cast("array<struct<df:long,h:long,pos:int>>"))
    out = out.withColumn("p", F.expr(f"n - (({sim.percent} * n + 99) div 100) + 1"))
    out = out.withColumn("counted", F.filter(found, lambda x: x["pos"] < F.col("s")))
    out = out.withColumn("rest", F.filter(found, lambda x: (x["pos"] >= F.col("s")) & (x["pos"] < F.col("p"))))
    # shingles of one class alone come first; they take their places in the prefix
    room = F.greatest(F.lit(0).cast("long"), F.col("p") - F.col("s") + F.size("counted")).cast("int")
    out = out.withColumn("tokens", F.concat(F.slice("counted", F.lit(1), room), "rest"))
    out = out.withColumn("tokens", F.transform("tokens", lambda x: x["h"]))
    whole = F.size("tokens") == F.col("p")  # else no other class has this prefix
    key = F.when(whole, F.xxhash64("n", "tokens")).otherwise(F.col("cid"))
    keyed = cut_lineage(out.select("cid", "n", "sketch", "tokens", whole.alias("whole"), key.alias("key")))
    heads = keyed.groupBy("n", "whole", "key").agg(F.min_by(F.struct("cid", "sketch"), "cid").alias("head"))
    out = keyed.join(heads, ["n", "whole", "key"])
    out = cut_lineage(
        out.select("cid", "n", "sketch", "tokens", F.col("head.cid").alias("gid"), _distance("sketch", "head.sketch").alias("away"))
    )
    drop_cut(keyed)
    return out


def _group_heads(members: DataFrame) -> DataFrame:
    """gid, n, sketch and radius: how far the sketch of any member is from the head's."""
    head = F.max(F.when(F.col("cid") == F.col("gid"), F.struct("n", "sketch"))).alias("head")
    return members.groupBy("gid").agg(F.max("away").alias("radius"), head).select("gid", "head.*", "radius")


def _moves(links: DataFrame) -> DataFrame:
    """(component, least): the components that links (ca, cb) merge into another one."""
    found = components(links.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    return found.select(F.col("node").alias("component"), F.col("component").alias("least")).where("component <> least")


def _moved(labels: DataFrame, moves: DataFrame) -> DataFrame:
    """``labels`` (gid, component) after the moves."""
    out = labels.join(moves, "component", "left")
    return out.select("gid", F.coalesce("least", "component").alias("component"))


def _nearest(tokens: DataFrame, groups: DataFrame, labels: DataFrame, sim: Similarity, turn: int) -> DataFrame:
    """For each group the nearest of some groups (picked by hash, in a band of
    sizes) that share a prefix shingle with it, are in another component and are
    not ruled out."""
    known = tokens.join(labels, "gid").join(groups.select("gid", "n", "sketch"), "gid")
    picked = known.withColumn("salt", F.pmod(F.hash("gid"), F.lit(SALTS)))
    for part in (("h", "band", "salt"), ("h", "band")):  # a hot shingle's groups are ranked in parts first
        place = F.row_number().over(Window.partitionBy(*part).orderBy(F.xxhash64("gid", F.lit(turn)), "gid"))
        picked = picked.withColumn("place", place).where(F.col("place") <= PIVOTS)
    left = known.toDF("a", "band", "h", "ca", "na", "sa")
    right = picked.drop("place", "salt").toDF("b", "band", "h", "cb", "nb", "sb")
    near = (
        (left["h"] == right["h"])
        & (left["band"] == right["band"])
        & (F.col("ca") != F.col("cb"))
        & _sizes_allow(sim, "na", "nb")
        & _difference_allows(sim, _distance("sa", "sb"))
    )
    return (
        left.join(right, near)
        .groupBy("a", "na", "ca")
        .agg(F.min_by(F.struct("b", "nb", "cb"), F.struct(_distance("sa", "sb"), F.col("b"))).alias("p"))
        .select("a", "p.b", "na", "p.nb", "ca", "p.cb")
    )


def _apart(tokens: DataFrame, groups: DataFrame, labels: DataFrame, sim: Similarity) -> DataFrame:
    """Pairs (ga, gb) of groups in different components (ca, cb) that share a prefix
    shingle and that neither sizes nor sketches rule out for all their members."""
    sizes = labels.groupBy("component").agg(F.count("*").alias("size"))
    known = tokens.select("gid", "h").join(labels.join(sizes, "component"), "gid")
    mixed = known.groupBy("h").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.max_by("component", F.struct("size", "component")).alias("main")
    )
    known = known.join(mixed.where("lo <> hi").select("h", "main"), "h").join(groups, "gid")
    known = cut_lineage(known.select("h", "gid", "component", "n", "sketch", "radius", (F.col("component") != F.col("main")).alias("other")))
    left = known.where("other").select("h", *[F.col(c).alias(x) for c, x in zip(_SIDE, ("ga", "ca", "na", "sa", "ra"), strict=True)])
    right = known.select("h", "other", *[F.col(c).alias(x) for c, x in zip(_SIDE, ("gb", "cb", "nb", "sb", "rb"), strict=True)])
    near = _difference_allows(sim, _distance("sa", "sb") - F.col("ra") - F.col("rb"))
    return (
        left.join(
            right,
            (left["h"] == right["h"])
            & (F.col("ca") != F.col("cb"))
            & (~F.col("other") | (F.col("ga") < F.col("gb")))
            & _sizes_allow(sim, "na", "nb")
            & near,
        )
        .select("ga", "gb", "ca", "cb")
        .distinct()
    )


_SIDE = ("gid", "component", "n", "sketch", "radius")


def similar_components(
    docs: DataFrame, sim: Similarity = Similarity(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """A row per document: doc_id, n_shingles (size of its set) and component_id,
    the least doc_id that links reach from it, its own included.

    A-Z are lower-cased, words are what white space (space and 9 to 13) parts,
    and a text with fewer words than a shingle is one shingle.  Null, empty and
    blank texts have no shingles and link with nothing.  Rows with the same
    doc_id are each returned; if their texts differ they may belong to different
    components.  A row without doc_id gets the component of its links, or null.
    An empty table gives no rows; further columns are ignored."""
    ship(docs.sparkSession)
    docs = id_and_text(docs, id_col, text_col)
    docs = docs.withColumn("row", F.xxhash64("doc_id", "text"))
    signed = cut_lineage(_signatures(docs, sim), BATCH_ROWS)
    whole = cut_lineage(_classes(signed))
    rows = cut_lineage(signed.select("doc_id", "cid", "n"))
    drop_cut(signed)  # the sampled shingles of all rows; those of the classes go on alone
    prefixes = _prefixes(whole, sim)
    classes = cut_lineage(whole.select("cid", "doc_id", "row"))
    drop_cut(whole)

    # members with the heads of their groups, of equal size; those that do not link stand alone
    to_head = prefixes.select(F.col("cid").alias("a"), F.col("gid").alias("b"), F.col("n").alias("na"), F.col("n").alias("nb"), "away")
    to_head = to_head.where((F.col("a") != F.col("b")) & _difference_allows(sim, F.col("away"))).drop("away")
    links = _verified(to_head, docs, classes, sim)
    members = prefixes.join(links.select(F.col("a").alias("cid"), F.lit(True).alias("linked")), "cid", "left")
    members = members.withColumn("away", F.when(F.col("linked"), F.col("away")).otherwise(0))
    members = members.withColumn("gid", F.when(F.col("linked"), F.col("gid")).otherwise(F.col("cid"))).drop("linked")
    members = cut_lineage(members)
    drop_cut(prefixes)
    groups = cut_lineage(_group_heads(members))
    tokens = members.where("cid = gid").select(
        "gid", F.floor(F.log("n") / float(np.log(100 / sim.percent))).alias("band"), F.explode("tokens").alias("h")
    )
    several = tokens.groupBy("h").agg(F.count("*").alias("m")).where("m > 1").select("h")
    tokens = cut_lineage(tokens.join(several, "h").select("gid", "band", "h"))

    # groups with a few others of each prefix shingle, the nearest first
    labels = groups.select("gid", F.col("gid").alias("component"))
    total = groups.count()
    for turn in range(MAX_ROUNDS):
        close = cut_lineage(_nearest(tokens, groups, labels, sim, turn))
        moves = _moves(_verified(close, docs, classes, sim))
        labels = cut_lineage(_moved(labels, moves))
        if moves.count() < WORTH * total:
            break

    # what is left: pairs of groups that links do not connect yet
    pairs = _apart(tokens, groups, labels, sim)
    side = members.select("gid", "cid", "n", "sketch")
    expanded = (
        pairs.join(side.toDF("ga", "a", "na", "sa"), "ga")
        .join(side.toDF("gb", "b", "nb", "sb"), "gb")
        .where(_difference_allows(sim, _distance("sa", "sb")))
        .select("a", "b", "na", "nb", "ca", "cb")
    )
    labels = _moved(labels, _moves(_verified(cut_lineage(expanded), docs, classes, sim)))
    final = cut_lineage(classes.select("cid", "doc_id").join(members.select("cid", "gid"), "cid").join(labels, "gid").select("cid", "doc_id", "component"))
    least = final.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = final.join(least, "component").select("cid", "component_id")
    return (
        rows.join(named, "cid", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    )
