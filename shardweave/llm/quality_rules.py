"""Quality rules whose cutoffs limit how many good documents they reject.

Base rules count words, symbols, repeated lines and repeated windows of words.
Further rules reject where a signal lies above a cutoff, chosen per stratum from
labelled documents: one half proposes cutoffs (quantiles of good documents, and
the middle between all of these and half of the bad), the other half is the
holdout.  A cutoff may be used only if an exact binomial bound
on the holdout shows that it rejects at most a given share of good documents; the
level of the test is divided by the number of all tests (Bonferroni), and the
share by the number of signals, so with the stated confidence all rules together
keep to the limit in every stratum.  Where no cutoff passes, the signal is not used.

Built-in functions only.  The measures of a text come from array functions on
the text itself, so no window is shuffled; labels meet only the measures."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import cut_lineage
from .common import SPACE, crc_remainder

SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\x0b\f\r"
WINDOW = 8
SIGNALS = ("symbols", "upper", "dup_lines", "repeats", "long_words")


@dataclass(frozen=True)
class Risk:
    """At most ``limit`` of the good documents of each stratum are rejected, with
    a confidence of ``1 - error`` for all strata and signals together."""

    limit: float = 0.05
    error: float = 0.05
    quantiles: tuple[float, ...] = (0.98, 0.99, 0.995, 0.999, 1.0)
    cost: float = 20.0  # bad documents that must go for each good one


def _pairs_hash(hashes: str, apart: int) -> Column:
    """Hash of each element with the one ``apart`` places on."""
    n = F.size(hashes) - apart
    return F.when(
        n > 0, F.zip_with(F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(1 + apart), n), lambda a, b: F.xxhash64(a, b))
    ).otherwise(F.array().cast("array<bigint>"))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang") -> DataFrame:
    """doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines and n_upper of every whole text.

    Words are what white space (space and 9 to 13) parts, lines what ``\\n``
    parts.  Null texts are empty, a null stratum is the empty one."""
    stratum = F.coalesce(docs[stratum_col].cast("string"), F.lit("")) if stratum_col else F.lit("")
    out = docs.select(
        docs[id_col].alias("doc_id"), stratum.alias("stratum"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")
    )
    out = out.withColumn("words", F.filter(F.split("text", SPACE + "+", -1), lambda w: w != ""))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def without(chars):  # code points that are not among ``chars``
        return F.char_length(F.translate("text", chars, ""))

    length = F.char_length("text")
    out = out.select(
        "doc_id",
        "stratum",
        F.size("words").cast("long").alias("n_words"),
        without(_BLANKS).cast("long").alias("word_chars"),
        (length - without(SYMBOLS)).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        (length - without("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).cast("long").alias("n_upper"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h1"),
    )
    out = out.withColumn("h2", _pairs_hash("h1", 1))
    out = out.withColumn("h4", _pairs_hash("h2", 2))
    out = out.withColumn("h8", _pairs_hash("h4", 4))
    out = out.withColumn("dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    return out.select(
        "doc_id",
        "stratum",
        "n_words",
        "word_chars",
        "n_symbols",
        F.col("dup_lines").alias("n_dup_lines"),
        _covered("h8").cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        "n_upper",
    )


def _covered(hashes: str) -> Column:
    """Words that lie in a window whose hash occurs twice or more."""
    n = F.size(hashes)
    placed = F.array_sort(F.zip_with(F.col(hashes), F.sequence(F.lit(0), n - 1), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    nothing = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
    before = F.concat(nothing, F.slice(placed, F.lit(1), n - 1))
    after = F.concat(F.slice(placed, F.lit(2), n - 1), nothing)
    again = F.zip_with(
        F.zip_with(placed, before, lambda x, b: F.struct(x.alias("x"), (x["h"] == b["h"]).alias("same"))),
        after,
        lambda y, a: F.when(F.coalesce(y["same"], F.lit(False)) | F.coalesce(y["x"]["h"] == a["h"], F.lit(False)), y["x"]["i"]),
    )
    starts = F.array_sort(F.filter(again, lambda i: i.isNotNull()))
    cover = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(-1_000_000).alias("end")),
        lambda acc, i: F.struct(
            (acc["n"] + F.lit(WINDOW) - F.greatest(F.lit(0), acc["end"] - i)).alias("n"), (i + WINDOW).alias("end")
        ),
        lambda acc: acc["n"],
    )
    return F.when(F.size(F.array_distinct(hashes)) < n, cover).otherwise(0)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _signals() -> Column:
    """Shares that are high in bad texts, by name."""
    chars, words = F.greatest("word_chars", F.lit(1)), F.greatest("n_words", F.lit(1))
    shares = {
        "symbols": F.col("n_symbols") / chars,
        "upper": F.col("n_upper") / chars,
        "dup_lines": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeats": F.col("n_repeat_words") / words,
        "long_words": F.col("word_chars") / words,
    }
    return F.array(*[F.struct(F.lit(k).alias("signal"), shares[k].alias("value")) for k in SIGNALS])


def binomial_tail(n: Column, k: Column, share: float) -> Column:
    """P(X <= k) of X binomial with ``n`` draws and probability ``share``,
    summed in logarithms; 1 where k is above the mean, whose tail is of no use."""
    odds = F.log(F.lit(share / (1 - share)))
    first = n * F.log(F.lit(1 - share))

    def add(acc, j):
        term = acc["term"] + F.log((n - j + 1) / j) + odds
        total = F.greatest(acc["total"], term) + F.log1p(F.exp(-F.abs(acc["total"] - term)))
        return F.struct(term.alias("term"), total.alias("total"))

    start = F.struct(first.cast("double").alias("term"), first.cast("double").alias("total"))
    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k.cast("long"))).otherwise(F.array().cast("array<bigint>"))
    total = F.exp(F.aggregate(steps, start, add, lambda acc: acc["total"]))
    return F.when((n <= 0) | (k > share * n), 1.0).otherwise(F.least(F.lit(1.0), total))


def cutoffs(measured: DataFrame, labels: DataFrame, risk: Risk = Risk(), id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(stratum, signal, cutoff, n_holdout, n_rejected, p_value): the cutoffs to use.

    ``measured`` as from ``measures``; ``label_col`` 1 is good, 0 bad, and 1
    counts where an id has both.  Null ids and labels are left out."""
    marks = (
        labels.select(labels[id_col].alias("doc_id"), labels[label_col].cast("int").alias("good"))
        .where("doc_id is not null and good is not null")
        .groupBy("doc_id")
        .agg(F.max("good").alias("good"))
    )
    marked = (
        measured.where(~base_failed())
        .join(marks, "doc_id")
        .select("stratum", "good", (crc_remainder("doc_id", 2) == 0).alias("proposes"), F.explode(_signals()).alias("s"))
        .select("stratum", "good", "proposes", "s.*")
    )
    marked = cut_lineage(marked)
    good, bad = F.when(F.col("good") == 1, F.col("value")), F.when(F.col("good") == 0, F.col("value"))
    proposed = (
        marked.where("proposes")
        .groupBy("stratum", "signal")
        .agg(
            F.percentile_approx(good, list(risk.quantiles), 10_000).alias("cuts"),
            ((F.max(good) + F.percentile_approx(bad, 0.5, 10_000)) / 2).alias("middle"),
        )
        .select("stratum", "signal", F.array_distinct(F.array_compact(F.concat("cuts", F.array("middle")))).alias("cuts"))
    )
    above = marked.join(proposed, ["stratum", "signal"]).select(
        "stratum", "signal", "good", "proposes", F.explode("cuts").alias("cutoff"), "value"
    )
    over = F.col("value") > F.col("cutoff")
    counted = above.groupBy("stratum", "signal", "cutoff").agg(
        F.count_if(~F.col("proposes") & (F.col("good") == 1)).alias("n_holdout"),
        F.count_if(~F.col("proposes") & (F.col("good") == 1) & over).alias("n_rejected"),
        F.count_if(F.col("proposes") & (F.col("good") == 1) & over).alias("lost"),
        F.count_if(F.col("proposes") & (F.col("good") == 0) & over).alias("gained"),
    )
    counted = cut_lineage(counted)
    tests = counted.agg(F.greatest(F.count("*"), F.lit(1)).alias("tests"))
    p_value = binomial_tail(F.col("n_holdout"), F.col("n_rejected"), risk.limit / len(SIGNALS))
    passed = (
        counted.join(F.broadcast(tests))  # one row
        .withColumn("p_value", p_value)
        .where((F.col("p_value") <= risk.error / F.col("tests")) & (F.col("gained") > risk.cost * F.col("lost")))
    )
    # the most useful one, the most lenient of equals
    best = F.max_by(
        F.struct("cutoff", "n_holdout", "n_rejected", "p_value"), F.struct(F.col("gained") - risk.cost * F.col("lost"), F.col("cutoff"))
    )
    return passed.groupBy("stratum", "signal").agg(best.alias("b")).select("stratum", "signal", "b.*")


def apply_rules(measured: DataFrame, chosen: DataFrame) -> DataFrame:
    """``measured`` with base_failed and kept: false where a base rule fails or a
    signal lies above its stratum's cutoff."""
    limits = chosen.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("signal", "cutoff"))).alias("limits"))
    out = measured.join(limits, "stratum", "left").withColumn("base_failed", base_failed())
    over = F.exists(_signals(), lambda s: F.coalesce(s["value"] > F.try_element_at("limits", s["signal"]), F.lit(False)))
    return out.withColumn("kept", ~F.col("base_failed") & ~over).drop("limits")


def judge(docs: DataFrame, labels: DataFrame, risk: Risk = Risk(), stratum_col: str | None = "lang") -> DataFrame:
    """A row per document: the measures, base_failed and kept.  Repeated rows are
    judged each; a null id is judged but teaches nothing; an empty label table
    leaves the base rules alone."""
    measured = cut_lineage(measures(docs, stratum_col=stratum_col))
    return apply_rules(measured, cutoffs(measured, labels, risk))
