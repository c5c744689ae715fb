"""URL filter: rules by host and path, and a tree of path templates per host.

Paths that a rule decides are labelled.  Per host, level by level, a segment
that holds a fair share of its parent's pages stays as it is; the others are
variable and become a wildcard that keeps only their kind.  Branches beside each
other whose pages divide alike over what follows, and whose labelled pages divide
alike over labels, are merged.  A template is rejected where its labelled share of
blocked pages, smoothed towards one half, is high: its unlabelled pages go too.

Built-in functions only.  Pages are counted by host and path before anything
else is done, so a host or an address with a third of all rows costs little more
than its distinct paths.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import cut_lineage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_RULES = 1000


@dataclass(frozen=True)
class Rule:
    """``host/path``; fits the host and its subdomains where the path begins so."""

    verdict: str  # allow or block
    prefix: str

    @property
    def host(self) -> str:
        return self.prefix.partition("/")[0]

    @property
    def path(self) -> str:
        return self.prefix[len(self.host) :]


@dataclass(frozen=True)
class TreeOptions:
    depth: int = 4  # segments of a path; what follows is one wildcard
    share: float = 0.02  # of its parent's pages that keep a segment literal
    least: int = 3  # pages that keep a segment literal
    prior: float = 10.0  # pages, half of them blocked, that smoothing adds to a template's labelled ones
    reject: float = 0.8  # smoothed share of blocked pages from which a template goes
    spread: float = 3.0  # standard deviations of chi-square within which branches are alike


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """(prefix, verdict) of the longest rule that fits, the longer host first
    among equally long ones; null if none does."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules: they are part of the plan")
    out = F.lit(None).cast("struct<prefix:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.prefix), len(r.host), r.prefix)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.prefix).alias("prefix"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def _kind(segment: Column) -> Column:
    """What is left of a variable segment: digits or not, and its extension."""
    extension = F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})$", 1)
    body = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
    return F.concat(F.when(body.rlike(r"^[0-9]+$"), F.lit("{n}")).otherwise(F.lit("{*}")), extension)


def _templates(paths: DataFrame, o: TreeOptions) -> DataFrame:
    """``paths`` with ``tpl``, the array of template segments."""
    out = paths.withColumn("segs", F.filter(F.split("path", "/", -1), lambda s: s != "")).withColumn(
        "tpl", F.array().cast("array<string>")
    )
    for k in range(1, o.depth + 1):
        at = out.withColumn("seg", F.get("segs", F.lit(k - 1)))
        counts = at.where("seg is not null").groupBy("host", "tpl", "seg").agg(F.sum("n").alias("c"))
        total = counts.groupBy("host", "tpl").agg(F.sum("c").alias("total"))
        literal = (
            counts.join(total, ["host", "tpl"])
            .where((F.col("c") >= o.least) & (F.col("c") >= o.share * F.col("total")))
            .select("host", "tpl", "seg", F.lit(True).alias("literal"))
        )
        step = F.when(F.col("literal"), F.col("seg")).otherwise(_kind(F.col("seg")))
        out = cut_lineage(
            at.join(literal, ["host", "tpl", "seg"], "left")
            .withColumn("tpl", F.when(F.col("seg").isNull(), F.col("tpl")).otherwise(F.concat("tpl", F.array(step))))
            .drop("seg", "literal")
        )
    tail = F.when(F.size("segs") > o.depth, F.array(F.lit("{**}"))).when(F.col("path").endswith("/"), F.array(F.lit("")))
    return out.withColumn("tpl", F.concat("tpl", F.coalesce(tail, F.array().cast("array<string>")))).drop("segs")


def _merge(paths: DataFrame, level: int, o: TreeOptions) -> DataFrame:
    """Merge the branches of one level into one of those beside them with the same
    most frequent rest, where they are like it: into the largest that has labelled
    pages, or the largest if none has.  What follows is compared over all pages, the
    labels over labelled pages alone, so a branch without labels can join one whose
    pages divide alike, and opposite labels keep branches apart."""
    here = F.get("tpl", F.lit(level))
    inner = here.isNotNull() & ~here.rlike(r"^\{") & (F.size("tpl") > level + 1)  # literal, with something below
    rows = paths.withColumn("up", F.slice("tpl", 1, level)).withColumn("seg", F.when(inner, here))
    cells = (
        rows.where("seg is not null")
        .groupBy("host", "up", "seg", F.expr(f"slice(tpl, {level + 2}, size(tpl))").alias("rest"))
        .agg(F.sum("n").alias("c"), F.sum("blocked").alias("b"), F.sum("allowed").alias("a"))
    )
    sizes = cells.groupBy("host", "up", "seg").agg(
        F.sum("c").alias("size"), F.sum("b").alias("b"), F.sum("a").alias("a"), F.max(F.struct("c", "rest"))["rest"].alias("most")
    )
    labelled = (F.col("b") + F.col("a") > 0).alias("labelled")
    top = F.max(F.struct(labelled, "size", "seg", "b", "a")).alias("t")
    largest = sizes.groupBy("host", "up", "most").agg(top).select(
        "host", "up", "most", *[F.col(f"t.{c}").alias(f"top_{c}") for c in ("size", "seg", "b", "a")]
    )
    others = sizes.join(largest, ["host", "up", "most"]).where("seg <> top_seg").drop("most")
    # a row per branch and rest of its own or of the one it is compared with
    key = ["host", "up", "seg", "top_seg", "rest"]
    zero = F.lit(0).cast("long")
    own = others.join(cells.drop("b", "a"), ["host", "up", "seg"]).select(*key, "c", zero.alias("top_c"))
    top_cells = cells.select("host", "up", F.col("seg").alias("top_seg"), "rest", F.col("c").alias("top_c"))
    theirs = others.join(top_cells, ["host", "up", "top_seg"]).select(*key, zero.alias("c"), "top_c")
    table = own.union(theirs).groupBy(*key).agg(F.sum("c").alias("c"), F.sum("top_c").alias("top_c"))
    table = table.join(others.select("host", "up", "seg", "size", "top_size"), ["host", "up", "seg"])
    rests = table.groupBy("host", "up", "seg").agg(
        F.sum(_chi("c", "top_c", "size", "top_size")).alias("chi"), (F.count("*") - 1).alias("df")
    )
    both = (F.col("b") + F.col("a") > 0) & (F.col("top_b") + F.col("top_a") > 0)
    known, top_known = F.col("b") + F.col("a"), F.col("top_b") + F.col("top_a")
    of_labels = F.when(both, _chi("b", "top_b", known, top_known) + _chi("a", "top_a", known, top_known)).otherwise(0.0)
    alike = (
        others.join(rests, ["host", "up", "seg"])
        .select("host", "up", "seg", "top_seg", (F.col("chi") + of_labels).alias("chi"), (F.col("df") + both.cast("long")).alias("df"))
        .where(F.col("chi") <= F.col("df") + o.spread * F.sqrt(2.0 * F.col("df")))
        .select("host", "up", "seg", "top_seg")
    )
    into = alike.union(alike.select("host", "up", F.col("top_seg").alias("seg"), "top_seg").distinct())
    merged = F.concat(
        F.slice("tpl", 1, level), F.array(F.concat(F.lit("{~"), "top_seg", F.lit("}"))), F.expr(f"slice(tpl, {level + 2}, size(tpl))")
    )
    out = rows.join(into, ["host", "up", "seg"], "left").withColumn("tpl", F.when(F.col("top_seg").isNotNull(), merged).otherwise(F.col("tpl")))
    return cut_lineage(out.drop("up", "seg", "top_seg"))


def _chi(c, top_c, size, top_size) -> Column:
    """What one cell adds to chi-square between a branch and the one it is compared with."""
    c, top_c, size, top_size = (F.col(x) if isinstance(x, str) else x for x in (c, top_c, size, top_size))
    expected = (c + top_c) * size / (size + top_size)
    other = c + top_c - expected
    return F.when(c + top_c > 0, (c - expected) ** 2 / expected + (top_c - other) ** 2 / other).otherwise(0.0)


def judge(
    pages: DataFrame,
    rules: tuple[Rule, ...],
    id_col: str = "page_id",
    url_col: str = "url",
    options: TreeOptions = TreeOptions(),
) -> DataFrame:
    """A row per page: page_id, host, path, rule (prefix or null), verdict (the
    rule's, else block where the page's template is rejected), template and
    purity (smoothed blocked share of the template).

    Null urls and urls without ``://`` have an empty host and path.  Repeated
    rows are judged each, null ids stay null, other columns are ignored."""
    host, path = host_and_path(pages[url_col].cast("string"))
    parts = pages.select(pages[id_col].alias("page_id"), host.alias("host"), path.alias("path"))
    by_rule = parts.withColumn("found", longest_rule(F.col("host"), F.col("path"), tuple(rules)))
    label = F.col("found.verdict")
    paths = cut_lineage(
        by_rule.groupBy("host", "path").agg(
            F.count("*").alias("n"),
            F.count_if(label == "block").alias("blocked"),
            F.count_if(label == "allow").alias("allowed"),
            F.count_if(label.isNull()).alias("unknown"),
        )
    )
    shaped = reduce(lambda df, level: _merge(df, level, options), range(options.depth - 1), _templates(paths, options))
    purity = (F.col("b") + options.prior / 2) / (F.col("b") + F.col("a") + options.prior)
    templates = shaped.groupBy("host", "tpl").agg(F.sum("blocked").alias("b"), F.sum("allowed").alias("a"))
    templates = templates.select("host", "tpl", purity.alias("purity"))
    known = shaped.select("host", "path", "tpl").join(templates, ["host", "tpl"])
    known = known.select("host", "path", F.concat(F.lit("/"), F.array_join("tpl", "/")).alias("template"), "purity")
    verdict = F.coalesce(label, F.when(F.col("purity") >= options.reject, F.lit("block")).otherwise(F.lit("allow")))
    return by_rule.join(known, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("found.prefix").alias("rule"), verdict.alias("verdict"), "template", "purity"
    )
