"""Main text of web pages by a tree-structured graphical model.

A page's block elements and their runs of text are the nodes of a tree; each is
content or not.  A node's own potential comes from its tag, the words of its
class, id and role, and the size, links and punctuation of its text; potentials
between parent and child say how readily content begins and ends.  Messages
passed up to the root and down again give the exact marginal of every node; runs
of text that are likelier content than not are the main text.

Weights are fitted to the likelihood of labelled pages: a set written by rule
here, of many layouts, and a bounded sample of pages that mark their article.
Pages are read where they are, one at a time.
"""

import html
import math
import random
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import ship
from .common import in_slices

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?>[^>\"']+|\"[^\"]*\"|'[^']*')*+|[^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW = {"script", "style", "textarea", "iframe", "svg", "template", "title", "select"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big br button cite code data del dfn em font i img input ins kbd label mark meter nobr "
    "q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements that the start of one of these ends.
_CLOSES = {
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}, "body": {"head"},
}
_TOPS = {"#root", "html", "body"}
_SECTIONS = set("article main nav aside header footer form dialog menu".split())
_SCOPE = set("table ul ol dl div section article aside nav header footer main form body html blockquote".split())


#: Names of classes and ids of containers, as the web uses them.
CONTENT_NAMES = "content main article post entry story text body page single blog news prose markdown detail".split()
OTHER_NAMES = {
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs topnav toc pagination pager tabs".split(),
    "header": "header masthead topbar branding logo site banner".split(),
    "footer": "footer colophon copyright legal bottom".split(),
    "aside": "sidebar aside widget related recommended popular trending tags".split(),
    "div": (
        "ad ads advert advertisement adsense sponsor sponsored promo promoted cookie cookies consent gdpr notice alert popup modal "
        "overlay newsletter subscribe signup share sharing social follow toolbar skip hidden disclaimer paywall"
    ).split(),
    "form": "form search login contact feedback".split(),
    "section": "comments comment replies reply respond disqus discussion reviews thread".split(),
}
#: Those of them that parts of an article bear as well: they tell nothing alone.
WEAK_NAMES = "discussion reviews thread notice alert legal disclaimer contact feedback tags site related".split()
_CONTENT, _WEAK = set(CONTENT_NAMES), set(WEAK_NAMES)
_OTHER = set().union(*OTHER_NAMES.values()) - _WEAK


class Node:
    __slots__ = ("tag", "parent", "features", "text", "links", "label")

    def __init__(self, tag, parent, features=()):
        self.tag, self.parent, self.features = tag, parent, list(features)
        self.text, self.links, self.label = None, 0, None


def _names(rest: str) -> list[str]:
    found = []
    for name, value in _ATTRIBUTE.findall(rest):
        name = name.lower()
        if name in ("class", "id", "role"):
            found += [f"name={w.lower()}" for w in _WORDS.findall(value)]
        elif name == "hidden" or (name == "aria-hidden" and "true" in value.lower()):
            found.append("hidden")
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            found.append("hidden")
    return found


def _with_lists(names: list[str]) -> list[str]:
    """The features with those that names of one list share."""
    words = {n[5:] for n in names if n.startswith("name=")}
    lists = (("other", _OTHER), ("weak", _WEAK), ("content", _CONTENT))
    return [*names, *[f"list={name}" for name, listed in lists if words & listed]]


def parse(page: str) -> list[Node]:
    """Block elements and runs of text in page order, parents first.  Whatever
    is not closed ends with what contains it; ends of nothing are ignored."""
    nodes = [Node("#root", -1, ["tag=#root"])]
    stack, run, links, depth = [0], [], 0, 0  # depth: of links that are open

    def flush():
        nonlocal run, links
        text = " ".join(html.unescape("".join(run)).split()) if run else ""
        if text:
            leaf = Node("#text", stack[-1])
            leaf.text, leaf.links = text, min(1.0, links / max(1, len(text)))
            nodes.append(leaf)
        run, links = [], 0

    def add(piece):
        nonlocal links
        if piece:
            run.append(piece)
            if depth:
                links += len(piece)

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["close"]:
            if tag == "a":
                depth = 0
            if tag in _INLINE:
                continue
            for k in range(len(stack) - 1, 0, -1):
                if nodes[stack[k]].tag == tag:
                    flush()
                    del stack[k:]
                    depth = 0
                    break
            continue
        if tag in _RAW:
            if tag == "svg" and m["rest"].endswith("/"):  # closed by itself
                end = m
            else:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if end:
                at = end.end()
            else:  # never closed: it ends with the block around it
                around = "|".join({re.escape(nodes[k].tag) for k in stack[1:]})
                end = re.compile(rf"</(?:{around})\s*>", re.I).search(page, at) if around else None
                at = end.start() if end else size
            add(" ")
            continue
        if tag in _INLINE or tag in _VOID:
            if tag == "a":
                depth = 1
            elif tag in ("br", "img", "input", "hr"):
                add(" ")
            continue
        flush()
        depth = 0
        closes = _CLOSES.get(tag, {"p"})
        while len(stack) > 1 and nodes[stack[-1]].tag in closes:
            stack.pop()
        if tag in _CLOSES:  # an open element of this kind within the nearest list, table or section
            for k in range(len(stack) - 1, 0, -1):
                if nodes[stack[k]].tag in closes:
                    del stack[k:]
                    break
                if nodes[stack[k]].tag in _SCOPE:
                    break
        nodes.append(Node(tag, stack[-1], [f"tag={tag}", *_with_lists(_names(m["rest"]))]))
        if not m["rest"].endswith("/") or tag in _SCOPE or tag in ("p", "object", "noscript"):
            stack.append(len(nodes) - 1)
    flush()
    # a page without sections or names is told as such at its top
    bare = not any(n.tag in _SECTIONS or any(f.startswith("list=") for f in n.features) for n in nodes)
    for n in nodes:
        if n.text is not None:
            n.features = _text_features(n, nodes[n.parent].tag)
        elif bare and n.tag in _TOPS:
            n.features.append("page=bare")
    return nodes


def _text_features(n: Node, above: str) -> list[str]:
    words = n.text.count(" ") + 1
    return [
        f"words={min(6, int(math.log2(words + 1)))}",
        f"links={int(n.links * 3.99)}",
        f"ends={'stop' if n.text[-1] in '.!?…:;' else 'open'}",
        f"in={above}",
        *(["sign=copyright"] if "©" in n.text else []),
    ]


@dataclass(frozen=True)
class TreeModel:
    """``own``: log odds of content by feature; ``between``: log potentials of
    (parent, child) states, for elements and for runs of text."""

    own: dict
    between: tuple

    def marginals(self, nodes: list[Node]) -> list[float]:
        return [_sigmoid(b) for b in _beliefs(nodes, self.own, self.between)[0]]

    def text(self, page: str) -> str:
        nodes = parse(page)
        kept = [n.text for n, p in zip(nodes, self.marginals(nodes), strict=True) if n.text is not None and p > 0.5]
        return "\n\n".join(kept)


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x > -500 else 0.0


def _log_sum(a: float, b: float) -> float:
    return (a if a > b else b) + math.log1p(math.exp(-abs(a - b)))


def _beliefs(nodes, own, between):
    """Log odds of every node by sum-product: up from the leaves, then down.
    Also each node's log odds from itself and below, and its parent's without it."""
    n = len(nodes)
    below = [sum(own.get(f, 0.0) for f in x.features) for x in nodes]
    up = [0.0] * n
    for i in range(n - 1, 0, -1):
        (e00, e01), (e10, e11) = between[nodes[i].text is not None]
        up[i] = _log_sum(e10, below[i] + e11) - _log_sum(e00, below[i] + e01)
        below[nodes[i].parent] += up[i]
    belief, above = [below[0]] + [0.0] * (n - 1), [0.0] * n
    for i in range(1, n):
        (e00, e01), (e10, e11) = between[nodes[i].text is not None]
        above[i] = belief[nodes[i].parent] - up[i]
        belief[i] = below[i] + _log_sum(e01, above[i] + e11) - _log_sum(e00, above[i] + e10)
    return belief, below, above


def fit(pages: list[list[Node]], epochs: int = 25, rate: float = 0.3, decay: float = 1e-4, seed: int = 5) -> TreeModel:
    """Gradient steps on the likelihood of the labels, with a rate of its own
    for each weight that falls with its past gradients."""
    own: dict[str, float] = {}
    squares: dict = {}
    between = [[[0.0, 0.0], [0.0, 0.0]], [[0.0, 0.0], [0.0, 0.0]]]

    def step(key, value, gradient):
        gradient -= decay * value
        squares[key] = squares.get(key, 1e-6) + gradient * gradient
        return value + rate * gradient / math.sqrt(squares[key])

    rng = random.Random(seed)
    for _ in range(epochs):
        for nodes in rng.sample(pages, len(pages)):
            belief, below, above = _beliefs(nodes, own, between)
            gradients: dict[str, float] = {}
            edges: dict[tuple, float] = {}
            for i, x in enumerate(nodes):
                d = x.label - _sigmoid(belief[i])
                for f in x.features:
                    gradients[f] = gradients.get(f, 0.0) + d
                if i:
                    leaf = x.text is not None
                    e = between[leaf]
                    joint = [[e[0][0], e[0][1] + below[i]], [above[i] + e[1][0], above[i] + e[1][1] + below[i]]]
                    total = _log_sum(_log_sum(*joint[0]), _log_sum(*joint[1]))
                    for a in (0, 1):
                        for b in (0, 1):
                            seen = nodes[x.parent].label == a and x.label == b
                            edges[leaf, a, b] = edges.get((leaf, a, b), 0.0) + seen - math.exp(joint[a][b] - total)
            for f, g in gradients.items():
                own[f] = step(f, own.get(f, 0.0), g)
            for (leaf, a, b), g in edges.items():
                between[leaf][a][b] = step((leaf, a, b), between[leaf][a][b], g)
    return TreeModel(own, tuple(tuple(map(tuple, e)) for e in between))


# ---- labelled pages

_INSIDE = {"nav", "aside", "footer", "form", "dialog", "menu"}  # of an article, but no part of its text


def mark(nodes: list[Node]) -> list[Node] | None:
    """Label a page by its own ``article`` or ``main`` elements: what they hold
    is content, but for other sections in them.  None if it has none.  Names that
    parts of an article bear as well make another section only of what is mostly links."""
    found = False
    texts, linked = [0] * len(nodes), [0.0] * len(nodes)  # of what each node holds
    for i in range(len(nodes) - 1, -1, -1):
        if nodes[i].text is not None:
            texts[i], linked[i] = len(nodes[i].text), nodes[i].links * len(nodes[i].text)
        if nodes[i].parent >= 0:
            texts[nodes[i].parent] += texts[i]
            linked[nodes[i].parent] += linked[i]
    for i, n in enumerate(nodes):
        inside = n.parent >= 0 and nodes[n.parent].label == 1
        begins = n.tag in ("article", "main")
        found |= begins
        names = {f[5:] for f in n.features if f.startswith("name=")}
        other = n.tag in _INSIDE or bool(names & _OTHER) or (bool(names & _WEAK) and 2 * linked[i] > texts[i])
        n.label = int((inside or begins) and not other)
    return nodes if found else None


def written_pages(count: int = 400, seed: int = 3) -> list[list[Node]]:
    """Labelled pages of many layouts, made by rule."""
    rng = random.Random(seed)

    def words(lo, hi):
        made = ["".join(rng.choice("aeiounrtsldm") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(lo, hi))]
        return " ".join(made)

    def sentence(lo, hi):
        return words(lo, hi).capitalize() + rng.choice(["."] * 8 + ["!", "?", ""])

    def paragraph():
        inner = " ".join(sentence(2, 25) for _ in range(rng.choice([1, 1, 2, 3, 5])))
        if rng.random() < 0.2:
            inner += f' <a href="/{words(1, 1)}">{words(1, 4)}</a> {sentence(2, 8)}'
        if rng.random() < 0.2:
            inner = f"<b>{inner}<br>"
        return f"<p>{inner}" + ("</p>" if rng.random() < 0.8 else "")

    def name(options):
        n = rng.choice(options)
        n = rng.choice([n, n, f"{n}-{words(1, 1)}", f"{words(1, 1)}_{n}", n.capitalize()])
        return rng.choice([f' class="{n}"', f' id="{n}"', f' class="{words(1, 1)} {n}"'])

    def references():
        links = [f'<li><a href="/{words(1, 1)}">{words(1, 6)}</a>{rng.choice(["", ", " + words(1, 6)])}</li>' for _ in range(rng.randint(1, 6))]
        tag = rng.choice(["ul", "ol"])
        line = f'<p><a href="/{words(1, 1)}">{words(2, 9)}</a></p>'
        return rng.choice([f"<{tag}>{''.join(links)}</{tag}>", line, f"<h3>{words(1, 2)}</h3><{tag}>{''.join(links)}</{tag}>"])

    def aside_by_name():  # a part of the article, whatever its name
        tag = rng.choice(["div", "section"])
        heading = rng.choice(["", f"<h2>{words(1, 3)}</h2>"])
        return f"<{tag}{name(WEAK_NAMES)}>{heading}{''.join(paragraph() for _ in range(rng.randint(1, 3)))}</{tag}>"

    def other(kind, outside=True):
        tag = rng.choice([kind, kind, "div", "div", "section"])
        named = tag != kind or kind in ("div", "section") or rng.random() < 0.5
        label = name([n for n in OTHER_NAMES[kind] if outside or n not in _WEAK]) if named else ""
        if kind == "nav" or rng.random() < 0.25:
            inner = "".join(f'<li><a href="/{words(1, 1)}">{words(1, 3)}</a></li>' for _ in range(rng.randint(2, 9)))
            inner = f"<ul>{inner}</ul>"
        elif kind == "form":
            inner = f'<label>{words(1, 3)}</label><input name="q"><button>{words(1, 2)}</button>'
        elif kind == "footer":
            inner = f"&copy; {words(1, 4)} &middot; {sentence(2, 12)}"
        else:
            inner = "".join(rng.choice([paragraph, lambda: sentence(2, 15), lambda: f"<h3>{words(1, 4)}</h3>"])() for _ in range(rng.randint(1, 4)))
        return f"<{tag}{label}>{inner}</{tag}>"

    def bare():  # a page that is nothing but its text
        shape = rng.random()
        text = " ".join(sentence(1, 12) for _ in range(rng.choice([1, 1, 2, 4])))
        if shape < 0.4:
            return f"\2{text}\3"
        inner = f"<p>{text}</p>" if shape < 0.6 else "".join(paragraph() for _ in range(rng.randint(1, 4)))
        return f"\2{inner}\3" if shape < 0.8 else f"\2<html><body>{inner}</body></html>\3"

    def content():
        parts = [f"<h1>{words(2, 8)}</h1>"] if rng.random() < 0.7 else []
        for _ in range(rng.randint(1, 9)):
            kind = rng.random()
            if kind < 0.52:
                parts.append(paragraph())
            elif kind < 0.57:
                parts.append(references())
            elif kind < 0.62:
                parts.append(aside_by_name())
            elif kind < 0.67:
                parts.append(f"<h2>{words(1, 6)}</h2>")
            elif kind < 0.71:
                parts.append("<ul>" + "".join(f"<li>{sentence(2, 12)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
            elif kind < 0.74:
                parts.append(f"<blockquote>{paragraph()}</blockquote>")
            elif kind < 0.76:
                parts.append(f"<pre>{words(3, 20)}</pre>")
            elif kind < 0.78:
                cells = "".join(f"<td>{words(1, 4)}</td>" for _ in range(3))
                parts.append(f"<table><tr>{cells}</tr></table>")
            else:  # something else within the article
                parts.append("\0" + other(rng.choice(["div", "aside", "div", "nav", "form", "section"]), outside=False) + "\1")
        inner = "".join(parts)
        shape = rng.random()
        if shape < 0.06:  # in no element of its own
            return f"\2{inner}\3"
        if shape < 0.4:
            tag, label = rng.choice(["article", "main"]), rng.choice(["", name(CONTENT_NAMES)])
        elif shape < 0.8:
            tag, label = rng.choice(["div", "div", "section", "td"]), name(CONTENT_NAMES)
        else:
            tag, label = rng.choice(["div", "section"]), ""
        made = f"\2<{tag}{label}>{inner}</{tag}>\3"
        return f"<table><tr>{made}</tr></table>" if tag == "td" else made

    pages = []
    for _ in range(count):
        if rng.random() < 0.1:
            pages.append(_labelled(bare()))
            continue
        before = [other(rng.choice(["header", "nav", "div", "aside", "div", "form"])) for _ in range(rng.randint(0, 4))]
        after = [other(rng.choice(["section", "footer", "aside", "div", "nav", "footer"])) for _ in range(rng.randint(0, 4))]
        body = "".join([*before, content(), *after])
        if rng.random() < 0.4:
            body = f'<div class="{rng.choice(["wrapper", "container", "layout", "row", "outer"])}">{body}</div>'
        pages.append(_labelled(f"<html><head><title>{words(2, 6)}</title></head><body>{body}</body></html>"))
    return pages


def _labelled(page: str) -> list[Node]:
    """The nodes of a written page; control characters 2 and 3 enclose content,
    0 and 1 what is not content within it."""
    plain, spans, start, holes = [], [], 0, []
    size = 0
    for piece in re.split("([\0\1\2\3])", page):
        if piece == "\2":
            start = size
        elif piece == "\3":
            spans = (start, size)
        elif piece == "\0":
            holes.append([size, size])
        elif piece == "\1":
            holes[-1][1] = size
        else:
            plain.append(piece)
            size += len(piece)
    text = "".join(plain)
    nodes = parse(text)
    for n, at in zip(nodes, _places(text, nodes), strict=True):
        whole = n.tag == "#root" and spans[0] == 0  # of a page that is its text
        n.label = int((whole or spans[0] <= at < spans[1]) and not any(a <= at < b for a, b in holes))
    return nodes


def _places(page: str, nodes: list[Node]) -> list[int]:
    """Where in the page each node begins; found in page order."""
    at, out = 0, []
    for n in nodes:
        if n.tag == "#root":
            out.append(0)
            continue
        if n.text is None:
            at = re.compile(rf"<{re.escape(n.tag)}\b", re.I).search(page, at).start()
            out.append(at)
            at += 1
        else:
            first = re.escape(html.escape(n.text.split(" ")[0], quote=False)).replace("©", "&copy;")
            m = re.compile(rf"(?<![</\w=\"]){first}(?!\w)").search(page, at)
            at = m.start() if m else at
            out.append(at)
    return out


SAMPLE_CHARS = 200_000  # longer pages are not fitted on


def train(pages: DataFrame | None = None, html_col: str = "html", id_col: str = "page_id", sample: int = 120) -> TreeModel:
    """Fit on the pages written by rule and on those that mark their article
    among ``sample`` pages of the table (in the mean), picked by hash of the id;
    pages of more than ``SAMPLE_CHARS`` are left out of the sample."""
    labelled = written_pages()
    if pages is not None and sample:
        span = 1 << 30
        rate = int(span * min(1.0, sample / max(1, pages.count())))
        place = F.xxhash64(F.lit("sample"), pages[id_col].cast("string"))
        chosen = pages.select(pages[html_col].cast("string").alias("html"), place.alias("place"))
        chosen = chosen.where((F.pmod("place", F.lit(span)) < rate) & (F.char_length("html") <= SAMPLE_CHARS)).where(F.lower("html").rlike("<(article|main)[ >]"))
        for r in sorted(chosen.collect(), key=lambda r: (r["place"], r["html"])):
            if nodes := mark(parse(r["html"])):
                labelled.append(nodes)
    return fit(labelled)


def extract(pages: DataFrame, model: TreeModel, html_col: str = "html", out_col: str = "main_text") -> DataFrame:
    """All rows and columns of ``pages`` with the main text of the whole page:
    character references decoded, white space inside a block one space, blocks
    in page order with an empty line between.

    Null and empty pages, and pages without content, give an empty text.  A
    column named ``out_col`` is replaced; repeated rows are read each."""
    pages = pages.drop(out_col)
    place, names = pages.columns.index(html_col), [*pages.columns, out_col]

    def run(batches):
        for batch in in_slices(batches):
            texts = [model.text(p) if p else "" for p in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, type=pa.string())], names=names)

    ship(pages.sparkSession)
    return pages.mapInArrow(run, T.StructType([*pages.schema.fields, T.StructField(out_col, T.StringType())]))
