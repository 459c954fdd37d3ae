"""Main text of web pages: a tree-structured graphical model over the DOM.

The page is parsed into a tree of block elements. Every node is content or not; its own features (tag, words of
class and id, amount of text, links) give a unary potential, and each parent-child edge a potential by the kind of the
child. Sum-product messages pass up and then down the tree, which gives each node its exact marginal; the text
blocks of nodes with a marginal above one half are the page's text.

Weights are fitted by maximum likelihood (the gradient comes from the same messages) on the driver, on labelled pages:
at most ``FIT_PAGES`` pages of the table, labelled by their article or main element, and for each of them one
layout without such elements, filled with the page's own text, whose parts are labelled by construction.
All pages are then parsed and labelled in Arrow batches.

Defined results: a null or empty page has no text; broken markup is read as far as it goes; a table without
any labelled page falls back to weights from the layouts alone; repeated rows are all returned; further columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.llm.common import table

FIT_PAGES = 120
EPOCHS = 12

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*+"|'[^']*+'|[^'">]++)*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
# fixed values: element names of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr ruby rt rp nobr output picture img br".split())
SKIPPED = frozenset("script style title textarea select button noscript iframe template svg math canvas object audio video noembed noframes xmp datalist".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table"))}
_KINDS = {  # words of class, id and role, by what they tell
    "good": "article content post entry story body text main blog page prose maintext articlebody",
    "menu": "nav navigation navbar menu menubar breadcrumb breadcrumbs toolbar pagination pager pages tabs toc skip",
    "side": "sidebar aside widget widgets rail related recommended popular trending teaser more links",
    "foot": "footer foot copyright colophon legal imprint",
    "head": "header head masthead banner topbar logo branding",
    "talk": "comment comments commentlist respond reply replies discussion disqus thread feedback reader",
    "sell": "ad ads adv advert advertisement sponsor sponsored promo promotion promoted shop affiliate outbrain taboola",
    "note": "cookie cookies consent notice alert warning gdpr privacy popup modal overlay dialog message disclaimer subscribe newsletter paywall",
    "form": "form login signin signup search register contact subscribe share social sharing",
}
_WORDS = {w: k for k, words in _KINDS.items() for w in words.split()}
_SPLIT = re.compile(r"[^a-z]+")


class Page:
    """Block elements in document order with their features, and the text blocks with their nodes."""

    __slots__ = ("tags", "parents", "attrs", "labels", "chars", "links", "blocks")

    def __init__(self, source: str, labelled: bool = False):
        self.tags, self.parents, self.attrs, self.labels = ["#page"], [0], [""], [0]
        self.chars, self.links, self.blocks = [0], [0], []
        self._read(source, labelled)

    def _read(self, source: str, labelled: bool) -> None:
        stack, names, text, in_link, pos, n = [0], ["#page"], [], 0, 0, len(source)

        def flush() -> None:
            nonlocal text
            if text:
                words = " ".join(entities.unescape("".join(text)).split())
                text = []
                if words:
                    self.blocks.append((stack[-1], words))
                    self.chars[stack[-1]] += len(words)

        def close(depth: int) -> None:
            flush()
            del stack[depth:], names[depth:]

        while pos < n:
            m = _TAG.search(source, pos)
            if not m:
                text.append(source[pos:])
                break
            if m.start() > pos:
                piece = source[pos:m.start()]
                text.append(piece)
                if in_link:
                    self.links[stack[-1]] += len(piece)
            pos = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            name = name.lower()
            ending = m[1] or m[4]
            if name in SKIPPED:
                if not ending and not (m[3] or m[6] or "").endswith("/"):
                    end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(source, pos)
                    pos = end.end() if end else (n if name in ("script", "style") else pos)
                continue
            if name in INLINE:
                if name == "a":
                    in_link = 0 if ending else 1
                elif name in ("br", "wbr"):
                    text.append(" ")
                continue
            if name in VOID:
                flush()
                continue
            if ending:
                if name in names:
                    close(len(names) - 1 - names[::-1].index(name))
                in_link = 0
                continue
            flush()
            in_link = 0
            if name in ENDS_P and "p" in names:
                close(len(names) - 1 - names[::-1].index("p"))
            elif name in CLOSES:
                closed, within = CLOSES[name]
                for k in range(len(names) - 1, 0, -1):
                    if names[k] in closed.split():
                        close(k)
                        if name != "tr":
                            break
                    elif names[k] in within:
                        break
            node = len(self.tags)
            own, label = "", self.labels[stack[-1]]
            raw = m[3] or m[6]
            if raw and not raw.isspace():
                for key, a, b, c in _ATTR.findall(raw):
                    key = key.lower()
                    if key in ("class", "id", "role"):
                        own += f" {a or b or c}"
                    elif labelled and key == "data-y":
                        label = int(a or b or c)
                if "hidden" in raw or "display:none" in raw:
                    own += " #hidden"
            if labelled and name in ("article", "main") and "data-y" not in source:
                label = 1
            if labelled and label and name in ("nav", "aside", "footer", "form"):
                label = 0
            self.tags.append(name)
            self.parents.append(stack[-1])
            self.attrs.append(own)
            self.labels.append(label)
            self.chars.append(0)
            self.links.append(0)
            stack.append(node)
            names.append(name)
        flush()

    def features(self) -> list[list[str]]:
        below, linked = self.chars[:], self.links[:]
        for k in range(len(below) - 1, 0, -1):
            below[self.parents[k]] += below[k]
            linked[self.parents[k]] += linked[k]
        out = []
        for k, tag in enumerate(self.tags):
            n = self.chars[k]
            f = ["bias", f"tag={tag}", "own=" + ("0" if not n else "25" if n < 25 else "80" if n < 80 else "300" if n < 300 else "more")]
            share = linked[k] / below[k] if below[k] else 0
            f.append("links=" + ("none" if not share else "few" if share < 0.3 else "many"))
            if below[k] > 400:
                f.append("long")
            if self.attrs[k]:
                for kind in {_WORDS.get(w) for w in _SPLIT.split(self.attrs[k].lower())} - {None}:
                    f.append(f"word={kind}")
                if "#hidden" in self.attrs[k]:
                    f.append("hidden")
            out.append(f)
        return out


def edge_kind(tag: str) -> str:
    return "text" if tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "figcaption") else "list" if tag in ("ul", "ol", "li", "dl", "dt", "dd", "table", "tr", "td", "th", "tbody") else "box"


def marginals(page: Page, feats: list[list[str]], w: dict[str, float]) -> tuple[list[float], list[tuple[float, float, float, float]]]:
    """P(content) of each node, and of each edge the four joint marginals (parent, child) = 00, 01, 10, 11."""
    n, get, parents = len(feats), w.get, page.parents
    one = [math.exp(max(-30.0, min(30.0, sum([get(f, 0.0) for f in fs])))) for fs in feats]
    edges = {k: tuple(math.exp(get(f"edge={k}{y}", 0.0)) for y in ("00", "01", "10", "11")) for k in ("text", "list", "box")}
    kinds = [edges[edge_kind(t)] for t in page.tags]
    b0, b1 = [1.0] * n, one[:]  # product of the unary potential and the messages of the children
    m0, m1 = [1.0] * n, [1.0] * n
    for k in range(n - 1, 0, -1):
        e, x0, x1, p = kinds[k], b0[k], b1[k], parents[k]
        u0, u1 = e[0] * x0 + e[1] * x1, e[2] * x0 + e[3] * x1
        s = u0 + u1
        m0[k], m1[k] = u0 / s, u1 / s
        y0, y1 = b0[p] * m0[k], b1[p] * m1[k]
        s = y0 + y1
        b0[p], b1[p] = y0 / s, y1 / s
    out, joint = [0.0] * n, [(0.0, 0.0, 0.0, 0.0)] * n
    t0, t1 = b0[:], b1[:]  # full beliefs
    s = t0[0] + t1[0]
    out[0] = t1[0] / s
    for k in range(1, n):
        p, e = parents[k], kinds[k]
        c0, c1 = t0[p] / m0[k], t1[p] / m1[k]  # the parent's belief without this child
        j = (c0 * e[0] * b0[k], c0 * e[1] * b1[k], c1 * e[2] * b0[k], c1 * e[3] * b1[k])
        s = sum(j)
        joint[k] = (j[0] / s, j[1] / s, j[2] / s, j[3] / s)
        t0[k], t1[k] = joint[k][0] + joint[k][2], joint[k][1] + joint[k][3]
        out[k] = t1[k]
    return out, joint


def fit(pages: list[Page], epochs: int = EPOCHS, rate: float = 0.3, decay: float = 1e-3) -> dict[str, float]:
    """Maximum likelihood by stochastic gradient, AdaGrad steps."""
    w: dict[str, float] = {}
    seen: dict[str, float] = {}
    ready = [(p, p.features()) for p in pages]
    rng = random.Random(7)
    for _ in range(epochs):
        rng.shuffle(ready)
        for page, feats in ready:
            got, joint = marginals(page, feats, w)
            grad: dict[str, float] = {}
            for k, fs in enumerate(feats):
                d = page.labels[k] - got[k]
                if abs(d) > 1e-4:
                    for f in fs:
                        grad[f] = grad.get(f, 0.0) + d
                if k:
                    kind, is_ = edge_kind(page.tags[k]), 2 * page.labels[page.parents[k]] + page.labels[k]
                    for y, name in enumerate(("00", "01", "10", "11")):
                        d = (y == is_) - joint[k][y]
                        if abs(d) > 1e-4:
                            f = f"edge={kind}{name}"
                            grad[f] = grad.get(f, 0.0) + d
            for f, g in grad.items():
                g -= decay * w.get(f, 0.0)
                seen[f] = seen.get(f, 1e-6) + g * g
                w[f] = w.get(f, 0.0) + rate * g / math.sqrt(seen[f])
    return w


def layout(paragraphs: list[str], rng: random.Random) -> str:
    """A page without semantic elements (mostly), filled with the given paragraphs; data-y labels its parts."""
    esc = lambda s: entities.escape(s)
    pick = lambda *x: rng.choice(x)
    words = " ".join(paragraphs).split() or ["text"]

    def some(a: int, b: int) -> str:
        k = rng.randrange(len(words))
        return esc(" ".join(words[k:k + rng.randint(a, b)]) or "text")

    def links(a: int, b: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/x">{some(1, 4)}</a></li>' for _ in range(rng.randint(a, b))) + "</ul>"

    def maybe(share: float, s: str) -> str:
        return s if rng.random() < share else ""

    body = "".join(f"<{t}>{esc(p)}</{t}>" if (t := pick("p", "p", "p", "p", "h2", "blockquote", "li")) != "li" else f"<ul><li>{esc(p)}</li></ul>" for p in paragraphs)
    inner = [f"<h1>{some(3, 9)}</h1>", body]
    if rng.random() < 0.5:
        inner.insert(1, f'<div class="{pick("ad", "advert", "promo", "sponsored")}" data-y="0">{some(4, 30)}</div>')
    if rng.random() < 0.3:
        inner.append(f'<div class="{pick("share", "social", "related", "newsletter")}" data-y="0"><p>{some(2, 20)}</p>{links(2, 4)}</div>')
    root = pick('<div class="content"', '<div id="main"', '<div class="post entry"', '<section class="article-body"', '<div class="story"', "<article", "<main")
    main = f'{root} data-y="1">{"".join(inner)}</{root[1:].split()[0]}>'
    talk = "".join(f'<div class="comment"><p>{some(5, 60)}</p></div>' for _ in range(rng.randint(1, 4)))
    return (
        "<html><body>" + maybe(0.7, pick(f"<header><p>{some(2, 12)}</p></header>", f'<div class="header">{some(1, 6)}{links(2, 4)}</div>', f'<div id="masthead"><p>{some(2, 9)}</p></div>'))
        + maybe(0.8, pick(f"<nav>{links(3, 8)}</nav>", f'<div class="menu">{links(3, 8)}</div>', f'<div class="breadcrumb"><p><a href="/">{some(1, 2)}</a> {some(1, 2)}</p></div>'))
        + maybe(0.6, f'<div class="{pick("ad", "ads", "advertisement", "sponsor", "banner")}">{some(4, 40)}</div>')
        + maybe(0.5, f'<div {pick("class", "id")}="{pick("cookie-notice", "alert", "notice", "consent", "popup message")}"><p>{some(5, 40)}</p></div>')
        + maybe(0.3, pick(f"<aside><p>{some(5, 50)}</p></aside>", f'<div class="sidebar"><p>{some(5, 50)}</p>{links(2, 6)}</div>'))
        + main
        + maybe(0.4, pick(f"<aside><h3>{some(1, 4)}</h3><p>{some(5, 50)}</p>{links(2, 5)}</aside>", f'<div id="sidebar" class="widget"><p>{some(5, 60)}</p></div>'))
        + maybe(0.5, pick(f'<section id="comments"><h2>{some(1, 3)}</h2>{talk}</section>', f'<div class="comments">{talk}</div>', f'<ol class="commentlist"><li>{some(5, 50)}</li><li>{some(5, 50)}</li></ol>'))
        + maybe(0.4, f'<form class="{pick("login", "search", "signup", "")}"><p>{some(1, 9)}</p><input name="q"><button>{some(1, 2)}</button></form>')
        + maybe(0.8, pick(f"<footer>{some(4, 30)}</footer>", f'<div class="footer"><p>&copy; {some(4, 30)}</p></div>', f'<div id="footer">{links(2, 5)}<p>{some(3, 12)}</p></div>'))
        + "</body></html>")


def labelled_pages(sources: list[str]) -> list[Page]:
    rng, out = random.Random(11), []
    for source in sources:
        page = Page(source, labelled=True)
        texts = [t for k, t in page.blocks if page.labels[k]]
        if texts and any(not y for y in page.labels):
            out.append(page)
        out.append(Page(layout([t[:600] for t in texts or [t for _, t in page.blocks] or ["No text here."]][:12], rng), labelled=True))
    return out


def extract(source: str | None, w: dict[str, float]) -> str:
    if not source:
        return ""
    page = Page(source)
    got, _ = marginals(page, page.features(), w)
    return "\n\n".join(t for k, t in page.blocks if got[k] > 0.5)


def train(pages: DataFrame, limit: int = FIT_PAGES) -> dict[str, float]:
    """Weights from at most ``limit`` pages, taken by hash order, and one layout for each.

    A hash threshold first leaves about four times ``limit`` pages, so what reaches the driver does not grow with the table.
    """
    rows, h = pages.select("page_id", "html").where("length(html) > 0"), F.xxhash64("page_id")
    share = min(1.0, 4.0 * limit / max(pages.count(), 1))
    few = rows.where(F.pmod(h, F.lit(1 << 40)) <= int(share * (1 << 40)))
    rows = few.orderBy(h, "page_id").limit(limit).collect()
    plain = ["<html><body><p>" + " ".join(f"word{(i * j) % 97}" for j in range(20 + i)) + ".</p></body></html>" for i in range(40)]
    return fit(labelled_pages([r["html"] for r in rows] or plain))


def main_text(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(page_id, url, text, n_chars), one row per page."""
    w = weights or train(pages)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(x, w) for x in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(each, "page_id long, url string, text string, n_chars long")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
