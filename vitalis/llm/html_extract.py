"""Main text of web pages: boosted trees over DOM nodes, decoded so that no node contradicts its ancestors.

A page is parsed into its block elements (inline markup only counts).  For each, features say how dense its text is (text a
tag, share of link text, words, punctuation), what its tag and its attribute tokens are worth, how deep it lies, how it
stands among its siblings, and the worst and best token among its ancestors.  Boosted trees give each node the log-odds that
it belongs to, or holds, the main text.  Decoding picks the consistent labelling of greatest total: below a node that is
left out everything is left out, and below one that is kept each child may be either.  That is one pass up and one down.

The model is trained here.  A bounded sample of pages (``SAMPLE``, chosen by a hash of the id) gives paragraphs and, where a
page marks its article (article or main element), labels.  Each sampled page is also laid out anew in generated templates
that mark the article by attributes or not at all, with menus, notices, adverts, sidebars, forms, comments and footers around
and inside; there the labels are known.

Scripts, styles and the like have no text; formulas have.  A head without an end tag ends at the first thing that cannot stand in it.  Character references are decoded; white space inside a block becomes one blank
(a line break too); blocks are trimmed and joined by line breaks in page order; nothing else is dropped or cut.

Defined cases: null and empty pages, and pages whose text is all left out, give an empty text; text outside of any element
belongs to the page itself; broken markup is read as a browser would in the common cases (missing ends, stray ends); repeated
rows are treated alike.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis.llm import boosting
from vitalis.llm.scratch import hash_sample, map_arrow

#: Pages in the labelled sample, and layouts made of each.
SAMPLE = 150
LAYOUTS = 4

# Element names by their role in the HTML standard.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br input math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom menclose mfenced msub msup msubsup munder mover munderover mmultiscripts mprescripts none mtable mtr mtd maction semantics annotation annotation-xml".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("head script style noscript template title textarea select option svg object iframe canvas audio video datalist".split())
HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME_CLOSE = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
SCOPE = frozenset("ul ol dl table body html".split())

TAGS = ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "blockquote", "pre", "table", "tr", "td", "th", "div", "section", "article", "main", "figure", "figcaption", "dl", "dt", "dd", "body", "html", "nav", "aside", "header", "footer", "form", "fieldset", "button", "menu", "address", "dialog", "details")
KEEP = "data-kept"
_TOKEN = re.compile(r"[a-z]+|[A-Z][a-z]*")
_MARKS = re.compile(r"[.,;:!?]")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    tokens: tuple[str, ...]
    kept: bool = False
    text: int = 0
    links: int = 0
    words: int = 0
    marks: int = 0
    elements: int = 0
    children: list[int] = field(default_factory=list)


class Page(HTMLParser):
    """Block elements and runs of text; ``runs`` are (node, text) in page order."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("html", -1, 0, ())]
        self.runs: list[tuple[int, str]] = []
        self.open = [("html", 0)]  # element names and the block each lies in or is
        self.named = Counter()  # how many of each name are open, html at the bottom apart
        self.held: list[str] = []
        self.links = self.silent = 0
        self.feed(html)
        self.close()
        self.end_run()
        for i in range(len(self.nodes) - 1, 0, -1):
            n, up = self.nodes[i], self.nodes[self.nodes[i].parent]
            for name in ("text", "links", "words", "marks"):
                setattr(up, name, getattr(up, name) + getattr(n, name))
            up.elements += n.elements + 1
            up.kept |= n.kept and bool(n.text)

    def end_run(self) -> None:
        if self.held:
            text = " ".join("".join(self.held).split())
            self.held = []
            if text:
                at = self.open[-1][1]
                n = self.nodes[at]
                n.text += len(text)
                n.words += text.count(" ") + 1
                n.marks += len(_MARKS.findall(text))
                self.runs.append((at, text))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "body" or tag not in HEAD:
            self.leave_head(tag == "body")
        if tag in SILENT:
            self.end_run_for(tag)
            if tag not in VOID:
                self.silent += 1
                self.begin(tag, self.open[-1][1])
            return
        here = self.open[-1][1]
        if tag in INLINE:
            self.nodes[here].elements += 1
            if tag in ("br", "mtr", "mtd"):
                self.held.append(" ")
            elif tag not in VOID:
                self.links += tag == "a"
                self.begin(tag, here)
            return
        self.end_run()
        if tag in ("html", "body") and any(name == tag for name, _ in self.open):
            return
        if tag in CLOSES_P:
            self.close_open(("p",))
        if tag in SAME_CLOSE:
            self.close_open(SAME_CLOSE[tag])
        here = self.open[-1][1]
        if tag in VOID:
            self.nodes[here].elements += 1
            return
        values = dict(attrs)
        tokens = tuple(t.lower() for name in ("class", "id", "role") for t in _TOKEN.findall(values.get(name) or ""))
        up = self.nodes[here]
        up.children.append(len(self.nodes))
        self.nodes.append(Node(tag, here, up.depth + 1, tokens, KEEP in values))
        self.begin(tag, len(self.nodes) - 1)

    def end_run_for(self, tag: str) -> None:
        if tag not in ("svg", "object", "canvas"):
            self.end_run()

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.end_run()
        # the stack is searched only for a name that is open: stray end tags cost nothing
        at = next((i for i in range(len(self.open) - 1, 0, -1) if self.open[i][0] == tag), None) if self.named[tag] else None
        if at is not None and tag not in ("html", "body"):
            # an inline end does not close blocks
            if tag in INLINE and any(name not in INLINE for name, _ in self.open[at + 1 :]):
                return
            self.drop(at)

    def leave_head(self, wherever: bool = False) -> None:
        """Closes a head whose end tag is left out: ``wherever`` it is open, or if nothing is open inside it."""
        if not self.named["head"]:
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == "head":
                self.drop(i)
            if not wherever:
                return

    def close_open(self, names: tuple[str, ...]) -> None:
        """Closes the innermost open element of these names, if no list or table begins inside it."""
        if not any(self.named[n] for n in names):
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] in names:
                self.drop(i)
                return
            if self.open[i][0] in SCOPE or (names == ("p",) and self.open[i][0] not in INLINE):
                return

    def begin(self, name: str, block: int) -> None:
        self.open.append((name, block))
        self.named[name] += 1

    def drop(self, at: int) -> None:
        for name, _ in self.open[at:]:
            self.named[name] -= 1
            self.links -= name == "a"
            self.silent -= name in SILENT
        del self.open[at:]

    def handle_data(self, data: str) -> None:
        if self.silent and data.strip():
            self.leave_head()
        if not self.silent:
            self.held.append(data)
            if self.links:
                self.nodes[self.open[-1][1]].links += len(data.strip())


@dataclass
class Model:
    worth: dict[str, float]
    trees: boosting.Boosted


def features(page: Page, worth: dict[str, float]) -> np.ndarray:
    """One row a node; parents come before children."""
    nodes = page.nodes
    total = max(1, nodes[0].text)
    out = np.zeros((len(nodes), 24))
    same = [Counter(nodes[c].tag for c in n.children) for n in nodes]
    place = {c: (k, len(n.children)) for n in nodes for k, c in enumerate(n.children)}
    for i, n in enumerate(nodes):
        own = [worth.get(t, 0.0) for t in (*n.tokens, "<" + n.tag)]
        tokens = own[:-1] or [0.0]
        up = out[n.parent] if i else np.zeros(24)
        k, many = place.get(i, (0, 1))
        mother = nodes[n.parent] if i else n
        alike = same[n.parent if i else 0][n.tag]
        out[i] = (
            min(tokens),
            max(tokens),
            own[-1],
            min(min(own), up[3]),  # the worst and best on the way down
            max(max(own), up[4]),
            TAGS.index(n.tag) if n.tag in TAGS else len(TAGS),
            n.depth,
            k,
            many,
            k / many,
            alike / many,
            math.log1p(n.text),
            n.text / total,
            n.text / (n.elements + 1),
            n.links / max(1, n.text),
            n.words,
            n.text / max(1, n.words),
            n.marks / max(1, n.words),
            len(n.children),
            n.elements,
            mother.text and n.text / mother.text,
            mother.links / max(1, mother.text),
            up[11] if i else 0.0,
            len(n.tokens),
        )
    return out


def decode(page: Page, logit: np.ndarray) -> np.ndarray:
    """Which nodes are kept: the best labelling in which no kept node lies below one that is left out."""
    nodes = page.nodes
    keep, leave = logit.copy(), -logit
    for i in range(len(nodes) - 1, 0, -1):
        keep[nodes[i].parent] += max(keep[i], leave[i])
        leave[nodes[i].parent] += leave[i]
    kept = np.zeros(len(nodes), bool)
    for i, n in enumerate(nodes):
        kept[i] = (i == 0 or kept[n.parent]) and (keep[i] > leave[i] or i == 0)
    return kept


def text_of(page: Page, kept: np.ndarray) -> str:
    return "\n".join(text for node, text in page.runs if kept[node])


def extract(htmls: list[str | None], model: Model) -> list[str]:
    pages = [Page(h or "") for h in htmls]
    if not pages:
        return []
    rows = [features(p, model.worth) for p in pages]
    logit = model.trees.logit(np.concatenate(rows))
    out, at = [], 0
    for p, r in zip(pages, rows, strict=True):
        out.append(text_of(p, decode(p, logit[at : at + len(r)])))
        at += len(r)
    return out


# Layouts for training.  Words are attribute tokens as page authors use them.
_BAD = {
    "nav": "nav menu navbar navigation topnav mainmenu breadcrumb breadcrumbs tabs toolbar pagination pager links",
    "header": "header masthead topbar banner brand logo siteheader site",
    "footer": "footer bottom colophon copyright legal sitefooter credits",
    "side": "sidebar aside side widget rail secondary related recommended recommend popular trending more teaser links tags archive",
    "ad": "ad ads advert advertisement adbox sponsor sponsored promo promotion banner commercial partner",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay message disclaimer warning privacy paywall announcement toast",
    "form": "form search login signup subscribe newsletter register contact email field",
    "comments": "comment comments commentlist discussion replies reply respond disqus feedback reader responses thread reviews",
    "share": "share social sharing follow buttons tools meta byline",
}
_GOOD = "content article post entry story main body text page maincontent articlebody postcontent prose copy hentry".split()
_FILLER = "home about contact news sports world sign in our privacy policy terms accept all cookies read more click here buy now share this subscribe today reply like posted by user great thanks agree search email password send top offers best price related stories copyright reserved".split()


def _layout(rng: np.random.Generator, title: str, paragraphs: list[str]) -> str:
    """A page around some paragraphs; what belongs to the article carries the attribute KEEP."""
    pick = lambda xs: xs[int(rng.integers(len(xs)))]

    def phrase(lo: int, hi: int) -> str:
        # boilerplate reads like filler or like any paragraph
        if paragraphs and rng.random() < 0.5:
            words = pick(paragraphs).split()
            at = int(rng.integers(max(1, len(words))))
            return " ".join(words[at : at + int(rng.integers(lo, hi))]) or "more"
        return " ".join(pick(_FILLER) for _ in range(int(rng.integers(lo, hi)))).capitalize() + pick(["", ".", "!"])

    def named(kind: str, tag: str) -> str:
        if tag not in ("div", "section", "ul", "p", "form") and rng.random() < 0.6:
            return f"<{tag}>"
        words = _BAD[kind].split()
        name = pick(words) if rng.random() < 0.7 else pick(words) + pick(["-", "_"]) + pick(words + _BAD["side"].split())
        return f'<{tag} {pick(["class", "id"])}="{name}">'

    def links(n: int) -> str:
        inner = "".join(f'<li><a href="#">{phrase(1, 4)}</a></li>' for _ in range(n))
        return f"<ul>{inner}</ul>" if rng.random() < 0.7 else "".join(f'<a href="#">{phrase(1, 4)}</a> ' for _ in range(n))

    def lines(n: int, tag: str = "p") -> str:
        return "".join(f"<{tag}>{phrase(2, 25)}</{tag}>" for _ in range(n))

    def block(kind: str) -> str:
        n = int(rng.integers(1, 5))
        if kind == "nav":
            tag = pick(["nav", "div", "ul"])
            return f"{named(kind, tag)}{links(n + 2)}</{tag}>"
        if kind in ("header", "footer"):
            tag = pick([kind, kind, "div"])
            return f"{named(kind, tag)}{pick([lines(n), links(n), phrase(2, 12), '&copy; ' + phrase(3, 12)])}</{tag}>"
        if kind == "side":
            tag = pick(["aside", "aside", "div", "section"])
            return f"{named(kind, tag)}<h3>{phrase(1, 4)}</h3>{pick([links(n + 1), lines(n)])}</{tag}>"
        if kind == "form":
            return f'<form action="#">{lines(1)}<label>{phrase(1, 3)}</label><input><button>{phrase(1, 3)}</button></form>' if rng.random() < 0.6 else f"{named(kind, 'div')}{lines(1)}<input></div>"
        if kind == "comments":
            tag = pick(["section", "div", "ul"])
            one = lambda: f"<div class=\"{pick(['comment', 'reply', 'item', 'entry'])}\"><p>{phrase(1, 3)}</p><p>{phrase(3, 40)}</p></div>"
            return f"{named(kind, tag)}<h2>{pick(['Comments', 'Responses', phrase(1, 4)])}</h2>{''.join(one() for _ in range(n))}</{tag}>"
        tag = pick(["div", "div", "section", "p", "aside"])
        return f"{named(kind, tag)}{lines(n) if tag != 'p' and rng.random() < 0.5 else phrase(2, 25)}</{tag}>"

    def short() -> str:
        words = pick(paragraphs).split() if paragraphs else _FILLER
        at = int(rng.integers(max(1, len(words))))
        return " ".join(words[at : at + int(rng.integers(1, 12))]) or title

    def several(tag: str) -> str:
        return "".join(f"<{tag} {KEEP}>{short()}</{tag}>" for _ in range(int(rng.integers(1, 6))))

    body = [f"<h1 {KEEP}>{title}</h1>"] if title else []
    for p in paragraphs:
        tag = pick(["p"] * 12 + ["h2", "h3", "blockquote", "ul", "ol", "table", "dl", "div", "pre", "section", "figure"])
        inner = f"<b>{p}</b>" if rng.random() < 0.1 else short() if rng.random() < 0.15 else p
        if tag in ("ul", "ol"):
            body.append(f"<{tag}>{several('li')}</{tag}>")
        elif tag == "table":
            body.append("<table>" + "".join(f"<tr>{several('td')}</tr>" for _ in range(int(rng.integers(1, 4)))) + "</table>")
        elif tag == "dl":
            body.append(f"<dl>{several('dt')}{several('dd')}</dl>")
        elif tag == "section":
            body.append(f"<section><h2 {KEEP}>{short()}</h2><p {KEEP}>{inner}</p></section>")
        elif tag == "figure":
            body.append(f"<figure><img src=x><figcaption {KEEP}>{short()}</figcaption></figure>")
        else:
            body.append(f"<{tag} {KEEP}>{inner}</{tag}>")
        if rng.random() < 0.08:
            body.append(block(pick(["ad", "side", "share", "notice", "form"])))
    if rng.random() < 0.3:
        body.append(block("comments"))
    inside = "".join(body)
    style = int(rng.integers(4))
    if style == 0:
        middle = f"<article>{inside}</article>"
    elif style == 1:
        middle = f"<main>{inside}</main>"
    elif style == 2:
        middle = f'<div {pick(["class", "id"])}="{pick(_GOOD)}{pick(["", "-" + pick(_GOOD)])}">{inside}</div>'
    else:
        middle = f"<div>{inside}</div>"
    if rng.random() < 0.3:
        middle = f'<div class="{pick(["wrapper", "container", "row", "layout", "grid", "col"])}">{middle}{block("side") if rng.random() < 0.6 else ""}</div>'
    before = "".join(block(k) for k in ("header", "nav", "notice", "ad") if rng.random() < 0.6)
    after = "".join(block(k) for k in ("share", "comments", "side", "ad", "form", "notice", "footer") if rng.random() < 0.45)
    return f"<html><head><title>{title}</title></head><body>{before}{middle}{after}</body></html>"


def _escaped(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;")


def train(htmls: list[str], seed: int = 11) -> Model:
    """A model from sampled pages; see the module's text."""
    rng = np.random.default_rng(seed)
    pages: list[Page] = []
    sources: list[tuple[str, list[str]]] = [(" ".join(_FILLER[:6]), [" ".join(rng.choice(_FILLER, 30)) + "." for _ in range(6)]) for _ in range(20)]
    for h in htmls:
        own = Page(h or "")
        marked = {i for i, n in enumerate(own.nodes) if n.tag in ("article", "main")}
        inside = set(marked)
        for i, n in enumerate(own.nodes):
            if n.parent in inside:
                inside.add(i)
        if marked:
            for i, n in enumerate(own.nodes):
                n.kept = i in inside
            for i in range(len(own.nodes) - 1, 0, -1):
                own.nodes[own.nodes[i].parent].kept |= own.nodes[i].kept
            pages.append(own)
        runs = [text for node, text in own.runs if not marked or node in inside]
        if runs:
            sources.append((_escaped(runs[0][:80]), [_escaped(r) for r in runs[1:40]] or [_escaped(runs[0])]))
    for title, paragraphs in sources:
        for _ in range(LAYOUTS):
            some = paragraphs[: int(rng.integers(1, len(paragraphs) + 1))]
            pages.append(Page(_layout(rng, title, some)))
    # what a token is worth: smoothed log-odds over the nodes that have it
    good: dict[str, float] = {}
    bad: dict[str, float] = {}
    for p in pages:
        for n in p.nodes[1:]:
            for t in {*n.tokens, "<" + n.tag}:
                side = good if n.kept else bad
                side[t] = side.get(t, 0) + 1
    worth = {t: math.log((good.get(t, 0) + 1) / (bad.get(t, 0) + 1)) for t in {*good, *bad}}
    x = np.concatenate([features(p, worth) for p in pages])
    y = np.array([n.kept for p in pages for n in p.nodes], float)
    return Model(worth, boosting.fit(x, y))


def with_text(pages: DataFrame, key: str = "page_id", html: str = "html", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """``pages`` with the main text of ``html``; the model is fitted on at most ``sample`` pages, and every page is extracted."""
    if text in pages.columns:
        raise ValueError(f"column already there: {text}")
    chosen = hash_sample(pages.where(F.col(html).isNotNull()).select(key, html), key, sample).limit(sample)
    model = pages.sparkSession.sparkContext.broadcast(train(sorted(r[html] for r in chosen.collect())))
    schema = T.StructType([*pages.schema.fields, T.StructField(text, T.StringType())])
    at = pages.columns.index(html)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 200):
                part = batch.slice(i, 200)
                found = pa.array(extract(part.column(at).to_pylist(), model.value), pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, found], names=schema.fieldNames())

    return map_arrow(pages, run, schema)
