"""Operator 10: the main text of web pages by boosted trees over the nodes of the page.

A tolerant parser makes a page's tree of block elements (and of inline ones that carry a
name of some kind of boilerplate). Gradient-boosted trees score each node by its tag,
the words of its class, id and role, what its ancestors are, depth, density of text and
of links in its subtree, punctuation, and how it stands among its siblings. Decoding is
over the tree: a node is kept only within a kept parent, and among all such choices the
one with the highest sum of (weighted) scores is taken, so no kept node ever lies in a
dropped one.

The trees learn from a bounded sample of pages that mark their article themselves, and
from variants of those pages: the article under other tags and names, with menus, side
bars, notices, adverts, forms and comments of other sites put around and into it.

Null html counts as empty, with empty text. Repeated rows get the same answer each; an
empty table gives an empty table; other columns are ignored. Pages are read whole.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import BoostedTrees
from .common import blocks, rows

SCHEMA = "page_id long, url string, text string, n_chars long"
#: Pages to learn from, and the length over which a page is not one of them.
SAMPLE_PAGES = 400
SAMPLE_CHARS = 60_000
#: What it takes to drop a node of a kept parent.
CHANGE = 4.0

# Kinds of elements.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe template svg noembed noframes".split())
_SILENT = frozenset("head select option optgroup button datalist object audio video canvas map".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q rb rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr "
    "math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle semantics".split()
)
#: An opening tag ends the open element of these names, if one is nearer than the stop.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
# Words of classes, ids and roles by what they name.
NAMES = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager tabs toc skip sitemap topnav subnav",
    "edge": "header masthead topbar banner footer foot bottom copyright colophon contentinfo legal branding logo",
    "side": "sidebar aside side rail related recommended recommendations more widget widgets trending popular latest teaser complementary",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner adsense dfp outbrain taboola",
    "comment": "comment comments commentlist disqus reply replies respond discussion reviews thread",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay dialog banner toast message disclaimer notification newsletter",
    "share": "share sharing social follow tweet facebook twitter buttons tools toolbar meta byline tags print author",
    "form": "form search login signin signup subscribe subscription newsletter register contact input field",
    "main": "article content post entry main body story text maincontent articlebody postcontent entrycontent prose page hentry",
}
_NAMED = {}
for _kind, _words in NAMES.items():
    for _word in _words.split():
        _NAMED.setdefault(_word, []).append(_kind)
_KINDS = [*NAMES]

_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*+>|</?[a-zA-Z][^>]*+(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
TAGS = {
    "text": "p blockquote pre dd dt", "title": "h1 h2 h3 h4 h5 h6 hgroup", "list": "ul ol dl menu", "item": "li",
    "box": "div section center", "article": "article main", "nav": "nav", "edge": "header footer", "aside": "aside",
    "form": "form fieldset legend label", "table": "table tbody thead tr td th tfoot", "figure": "figure figcaption caption",
    "dialog": "dialog details summary", "address": "address", "inline": "span a b i em strong small",
}
_TAGS = {tag: k for k, words in enumerate(TAGS.values()) for tag in words.split()}


@dataclass
class Page:
    """The nodes of a page in their order, and its text as pieces of nodes (-1: a break)."""

    tag: list[str] = field(default_factory=lambda: ["body"])
    names: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    parent: list[int] = field(default_factory=lambda: [0])
    end: list[int] = field(default_factory=lambda: [0])
    hidden: list[bool] = field(default_factory=lambda: [False])
    label: list[int] = field(default_factory=lambda: [-1])
    pieces: list[tuple[int, str]] = field(default_factory=list)
    linked: list[int] = field(default_factory=lambda: [0])


def _attributes(raw: str) -> tuple[tuple[str, ...], bool, int]:
    """Kinds that class, id and role name; whether hidden; a label set for learning."""
    kinds: list[str] = []
    hidden, label = False, -1
    for m in _ATTR.finditer(raw):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if name in ("class", "id", "role", "aria-label", "itemprop"):
            low = _CAMEL.sub(" ", value).lower()
            words = {*_WORDS.findall(low), *re.findall(r"[a-z]+", low.replace("-", "").replace("_", ""))}
            for word in sorted(words):
                kinds += _NAMED.get(word, ())
        elif name == "hidden" or name == "style" and "display:none" in value.replace(" ", "").lower():
            hidden = True
        elif name == "data-learn":
            label = int(value)
    return tuple(sorted(set(kinds))), hidden, label


def parse(text: str) -> Page:
    page = Page()
    # open elements: tag, node, whether it is a node of its own, whether silent
    open_: list[tuple[str, int, bool, bool]] = [("body", 0, True, False)]
    at, size, links = 0, len(text), 0

    def say(piece: str) -> None:
        if piece and not open_[-1][3]:
            piece = entities.unescape(piece)
            page.pieces.append((open_[-1][1], piece))
            if links:
                page.linked[open_[-1][1]] += len(piece.strip())

    def close(count: int) -> None:
        nonlocal links
        for _ in range(count):
            tag, node, own, _ = open_.pop()
            links -= tag == "a"
            if own:
                page.end[node] = len(page.tag)
            if tag not in _INLINE:
                page.pieces.append((-1, " "))

    while at < size:
        m = _MARK.search(text, at)
        if m is None:
            say(text[at:])
            break
        say(text[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(open_) - 1, 0, -1):
                if open_[k][0] == tag:
                    close(len(open_) - k)
                    break
                if tag in _INLINE and open_[k][0] not in _INLINE:
                    break  # an inline end tag doesn't end a block
            else:
                if tag in ("p", "br"):
                    page.pieces.append((-1, " "))
            continue
        if tag == "xmp":  # text as it stands, marks and references too
            stop = re.compile(r"</xmp(?=[\s/>])[^>]*+>?", re.I).search(text, at)
            page.pieces.append((-1, " "))
            if not open_[-1][3]:
                page.pieces.append((open_[-1][1], text[at : stop.start() if stop else size]))
            page.pieces.append((-1, " "))
            at = stop.end() if stop else size
            continue
        if tag in _RAW and not m[3].endswith("/"):
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*+>?", re.I).search(text, at)
            at = stop.end() if stop else size
            continue
        if tag in _VOID:
            if tag in ("br", "hr"):
                page.pieces.append((-1, " "))
            continue
        if tag in ("html", "body") and tag != "body":
            continue
        if tag == "body":
            for k in range(len(open_) - 1, 0, -1):
                if open_[k][0] == "head":
                    close(len(open_) - k)
                    break
            kinds, hidden, label = _attributes(m[3])
            if len(open_) == 1:
                page.names[0] = kinds
            continue
        if tag in _ENDS:
            names, stops = _ENDS[tag]
            for k in range(len(open_) - 1, 0, -1):
                if open_[k][0] in stops:
                    break
                if open_[k][0] in names and (tag != "tr" or open_[k][0] == "tr" or open_[k - 1][0] != "tr"):
                    close(len(open_) - k)
                    break
        elif tag not in _INLINE:
            # a block ends an open paragraph
            for k in range(len(open_) - 1, 0, -1):
                if open_[k][0] == "p":
                    close(len(open_) - k)
                    break
                if open_[k][0] not in _INLINE:
                    break
        kinds, hidden, label = _attributes(m[3]) if m[3].strip() else ((), False, -1)
        inline = tag in _INLINE
        if not inline:
            page.pieces.append((-1, " "))
        own = not inline or bool(set(kinds) - {"main"}) or hidden
        silent = open_[-1][3] or tag in _SILENT or hidden
        node = open_[-1][1]
        if own:
            page.parent.append(node)
            node = len(page.tag)
            page.tag.append(tag)
            page.names.append(kinds)
            page.hidden.append(hidden)
            page.label.append(label)
            page.end.append(0)
            page.linked.append(0)
        links += tag == "a"
        open_.append((tag, node, own, silent))
    close(len(open_))
    page.end[0] = len(page.tag)
    return page


# ---- features

_COUNTED = re.compile(r"[.,;:!?]")
FEATURES = [
    *(f"is_{t}" for t in [*TAGS, "other"]), *(f"names_{k}" for k in _KINDS), *(f"in_{k}" for k in _KINDS),
    *(f"under_{t}" for t in ("article", "nav", "edge", "aside", "form", "list", "table", "dialog")),
    *(f"holds_{t}" for t in ("article", "title", "text")),
    "depth", "text", "own", "share", "links", "marks", "nodes", "texts", "place", "end", "index", "siblings",
    "alike", "sibling_text", "above_text", "above_links", "words", "capital", "largest", "page_article", "page_main",
]


def features(pages: list[Page]) -> np.ndarray:
    """A row of FEATURES for each node of the pages, one page after another."""
    if not pages:
        return np.zeros((0, len(FEATURES)))
    sizes = np.array([len(p.tag) for p in pages])
    base = np.cumsum(sizes) - sizes
    page_of = np.repeat(np.arange(len(pages)), sizes)
    first = base[page_of]
    n = int(sizes.sum())
    parent = np.concatenate([np.array(p.parent) for p in pages]) + first
    end = np.concatenate([np.array(p.end) for p in pages]) + first
    number = np.arange(n)
    own, marks, words, capital = (np.zeros(n) for _ in range(4))
    for b, p in zip(base.tolist(), pages, strict=True):
        for node, piece in p.pieces:
            if node >= 0 and (size := len(piece.strip())):
                own[b + node] += size
                marks[b + node] += len(_COUNTED.findall(piece))
                words[b + node] += piece.count(" ") + 1
                capital[b + node] += piece[:1].isupper()
    linked = np.concatenate([np.array(p.linked, dtype=float) for p in pages])

    def subtree(x: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(x)])
        return sums[end] - sums[number]

    tag = np.array([_TAGS.get(t, len(TAGS)) for p in pages for t in p.tag])
    is_tag = np.zeros((n, len(TAGS) + 1))
    is_tag[number, tag] = 1
    names = np.zeros((n, len(_KINDS)))
    for k, kinds in enumerate(x for p in pages for x in p.names):
        for kind in kinds:
            names[k, _KINDS.index(kind)] = 1
    tags = [*TAGS]
    wanted = [tags.index(t) for t in ("article", "nav", "edge", "aside", "form", "list", "table", "dialog")]
    above = np.concatenate([names, is_tag[:, wanted]], axis=1)
    inherited = np.zeros_like(above)
    depth = np.zeros(n)
    roots = parent == number
    # parents come first, so a pass by depth settles every node
    level = np.flatnonzero(roots)
    children = np.argsort(parent[~roots], kind="stable")
    child = number[~roots][children]
    starts = np.searchsorted(parent[child], number, "left")
    counts = np.bincount(parent[child], minlength=n)
    at = 0
    while len(level):
        depth[level] = at
        inner = ~roots[level]
        up = parent[level[inner]]
        inherited[level[inner]] = np.maximum(inherited[up], above[up])
        reps = counts[level]
        offset = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
        level = child[np.repeat(starts[level], reps) + offset]
        at += 1
    text, link = subtree(own), subtree(linked)
    whole = text[first]
    nodes = (end - number).astype(float)
    texts = subtree((own > 0).astype(float))
    index = np.zeros(n)
    index[child] = np.arange(len(child)) - starts[parent[child]]
    siblings = counts[parent].astype(float)
    among = np.bincount(parent[~roots], weights=text[~roots], minlength=n)[parent] - text
    alike_key = parent * (len(TAGS) + 1) + tag
    _, group, many = np.unique(alike_key, return_inverse=True, return_counts=True)
    before = np.concatenate([[0], np.cumsum(own)])[number] - np.concatenate([[0], np.cumsum(own)])[first]
    page_article = np.maximum.reduceat(is_tag[:, tags.index("article")], base)[page_of]
    page_main = np.maximum.reduceat(names[:, _KINDS.index("main")], base)[page_of]
    biggest = np.zeros(n)
    np.maximum.at(biggest, parent[~roots], text[~roots])
    other = [
        depth, np.log1p(text), np.log1p(own), text / (whole + 1), link / (text + 1), subtree(marks) / (text + 1) * 100,
        np.log1p(nodes), np.log1p(texts), before / (whole + 1), (before + text) / (whole + 1), index, siblings,
        many[group] / np.maximum(1, siblings), np.log1p(among / np.maximum(1, siblings - 1)),
        np.log1p(text[parent]), link[parent] / (text[parent] + 1), subtree(words) / (texts + 1),
        subtree(capital) / (texts + 1), (text >= biggest[parent]).astype(float), page_article, page_main,
    ]
    holds = [subtree(is_tag[:, tags.index(t)]) - is_tag[:, tags.index(t)] for t in ("article", "title", "text")]
    held = [np.minimum(h, 3) for h in holds]
    return np.concatenate([is_tag, names, inherited, np.stack([*held, *other], axis=1)], axis=1)


# ---- decoding


def decode(page: Page, odds: np.ndarray) -> np.ndarray:
    """Which nodes are kept: the best choice in which kept nodes have kept parents.

    Each node weighs 1 and more with its own text; keeping it earns its log-odds, dropping
    a subtree loses those of all its nodes, and ``CHANGE`` for leaving its parent's part."""
    n = len(page.tag)
    own = np.zeros(n)
    for node, piece in page.pieces:
        if node >= 0:
            own[node] += len(piece.strip())
    value = (odds * (1 + np.log1p(own))).tolist()
    parent = page.parent
    total = list(value)  # of the subtree, if all of it is kept
    best = list(value)  # of the subtree, if the node is kept
    for k in range(n - 1, 0, -1):
        total[parent[k]] += total[k]
        best[parent[k]] += max(best[k], -total[k] - CHANGE)
    keep = np.zeros(n, dtype=bool)
    keep[0] = True
    for k in range(1, n):
        keep[k] = keep[parent[k]] and best[k] > -total[k] - CHANGE
    return keep


def text_of(page: Page, keep: np.ndarray) -> str:
    kept = keep.tolist()
    return " ".join("".join([p if k < 0 or kept[k] else "" for k, p in page.pieces]).split())


# ---- learning

_ARTICLE = re.compile(r"<(article|main)\b[^>]*>(.*?)</\1\s*>", re.S | re.I)
_HOLDERS = [
    '<article data-learn="1">{}</article>', '<main data-learn="1">{}</main>', '<div class="content" data-learn="1">{}</div>',
    '<div id="main-content" data-learn="1">{}</div>', '<div class="post-body entry" data-learn="1">{}</div>',
    '<section class="story" data-learn="1">{}</section>', '<div data-learn="1">{}</div>', '<div class="x7 row" data-learn="1">{}</div>',
    '<div role="main" data-learn="1"><div class="wrap">{}</div></div>', '<table><tr><td data-learn="1">{}</td></tr></table>',
    '<main data-learn="1"><article>{}</article></main>',
]
_BEFORE = [
    "<header{}><a href='/'>{a}</a><p>{b}</p></header>", "<nav{}><ul><li><a href='/1'>{a}</a></li><li><a href='/2'>{b}</a></li><li><a href='/3'>{c}</a></li></ul></nav>",
    "<div class='menu'{}><a href='/1'>{a}</a> <a href='/2'>{b}</a> <a href='/3'>{c}</a></div>", "<div class='cookie-consent'{}><p>{l}</p><button>OK</button></div>",
    "<div class='ad'{}>{l}</div>", "<div id='top-banner'{}><p>{l}</p></div>", "<ul{}><li><a href='/1'>{a}</a></li><li><a href='/2'>{b}</a></li><li><a href='/3'>{c}</a></li></ul>",
    "<form{}><label>{a}</label><input name=q><p>{b}</p></form>", "<div class='breadcrumbs'{}><a href='/'>{a}</a> &gt; <a href='/x'>{b}</a></div>", "<div role='alert'{}><p>{l}</p></div>",
    "<div class='masthead'{}><h1>{a}</h1><p>{b}</p></div>",
]
_AFTER = [
    "<footer{}><p>&copy; {l}</p><a href='/i'>{a}</a></footer>", "<aside{}><h3>{a}</h3><ul><li><a href='/1'>{b}</a></li><li><a href='/2'>{c}</a></li></ul></aside>",
    "<div class='sidebar'{}><h2>{a}</h2><p>{l}</p></div>", "<section id='comments'{}><h3>{a}</h3><div class='comment'><b>{b}</b><p>{l}</p></div><div class='comment'><p>{l}</p></div></section>",
    "<div class='comments'{}><ol><li><p>{l}</p></li><li><p>{l}</p></li></ol></div>", "<div class='related'{}><h4>{a}</h4><a href='/1'>{b}</a><a href='/2'>{c}</a></div>",
    "<div class='footer'{}>&copy; {l}</div>", "<div class='newsletter'{}><p>{l}</p><form><input><p>{a}</p></form></div>", "<div class='share-buttons'{}><a href='/s'>{a}</a><a href='/t'>{b}</a></div>",
    "<div class='sponsored'{}><p>{l}</p></div>", "<form class='signup'{}><p>{l}</p><label>{a}</label></form>", "<div class='legal'{}><small>{l}</small></div>",
    "<aside class='widget'{}><p>{l}</p></aside>",
]
_WITHIN = [
    "<div class='ad'{}>{l}</div>", "<aside{}><p>{l}</p></aside>", "<nav{}><a href='/1'>{a}</a><a href='/2'>{b}</a></nav>", "<form{}><p>{a}</p><input></form>",
    "<div class='advertisement'{}><p>{l}</p></div>", "<div class='notice'{}><p>{l}</p></div>", "<section class='comments'{}><p>{l}</p><p>{l}</p></section>", "<div class='share'{}><a href='/s'>{a}</a></div>",
    "<footer{}><p>{l}</p></footer>",
]
#: Other blocks that an article may consist of.
_BLOCKS = [
    "<ul><li>{}</li></ul>", "<ol><li>{}</li><li>{}</li></ol>", "<blockquote><p>{}</p></blockquote>", "<h2>{}</h2>", "<h3>{}</h3>", "<div>{}</div>",
    "<pre>{}</pre>", "<table><tr><td>{}</td><td>{}</td></tr></table>", "<figure><img src=x><figcaption>{}</figcaption></figure>", "<section><p>{}</p></section>",
    "<p><a href='/more'>{}</a></p>", "<p class='lead'>{}</p>", "<dl><dt>{}</dt><dd>{}</dd></dl>",
]
_BUILTIN = "<article><h1>A day at the lake</h1><p>{}</p><p>Short one.</p><p>{}</p></article>"


def variants(pages: list[str], seed: int = 10) -> list[Page]:
    """Pages to learn from, their nodes labelled: those that mark an article as they are,
    and each of them twice rebuilt in other ways."""
    rng = random.Random(seed)
    plain = "The boat went out, and nobody saw it return until the evening came. " * 4
    pages = [p for p in pages if _ARTICLE.search(p)] or [_BUILTIN.format(plain, plain.upper()), _BUILTIN.format(plain, "x, y.")] * 40
    words = [w for p in pages[:50] for w in entities.unescape(re.sub(r"<[^>]*>", " ", _ARTICLE.search(p)[2])).split()]
    words = words or ["word"]

    def some(a: int, b: int) -> str:
        k = rng.randrange(len(words))
        return entities.escape(" ".join((words[k:] + words)[: rng.randint(a, b)]))

    def made(choices: list[str]) -> str:
        part = rng.choice(choices).replace("{}", ' data-learn="0"')
        if rng.random() < 0.1:  # without its telling name
            part = re.sub(r" (class|id|role)='[^']*'", "", part)
        while (m := re.search(r"\{([abcl])\}", part)) is not None:
            part = part.replace(m[0], some(5, 60) if m[1] == "l" else some(1, 4), 1)
        return part

    out = []
    for page in pages:
        m = _ARTICLE.search(page)
        head = page[: m.start()]
        out.append(parse(head + f'<{m[1]} data-learn="1">{m[2]}</{m[1]}>' + page[m.end() :]))
        for _ in range(2):
            body = m[2]
            blocks_ = [x.end() for x in re.finditer(r"</(?:p|h\d)>", body)]
            if blocks_ and rng.random() < 0.3:  # short articles are articles too
                body = body[: blocks_[min(len(blocks_) - 1, rng.randrange(3))]]
            body = re.sub(r"<p>(.*?)</p>", lambda x: rng.choice(_BLOCKS).replace("{}", x[1]) if rng.random() < 0.3 else x[0], body, flags=re.S)
            for _ in range(rng.choice([0, 0, 1, 2])):
                cuts = [x.end() for x in re.finditer(r"</(?:p|h\d)>", body)] or [len(body)]
                k = rng.choice(cuts)
                body = body[:k] + made(_WITHIN) + body[k:]
            before = "".join(made(_BEFORE) for _ in range(rng.randint(0, 4)))
            after = "".join(made(_AFTER) for _ in range(rng.randint(0, 4)))
            held = rng.choice(_HOLDERS).replace("{}", body, 1)
            whole = before + held + after
            if rng.random() < 0.5:
                whole = f"<div class='{rng.choice(['wrapper', 'page', 'container', 'site'])}'>{whole}</div>"
            out.append(parse(f"<html><head><title>{some(2, 6)}</title></head><body>{whole}</body></html>"))
    return out


def _labels(page: Page) -> np.ndarray:
    """1 for the nodes of the article, and for those around it, which must be kept for its
    sake; 0 for the others."""
    around, label = [], []
    for k, own in enumerate(page.label):
        up = page.parent[k]
        outside = k == 0 or around[up]
        around.append(own < 0 and outside and 1 in page.label[k : page.end[k]])
        label.append(own if own >= 0 else int(around[k]) if outside else label[up])
    return np.array(label, dtype=float)


def fit(pages: list[str]) -> BoostedTrees:
    made = variants(pages)
    label = np.concatenate([_labels(p) for p in made])
    # every third page is one as found, and counts as much as its variants
    weight = np.repeat([2.0 if k % 3 == 0 else 1.0 for k in range(len(made))], [len(p.tag) for p in made])
    return BoostedTrees().fit(features(made), label, weight)


def learned(df: DataFrame, sample: int = SAMPLE_PAGES, id_col: str = "page_id", html_col: str = "html") -> BoostedTrees:
    """Trees from a sample of at most ``sample`` pages that mark their article."""
    draw = F.xxhash64(F.col(id_col), F.lit("pages"))
    marked = F.col(html_col).rlike("(?i)<(article|main)[ >]") & (F.length(html_col) <= SAMPLE_CHARS)
    picked = df.where(marked).select(F.col(id_col).alias("id"), draw.alias("draw"), F.col(html_col).alias("html"))
    # ids first: only the sample's pages are sorted with their text
    chosen = picked.select("draw").orderBy("draw").limit(sample).agg(F.max("draw")).first()[0]
    if chosen is None:
        return fit([])
    rows_ = picked.where(F.col("draw") <= chosen).select("draw", "html").orderBy("draw", "html").limit(sample).collect()
    return fit([r["html"] for r in rows_])


# ---- the operator


def extracted(texts: list[str], trees: BoostedTrees) -> list[str]:
    pages = [parse(t) for t in texts]
    odds = trees.log_odds(features(pages))
    cuts = np.cumsum([len(p.tag) for p in pages])[:-1]
    return [text_of(p, decode(p, o)) for p, o in zip(pages, np.split(odds, cuts), strict=True)]


def main_text(
    df: DataFrame, shared: Broadcast, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """page_id, url, text and n_chars of every page. ``shared``: broadcast trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, text="html"):
            texts = extracted(b.column(2).to_pylist(), shared.value)
            found = {"page_id": b.column(0), "url": b.column(1), "text": texts, "n_chars": [len(t) for t in texts]}
            yield rows(SCHEMA, found)

    named = df.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"),
    )
    return named.mapInArrow(run, SCHEMA)
