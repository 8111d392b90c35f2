"""HTML extraction: boosted trees over features of DOM nodes, decoded so that a kept node's ancestors are kept."""

from __future__ import annotations

import html
import math
import random
import re
from bisect import bisect_right
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import map_batches, without
from cellweave.session import ship

# Element names of HTML by how they parse.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br".split())
SILENT = frozenset("script style template noscript iframe svg audio video canvas select option textarea button title".split())
IN_HEAD = frozenset("base basefont bgsound link meta title style script noscript template".split())
RAW = frozenset("script style textarea title iframe noscript template".split())
#: A start tag ends these open elements, up to the nearest of the second set.
_BLOCK_ENDS_P = frozenset("address article aside blockquote center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table tbody td tfoot th thead tr ul body".split())
_ENDS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
_ENDS = {name: (ends.split(), stops.split()) for name, (ends, stops) in _ENDS.items()}
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"<]*+\"|'[^'<]*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.DOTALL
)
_ATTRIBUTE = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_TOKEN = re.compile(r"[a-z]+")
#: Groups of attribute tokens; a token belongs to a group if it begins with one of its words.
GROUPS = {
    "main": "article content post entry story body main text prose".split(),
    "ad": "advert sponsor promo banner outbrain taboola affiliate".split(),
    "menu": "nav menu breadcrumb pagination pager tabs toc skip".split(),
    "comment": "comment reply replies disqus discussion respond feedback".split(),
    "side": "sidebar side aside widget related recommend rail popular trending more also".split(),
    "foot": "footer foot copyright legal colophon".split(),
    "head": "header masthead topbar logo branding tagline".split(),
    "notice": "cookie consent notice alert gdpr newsletter subscribe popup modal overlay privacy signup warning".split(),
    "share": "share social follow tweet facebook byline meta tags".split(),
    "form": "form login search contact".split(),
}
_AD_WORDS = frozenset(("ad", "ads", "adv", "adbox", "adslot"))
TAGS = {
    "text": ("#text",), "p": ("p",), "heading": ("h1", "h2", "h3", "h4", "h5", "h6"), "item": ("li", "dd", "dt"), "list": ("ul", "ol", "dl", "menu"), "div": ("div", "center"),
    "section": ("section",), "article": ("article", "main"), "nav": ("nav",), "footer": ("footer",), "aside": ("aside",), "header": ("header",), "form": ("form", "fieldset"),
    "table": ("table", "tbody", "tr", "td", "th", "thead"), "quote": ("blockquote", "pre", "figure", "figcaption"), "root": ("#root", "html", "body"), "dialog": ("dialog", "details", "summary"),
}
_TAG_CODE = {t: i for i, names in enumerate(TAGS.values()) for t in names}
_GROUP_CODE = {g: i for i, g in enumerate(GROUPS)}


@lru_cache(maxsize=50_000)
def _groups_of(token: str) -> tuple[int, ...]:
    if token in _AD_WORDS:
        return (_GROUP_CODE["ad"],)
    return tuple(_GROUP_CODE[g] for g, words in GROUPS.items() if any(token.startswith(w) for w in words))


@dataclass
class Dom:
    """Nodes in page order; ``#text`` nodes are the blocks of text, the others are elements that hold blocks."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    groups: list[int] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)

    def add(self, tag: str, parent: int, groups: int = 0) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.groups.append(groups)
        self.text.append("")
        self.linked.append(0)
        return len(self.tag) - 1


class _Stack:
    """Open elements, and where each name is open, so that no tag has to search the stack.

    An entry is a name, its node (that of the nearest block ancestor for inline ones) and the
    place of the nearest entry that is not inline.
    """

    def __init__(self) -> None:
        self.items: list[tuple[str, int, int]] = [("#root", 0, 0)]
        self.places: dict[str, list[int]] = {}

    def push(self, name: str, node: int) -> None:
        at = len(self.items)
        self.places.setdefault(name, []).append(at)
        self.items.append((name, node, self.items[-1][2] if name in INLINE else at))

    def pop(self) -> str:
        name = self.items.pop()[0]
        self.places[name].pop()
        return name

    def last(self, names) -> int:
        """The place of the innermost open element of these names, 0 if none is open."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)

    def first_above(self, names, place: int) -> int:
        """The place of the outermost one of these names inside of ``place``, 0 if there is none."""
        found = [at[i] for n in names if (at := self.places.get(n)) and (i := bisect_right(at, place)) < len(at)]
        return min(found, default=0)


def parse(page: str) -> Dom:
    """Blocks and their ancestors, in time linear in the page.

    Tags may be missing or cut off; scripts, styles, head and controls are left out. The head
    ends at its end tag, or at the first element or text that can't be in it.
    """
    dom = Dom()
    dom.add("#root", -1)
    stack = _Stack()
    run: list[str] = []
    links, linked, silent = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join("".join(run).split())
            if text:
                at = dom.add("#text", stack.items[-1][1])
                dom.text[at] = text
                dom.linked[at] = min(linked, len(text))
            run.clear()
        linked = 0

    def put(raw: str) -> None:
        nonlocal linked
        if silent and stack.items[-1][0] == "head" and not raw.isspace():
            pop(len(stack.items) - 1)
        if not silent:
            raw = html.unescape(raw) if "&" in raw else raw
            run.append(raw)
            if links:
                linked += len(raw.strip())

    def pop(to: int) -> None:
        nonlocal links, silent
        while len(stack.items) > to:
            if stack.items[-1][0] not in INLINE:
                flush()
            name = stack.pop()
            links -= name == "a"
            silent -= name in SILENT or name == "head"

    at, size = 0, len(page)
    while at < size:
        m = _MARKUP.search(page, at)
        if not m:
            put(page[at:])
            break
        if m.start() > at:
            put(page[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name = name.lower()
        if m[1] or m[4]:
            if place := stack.last((name,)):
                pop(place)
            elif name not in INLINE:
                flush()
            continue
        if name not in IN_HEAD and (place := stack.last(("head",))):
            pop(place)
        if name == "br":
            put(" ")
            continue
        if name in VOID:
            if name == "hr":
                flush()
            continue
        if name in _BLOCK_ENDS_P:
            if place := stack.last(("select", "svg")):  # left open
                pop(place)
            place = stack.items[-1][2]
            if stack.items[place][0] == "p":
                pop(place)
        if name in _ENDS:
            ends, stops = _ENDS[name]
            stop = stack.last(stops)
            place = stack.first_above(ends, stop) if name == "tr" else stack.last(ends)
            if place > stop:
                pop(place)
        attributes = m[3] if m[2] else m[6]
        if name in RAW:
            end = re.compile(rf"</{name}", re.IGNORECASE).search(page, at)
            at = end.start() if end else size
        if name in INLINE:
            stack.push(name, stack.items[-1][1])
            links += name == "a"
        elif attributes.endswith("/") and name not in _TAG_CODE and name not in SILENT:
            flush()
        else:
            flush()
            groups = 0
            if attributes:
                for a in _ATTRIBUTE.findall(attributes):
                    for token in _TOKEN.findall((a[0] or a[1] or a[2]).lower()):
                        for g in _groups_of(token):
                            groups |= 1 << g
            stack.push(name, dom.add(name, stack.items[-1][1], groups) if not silent else stack.items[-1][1])
            silent += name in SILENT or name == "head"
    pop(1)
    flush()
    return dom


_SIGNS = re.compile(r"[.!?;:]")
NUMBERS = (
    "chars", "link_share", "sign_share", "mean_word", "elements", "density", "paragraphs", "depth", "place", "siblings", "like_siblings",
    "page_share", "start", "last_text", "next_text", "parent_tag", "parent_share", "headings_before", "long_share", "parent_long", "parent_links",
)
WIDTH = len(TAGS) + 2 * len(GROUPS) + len(NUMBERS)


def features(dom: Dom) -> np.ndarray:
    """A row for each node: its tag, its and its ancestors' attribute tokens, and numbers of subtree and siblings."""
    n = len(dom.tag)
    chars, linked, signs, words, elements, paragraphs, long = ([0] * n for _ in range(7))
    children: list[list[int]] = [[] for _ in range(n)]
    above, depth = [0] * n, [0] * n
    for i in range(n):
        p = dom.parent[i]
        if p >= 0:
            children[p].append(i)
            above[i] = above[p] | dom.groups[p]
            depth[i] = depth[p] + 1
        t = dom.text[i]
        if t:
            chars[i], linked[i], signs[i], words[i] = len(t), dom.linked[i], len(_SIGNS.findall(t)), t.count(" ") + 1
            long[i] = len(t) if len(t) >= 80 else 0
    start, at = [0] * n, 0
    for i in range(n):
        start[i] = at
        at += chars[i]
    for i in range(n - 1, 0, -1):
        p = dom.parent[i]
        chars[p] += chars[i]
        linked[p] += linked[i]
        signs[p] += signs[i]
        words[p] += words[i]
        long[p] += long[i]
        elements[p] += elements[i] + (dom.tag[i] != "#text")
        paragraphs[p] += paragraphs[i] + (dom.tag[i] == "p")
    total, heading, seen = max(1, chars[0]), 0, [0] * n
    for i in range(n):
        seen[i] = heading
        heading += dom.tag[i] in TAGS["heading"]
    out = np.zeros((n, WIDTH), dtype=np.float32)
    g, base = len(GROUPS), len(TAGS)
    log = math.log1p
    for i in range(n):
        p = dom.parent[i]
        row = [0.0] * WIDTH
        code = _TAG_CODE.get(dom.tag[i])
        if code is not None:
            row[code] = 1.0
        for bits, at in ((dom.groups[i], base), (above[i], base + g)):
            while bits:
                low = bits & -bits
                row[at + low.bit_length() - 1] = 1.0
                bits ^= low
        c = chars[i]
        peers = children[p] if p >= 0 else [i]
        row[base + 2 * g] = log(c)
        if c:
            row[base + 2 * g + 1 : base + 2 * g + 4] = [linked[i] / c, 100 * signs[i] / c, c / max(1, words[i])]
        row[base + 2 * g + 4 : base + 2 * g + 9] = [log(elements[i]), c / (1 + elements[i]), log(paragraphs[i]), depth[i], 0.0]
        row[base + 2 * g + 9] = log(len(peers))
        row[base + 2 * g + 11 : base + 2 * g + 13] = [c / total, start[i] / total]
        row[base + 2 * g + 15] = _TAG_CODE.get(dom.tag[p], -1) if p >= 0 else -1
        row[base + 2 * g + 16] = c / max(1, chars[p]) if p >= 0 else 1.0
        row[base + 2 * g + 17] = min(3, seen[i])
        row[base + 2 * g + 18] = long[i] / c if c else 0.0
        if p >= 0 and chars[p]:
            row[base + 2 * g + 19 : base + 2 * g + 21] = [long[p] / chars[p], linked[p] / chars[p]]
        out[i] = row
    for kids in children:
        tags: dict[str, int] = {}
        for i in kids:
            tags[dom.tag[i]] = tags.get(dom.tag[i], 0) + 1
        for j, i in enumerate(kids):
            out[i, base + 2 * g + 8] = j / len(kids)
            out[i, base + 2 * g + 10] = log(tags[dom.tag[i]])
            out[i, base + 2 * g + 13] = log(chars[kids[j - 1]]) if j else -1
            out[i, base + 2 * g + 14] = log(chars[kids[j + 1]]) if j + 1 < len(kids) else -1
    return out


@dataclass
class BoostedTrees:
    """Complete trees of one depth: features and thresholds by level order, values of leaves."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out += v[node - (2**self.depth - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 5, rate: float = 0.2, bins: int = 32, l2: float = 2.0, part: float = 0.4) -> BoostedTrees:
    """Newton boosting for a log loss, with histograms of quantile bins over a part of the rows for each tree."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    n, m = x.shape
    rng = np.random.default_rng(5)
    start = float(np.log(y.mean() / (1 - y.mean())))
    score, flat = np.full(n, start), binned + np.arange(m) * bins
    inner, leaves = 2**depth - 1, 2**depth
    feature, threshold, value = np.zeros((trees, inner), dtype=np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    for k in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        used = rng.random(n) < part
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            for j in range(width):
                at = np.flatnonzero((node == first + j) & used)
                if len(at) < 20:
                    continue
                cells = flat[at].ravel()
                hg = np.bincount(cells, weights=np.repeat(g[at], m), minlength=m * bins).reshape(m, bins).cumsum(axis=1)
                hh = np.bincount(cells, weights=np.repeat(h[at], m), minlength=m * bins).reshape(m, bins).cumsum(axis=1)
                tg, th = hg[:, -1:], hh[:, -1:]
                gain = hg**2 / (hh + l2) + (tg - hg) ** 2 / (th - hh + l2) - tg**2 / (th + l2)
                gain[(hh < 0.5) | (th - hh < 0.5)] = 0
                f, b = np.unravel_index(int(gain.argmax()), gain.shape)
                if gain[f, b] > 1e-6 and b < len(edges[f]):
                    feature[k, first + j], threshold[k, first + j] = f, edges[f][b]
            f, t = feature[k][node], threshold[k][node]
            node = 2 * node + 1 + (x[np.arange(n), f] > t)
        leaf = node - inner
        value[k] = -rate * np.bincount(leaf, weights=g, minlength=leaves) / (np.bincount(leaf, weights=h, minlength=leaves) + l2)
        score += value[k][leaf]
    return BoostedTrees(start, feature, threshold.astype(np.float32), value, depth)


def decode(parents: list[int], scores: np.ndarray, has_text: list[bool]) -> list[bool]:
    """The set of nodes of the highest total score without contradictions.

    A kept node's parent is kept, and a kept element has a kept child, down to a block of text.
    """
    n = len(parents)
    gain, least, forced = [0.0] * n, [-math.inf] * n, [-1] * n  # of kept children; the best child and its score
    total = [0.0] * n
    for i in range(n - 1, -1, -1):
        if has_text[i]:
            total[i] = float(scores[i])
        else:
            total[i] = float(scores[i]) + (gain[i] if least[i] > 0 else least[i])
        if i:
            p = parents[i]
            gain[p] += max(0.0, total[i])
            if total[i] >= least[p]:
                least[p], forced[p] = total[i], i
    kept = [False] * n
    for i in range(n):
        p = parents[i]
        kept[i] = total[i] > 0 if p < 0 else kept[p] and (total[i] > 0 or forced[p] == i and total[i] > -math.inf)
    return kept


# --- training pages -------------------------------------------------------------------------

_SYLLABLES = "an ba che do el fi gra ho in ka lu men no or pa qui re sol ta un ver wi xa yo zen ér ña öt".split()


class _Pages:
    """Random pages with known main text."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.main: set[str] = set()
        self.count = 0

    def words(self, low: int, high: int) -> list[str]:
        return ["".join(self.r.choices(_SYLLABLES, k=self.r.randint(1, 4))) for _ in range(self.r.randint(low, high))]

    def sentence(self, low: int = 4, high: int = 16) -> str:
        return " ".join(self.words(low, high)).capitalize() + "."

    def prose(self, low: int = 1, high: int = 7) -> str:
        self.count += 1
        text = " ".join(self.sentence() for _ in range(self.r.randint(low, high)))
        if self.r.random() < 0.25:
            text = self.sentence(1, 4)
        x = self.r.random()
        if x < 0.04:
            text = text.upper()
        elif x < 0.12:
            text = " ".join(w if self.r.random() < 0.8 else self.r.choice(["%", "$", "/", "*", "#"]) + w for w in text.split())
        elif x < 0.16:
            text = text.replace(".", "")
        return f"{text} q{self.count}"

    def kept(self, text: str) -> str:
        self.main.add(text)
        return text

    def name(self, *names: str, chance: float = 0.85) -> str:
        if self.r.random() > chance:
            return self.r.choice(["", f' class="{self.words(1, 1)[0]}"', f' class="{self.utility()}"', f' data-{self.words(1, 1)[0]}="{self.r.randint(1, 99)}"'])
        n = self.r.choice(names)
        return f' {self.r.choice(["class", "id"])}="{n}{self.r.choice(["", "", "-wrap", "-inner", " " + self.utility()])}"'

    def utility(self) -> str:
        return " ".join(f"{self.r.choice(['col', 'row', 'mt', 'px', 'grid', 'block', 'is', 'js', 'u'])}-{self.r.randint(1, 12)}" for _ in range(self.r.randint(1, 3)))

    def links(self, low: int = 3, high: int = 9) -> str:
        self.count += 1
        return "".join(f'<li><a href="/{i}">{" ".join(self.words(1, 3))}</a>{self.r.choice(["</li>", "</li>", ""])}' for i in range(self.r.randint(low, high)))

    def menu(self) -> str:
        inner = f"<ul>{self.links()}</ul>"
        return self.r.choice([f"<nav>{inner}</nav>", f"<nav{self.name('main-nav', 'menu')}>{inner}</nav>", f"<div{self.name('nav', 'menu', 'navbar')}>{inner}</div>", f"<ul{self.name('nav', 'menu', 'breadcrumbs')}>{self.links()}</ul>"])

    def ad(self) -> str:
        body = self.r.choice([self.prose(1, 3), self.sentence(), f'<p>{self.prose(1, 2)}</p><a href="/buy">{self.sentence(2, 4)}</a>'])
        return self.r.choice([f'<div class="{self.r.choice(["ad", "ads", "advert", "ad-slot", "sponsored", "promo", "advertisement"])}">{body}</div>', f'<aside class="ad">{body}</aside>', f'<section class="sponsor">{body}</section>'])

    def side(self) -> str:
        body = self.r.choice([f"<h3>{self.sentence(1, 3)}</h3><ul>{self.links()}</ul>", f"<p>{self.prose(1, 3)}</p>", f"<h4>{self.sentence(1, 3)}</h4><p>{self.prose(1, 2)}</p><ul>{self.links()}</ul>", self.prose(1, 2)])
        return self.r.choice([f"<aside>{body}</aside>", f"<aside{self.name('sidebar', 'widget')}>{body}</aside>", f'<div class="{self.r.choice(["sidebar", "side", "widget", "related", "recommended"])}">{body}</div>'])

    def notice(self) -> str:
        body = self.r.choice([f"<p>{self.prose(1, 2)}</p><button>{self.sentence(1, 2)}</button>", self.prose(1, 2), f'{self.prose(1, 1)} <a href="/p">{self.sentence(1, 2)}</a>'])
        return f'<{(t := self.r.choice(["div", "div", "section", "aside", "dialog"]))} class="{self.r.choice(["cookie-notice", "cookie-banner", "consent", "notice", "newsletter", "gdpr", "popup", "alert", "subscribe"])}">{body}</{t}>'

    def form(self) -> str:
        return f'<form{self.name("search", "login", "contact", "newsletter")}><p>{self.prose(1, 1)}</p><label>{self.sentence(1, 3)}</label><input name="q"><select><option>{self.sentence(1, 2)}</option></select><button>{self.sentence(1, 2)}</button></form>'

    def share(self) -> str:
        return f'<div class="{self.r.choice(["share", "social", "share-buttons", "tags", "byline"])}">' + self.r.choice([f"<ul>{self.links(2, 5)}</ul>", self.sentence(2, 5), f'<a href="/s">{self.sentence(1, 2)}</a> <a href="/t">{self.sentence(1, 2)}</a>']) + "</div>"

    def comments(self) -> str:
        one = lambda: self.r.choice([f"<p>{self.prose(1, 5)}</p>", f"<b>{self.words(1, 1)[0]}</b><p>{self.prose(1, 4)}</p>", self.prose(1, 4)])
        k = self.r.randint(1, 6)
        c = self.r.choice(["comments", "comment-list", "replies", "comments-area", "discussion"])
        return self.r.choice([
            f'<div class="{c}"><h3>{self.sentence(1, 3)}</h3>' + "".join(f'<div class="comment">{one()}</div>' for _ in range(k)) + "</div>",
            f'<section id="{c}">' + "".join(f"<article class=\"comment\">{one()}</article>" for _ in range(k)) + "</section>",
            f'<ol class="{c}">' + "".join(f"<li>{one()}</li>" for _ in range(k)) + "</ol>",
            f'<section class="{c}">' + "".join(f"<p>{self.prose(1, 4)}</p>" for _ in range(k)) + "</section>",
            f'<ul class="{c}">' + "".join(f"<li>{self.prose(1, 3)}</li>" for _ in range(k)) + "</ul>",
        ])

    def footer(self) -> str:
        body = self.r.choice([f"&copy; {self.words(1, 2)[0]} &middot; {self.prose(1, 2)}", f"<p>{self.prose(1, 2)}</p>", f"<ul>{self.links()}</ul><p>&copy; {self.sentence(2, 5)}</p>"])
        return self.r.choice([f"<footer>{body}</footer>", f"<footer{self.name('footer', 'site-footer')}>{body}</footer>", f'<div class="{self.r.choice(["footer", "foot", "copyright"])}">{body}</div>'])

    def header(self) -> str:
        body = self.r.choice([f'<a href="/">{self.sentence(1, 3)}</a>', f"<h1>{self.sentence(1, 3)}</h1><p>{self.prose(1, 1)}</p>", f"<p>{self.sentence(2, 6)}</p>", f"{self.sentence(1, 4)}<nav><ul>{self.links()}</ul></nav>"])
        return self.r.choice([f"<header>{body}</header>", f"<header{self.name('site-header', 'masthead')}>{body}</header>", f'<div class="{self.r.choice(["header", "topbar", "masthead"])}">{body}</div>'])

    def paragraph(self) -> str:
        x = self.r.random()
        text = self.kept(self.prose())
        if x < 0.62:
            return f"<p>{text}{self.r.choice(['</p>', '</p>', '</p>', ''])}"
        if x < 0.70:
            return f"<p><b>{text}<br>"
        if x < 0.76:
            first, _, rest = text.partition(" ")
            return f'<p><a href="/x">{first}</a> {rest}</p>' if rest else f"<p>{text}</p>"
        if x < 0.82:
            return f"<h{(n := self.r.randint(2, 4))}>{self.kept(self.sentence(2, 7)[:-1] + f' h{self.count}')}</h{n}><p>{text}</p>"
        if x < 0.87:
            return f"<blockquote>{text}</blockquote>" if self.r.random() < 0.5 else f"<blockquote><p>{text}</p></blockquote>"
        if x < 0.93:
            return f"<{(t := self.r.choice(['ul', 'ol']))}>" + "".join(f"<li>{self.kept(self.prose(1, 2))}</li>" for _ in range(self.r.randint(2, 5))) + f"</{t}><p>{text}</p>"
        if x < 0.96:
            return f'<figure><img src="a.png"><figcaption>{self.kept(self.prose(1, 1))}</figcaption></figure><p>{text}</p>'
        return f"<div>{text}</div>"

    def page(self) -> tuple[str, set[str]]:
        self.main = set()
        r = self.r
        title = self.sentence(1, 9)[:-1] + f" t{self.count}."
        parts: list[str] = []
        inside = r.random()
        if inside < 0.75:
            parts.append(f"<h1>{self.kept(title)}</h1>")
        elif inside < 0.85:
            parts.append(f'<header><h1>{self.kept(title)}</h1></header>')
        size = r.choice([1, 2, 4, 8, 16, 30])
        for _ in range(r.randint(1, size)):
            parts.append(self.paragraph())
            if r.random() < 0.06:
                parts.append(r.choice([self.ad, self.notice, self.side, self.share, self.form])())
        if r.random() < 0.55:
            self.count += 1
            parts.append(f"<p>{self.kept(self.sentence(1, r.choice([2, 8]))[:-1] + f's{self.count}.')}</p>")
        body = "".join(parts)
        wrap = r.random()
        if wrap < 0.3:
            body = f"<article>{body}</article>"
        elif wrap < 0.4:
            body = f"<main><article{self.name('post', 'story')}>{body}</article></main>"
        elif wrap < 0.5:
            body = f"<main>{body}</main>"
        elif wrap < 0.75:
            body = f"<div{self.name('content', 'post', 'entry-content', 'article-body', 'main', 'story-text')}>{body}</div>"
        elif wrap < 0.83:
            body = f"<div><section{self.name('content', 'post-body', chance=0.6)}>{body}</section></div>"
        elif wrap < 0.87:
            side = f"<td{self.name('side', 'menu', chance=0.5)}><ul>{self.links()}</ul></td>"
            cells = [side, f"<td>{body}</td>"]
            body = f"<table><tr>{''.join(r.sample(cells, 2))}</tr></table>"
        above = [f() for f, c in ((self.notice, 0.25), (self.header, 0.45), (self.menu, 0.7), (self.form, 0.15), (self.ad, 0.45)) if r.random() < c]
        if len(above) > 1 and r.random() < 0.4:
            r.shuffle(above)
        below = [f() for f, c in ((self.share, 0.25), (self.ad, 0.25), (self.comments, 0.45), (self.side, 0.45), (self.form, 0.2), (self.menu, 0.15), (self.notice, 0.15)) if r.random() < c]
        if r.random() < 0.4:
            r.shuffle(below)
        if r.random() < 0.75:
            below.append(self.footer())
        if r.random() < 0.08:  # nothing but the article
            above, below = [], []
        whole = "".join(above) + body + "".join(below)
        if r.random() < 0.3:
            whole = f"<div{self.name('page', 'wrapper', 'container')}>{whole}</div>"
        head = f"<title>{self.sentence()}</title>" + r.choice(["", f"<meta name=author content='{self.words(1, 1)[0]}'>", f"<style>.{self.words(1, 1)[0]} {{ color: #{r.randint(100, 999)} }}</style>"])
        script = r.choice(["", f"<script>window.{self.words(1, 1)[0]} = [{r.randint(0, 9)}];</script>", "<script async src='/s.js'></script>"])
        start = r.choice(["<!DOCTYPE html>", "<!doctype html>\n", ""])
        shell = r.random()
        if shell < 0.7:
            return f"{start}<html{r.choice(['', ' lang=xx'])}><head>{head}</head><body>{whole}{script}{r.choice(['</body></html>', '</body></html>', ''])}", self.main
        if shell < 0.8:
            return f"{start}<html><head>{head}<body>{whole}{script}</html>", self.main
        if shell < 0.9:
            return f"{start}<html><head>{head}{script}{whole}", self.main
        return f"{start}{head}{whole}{script}", self.main


def training_rows(pages: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    maker, xs, ys = _Pages(seed), [], []
    for _ in range(pages):
        page, main = maker.page()
        dom = parse(page)
        wanted = [bool(t) and t in main for t in dom.text]
        for i in range(len(wanted) - 1, 0, -1):
            wanted[dom.parent[i]] |= wanted[i]
        xs.append(features(dom))
        ys.append(wanted)
    return np.concatenate(xs), np.concatenate([np.array(y, dtype=float) for y in ys])


#: Generated pages that the trees are fitted on.
TRAINING_PAGES = 1800


@lru_cache(maxsize=2)
def fitted(pages: int = TRAINING_PAGES, seed: int = 11) -> BoostedTrees:
    return boost(*training_rows(pages, seed))


def extract(pages: list[str | None], model: BoostedTrees) -> list[str]:
    doms = [parse(p) if p else Dom() for p in pages]
    rows = [features(d) for d in doms if d.tag]
    if not rows:
        return [""] * len(pages)
    scores, at, out = model.score(np.concatenate(rows)), 0, []
    for d in doms:
        n = len(d.tag)
        kept = decode(d.parent, scores[at : at + n], list(map(bool, d.text))) if n else []
        at += n
        out.append("\n".join(t for t, k in zip(d.text, kept, strict=True) if t and k))
    return out


def extract_main_text(pages: DataFrame, model: BoostedTrees | None = None, html_column: str = "html") -> DataFrame:
    """Every row of ``pages`` without its html, with ``text`` and ``n_chars`` (code points).

    Blocks of the kept nodes come in page order, joined by newlines; character references
    are decoded and white space inside a block is one space. A null, empty or blank html, and
    one without an article, gives an empty text. Broken and cut-off markup is read as far
    as it goes. Columns named text and n_chars are replaced. No shuffle; a task holds a batch.
    """
    ship(pages.sparkSession)
    held = pages.sparkSession.sparkContext.broadcast(fitted() if model is None else model)
    keep = without(pages, *({"text", "n_chars"} - {html_column.lower()}))
    names = [c for c in keep.columns if c.lower() != html_column.lower()]
    ready = keep.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.col(f"`{html_column}`").alias("h"))

    def run(batch):
        texts: list[str] = []
        raw = batch.column("h").to_pylist()
        for i in range(0, len(raw), 200):
            texts += extract(raw[i : i + 200], held.value)
        return {f"c{i}": batch.column(f"c{i}") for i in range(len(names))} | {"text": texts, "n_chars": list(map(len, texts))}

    kinds = dict(ready.dtypes)
    out = map_batches(ready, run, "".join(f"c{i} {kinds[f'c{i}']}, " for i in range(len(names))) + "text string, n_chars long")
    return out.toDF(*names, "text", "n_chars")
