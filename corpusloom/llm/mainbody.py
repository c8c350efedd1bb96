"""Main text of web pages by a recurrent block labeller (operator 6).

A page becomes its sequence of leaf blocks: runs of text between block-level
tags. Each block is a vector of the tags of all its ancestors and of their class,
id and role words (hashed), of all its own words (hashed), and a few figures
(length, share of linked text, place). A numpy bidirectional LSTM reads the
whole sequence and labels every block as article or not, so the context of the
document decides. It is trained here, on pages made from rules with menus,
notices, forms, adverts and threads of reader comments of any length and many
forms (PAGES of them, a fixed bound); no weights are stored.

Blocks: character references are decoded, white space inside a block becomes one
space, ends are trimmed, empty blocks go; `br` is white space. Scripts, styles,
the head, comments, templates and form controls are no text. A page is read in
time proportional to its length, whatever is unclosed in it: a quoted value that
never ends makes the tags from there on end at the first `>`; a `<` without an
end before the next one is text; a comment or script that never ends hides the rest.

Cases: null, empty or tagless html (tagless text is one block) never fail;
unclosed and misnested tags are closed by their parents; null page_id or url are
passed on; repeated rows give equal rows; an empty table gives none; extra columns
are passed over; pages of any length (the labeller runs over the whole sequence,
STRETCH blocks at a time, and carries its states on).
"""

from __future__ import annotations

import functools
import html as entities
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table

PATH_DIM, WORD_DIM, FIGURES, HIDDEN, STEM = 128, 32, 8, 20, 5
PAGES, EPOCHS, SEED, STRETCH, TOGETHER = 1800, 14, 3, 400, 64
MANY = 12  # different path words from which on their sum is scaled down

# Fixed values of HTML: elements that break a line of text, that have no end tag, whose content is no text, and that end an open <p>.
BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption legend option select".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("script style template noscript head textarea select svg math iframe object canvas audio video button title".split())
RAW = set("script style textarea title iframe noscript".split())

#: Tags with a place of their own on the way down; others, leaf tags and names share the hashed places.
_PLACES = {f"t:{tag}": i for i, tag in enumerate(sorted(BLOCK | set("a abbr b big cite code em font i label mark small span strong sub sup time u".split())))}
DOWN = len(_PLACES) + PATH_DIM
DIM = DOWN + WORD_DIM + FIGURES

_TAG = re.compile(r"</?([A-Za-z][A-Za-z0-9:-]*)")
_VALUE = re.compile(r"[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+")
_PLAIN = re.compile(r"[^<>]*")
_NAMES = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORDS = re.compile(r"[^\W_]+")
_SPACE = re.compile(r"\s+")
_RAW_END = {tag: re.compile(f"</{tag}", re.I | re.A) for tag in RAW}


class Path:
    """An open element below its parents. `sum` adds up the vectors of all different words on the way down; `count` is their number."""

    __slots__ = ("tag", "words", "sum", "count", "depth", "kids", "vector")

    def __init__(self, tag: str, words: tuple[str, ...], above: np.ndarray, new: list[str], count: int, depth: int):
        self.tag, self.words, self.count, self.depth, self.kids, self.vector = tag, words, count, depth, {}, None
        self.sum = above
        if new:
            self.sum = above.copy()
            for w in new:
                _add(self.sum, w, 1.0)


@dataclass
class Block:
    text: str
    path: Path
    linked: int


@functools.lru_cache(1 << 16)
def _slot(word: str, n: int) -> int:
    """A place below n, or the same plus n for the negative sign."""
    h = zlib.crc32(word.encode("utf-8", "replace"))
    return h % n + (0 if h >> 20 & 1 else n)


def _add(to: np.ndarray, word: str, weight: float) -> None:
    at = _PLACES.get(word)
    if at is not None:
        to[PATH_DIM + at] += weight
        return
    at = _slot(word, PATH_DIM)
    to[at % PATH_DIM] += weight if at < PATH_DIM else -weight


def _path_words(tag: str, names: str) -> tuple[str, ...]:
    """The words of an element: its tag, those of its class, id and role, and the first letters of long ones."""
    found = _WORDS.findall(names)
    return tuple(dict.fromkeys(["t:" + tag, *("c:" + w for w in found), *("s:" + w[:STEM] for w in found if len(w) > STEM)]))


class _Parser:
    """Reads a page in one pass: every step is bounded by what it consumes, or by what it closes."""

    def __init__(self):
        self.out: list[Block] = []
        self.root = Path("", (), np.zeros(DOWN, np.float32), [], 0, 0)
        self.stack: list[Path] = [self.root]
        self.blocks = [0]  # places on the stack of open block elements
        self.where: dict[str, list[int]] = {}
        self.open: Counter[str] = Counter()
        self.parts: list[str] = []
        self.linked = self.silent = self.links = 0

    def flush(self) -> None:
        if self.parts:
            text = _SPACE.sub(" ", "".join(self.parts)).strip()
            if text:
                self.out.append(Block(text, self.stack[-1], min(self.linked, len(text))))
            self.parts.clear()
        self.linked = 0

    def say(self, text: str) -> None:
        if text and not self.silent:
            text = entities.unescape(text) if "&" in text else text
            self.parts.append(text)
            if self.links:
                self.linked += len(text)

    def last(self, *tags: str) -> int:
        """Place of the innermost open element of these tags, or 0."""
        found = 0
        for t in tags:
            if (places := self.where.get(t)) and places[-1] > found:
                found = places[-1]
        return found

    def close(self, i: int) -> None:
        for node in reversed(self.stack[i:]):
            self.where[node.tag].pop()
            self.silent -= node.tag in SILENT
            self.links -= node.tag == "a"
            if node.tag in BLOCK:
                self.blocks.pop()
            for w in node.words:
                self.open[w] -= 1
        del self.stack[i:]

    def push(self, tag: str, names: str) -> None:
        up = self.stack[-1]
        node = up.kids.get((tag, names))
        if node is None:
            own = _path_words(tag, names)
            new = [w for w in own if not self.open[w]]
            node = up.kids[tag, names] = Path(tag, own, up.sum, new, up.count + len(new), up.depth + 1)
        self.where.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCK:
            self.blocks.append(len(self.stack))
        for w in node.words:
            self.open[w] += 1
        self.silent += tag in SILENT
        self.links += tag == "a"
        self.stack.append(node)

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.say(" ")
            return
        if tag in BLOCK:
            self.flush()
            if i := self.last("head"):
                self.close(i)
            i = self.last("p")
            if i and self.blocks[-1] == i:
                self.close(i)
            if tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                ends = ("tr", "td", "th") if tag == "tr" else ("td", "th") if tag in ("td", "th") else ("dt", "dd") if tag in ("dt", "dd") else (tag,)
                stops = ("ul", "ol", "dl", "table", "menu") + (("tr",) if tag in ("td", "th") else ())
                stop = self.last(*stops)
                while (i := self.last(*ends)) > stop:
                    self.close(i)
        if tag in VOID or attributes.endswith("/") and tag not in BLOCK:
            return
        names = " ".join(x or y or z for x, y, z in _NAMES.findall(attributes)).lower() if attributes else ""
        self.push(tag, names)

    def end(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
        i = self.last(tag)
        if i and (tag in BLOCK or i > self.blocks[-1]):  # an inline end tag closes nothing outside its block
            self.close(i)

    def read(self, page: str) -> list[Block]:
        at, size, quotes, cdata = 0, len(page), True, True
        while at < size:
            here = page.find("<", at)
            if here < 0:
                break
            self.say(page[at:here])
            at = here
            if page.startswith("<!--", at):
                end = page.find("-->", at + 2)
                at = size if end < 0 else end + 3
                continue
            if cdata and page.startswith("<![CDATA[", at):
                end = page.find("]]>", at)
                if end >= 0:
                    self.say(page[at + 9 : end].replace("&", "&amp;"))
                    at = end + 3
                    continue
                cdata = False  # none ends any more
            m = _TAG.match(page, at)
            if not m:
                if page.startswith(("<!", "<?", "</"), at):  # a comment of another form; "</" and no name as well
                    stop = _PLAIN.match(page, at + 1).end()
                    if stop < size and page[stop] == ">":
                        at = stop + 1
                        continue
                self.say("<")
                at += 1
                continue
            stop = _VALUE.match(page, m.end()).end() if quotes else size
            if stop >= size or page[stop] != ">":  # a quote is never closed: from here on tags end at the first >, quoted or not
                quotes = False
                stop = _PLAIN.match(page, m.end()).end()
                if stop >= size or page[stop] != ">":
                    if stop < size:  # no tag
                        self.say(page[at:stop])
                    at = stop
                    continue
            tag, attributes = m[1].lower(), page[m.end() : stop]
            at = stop + 1
            if page[here + 1] == "/":
                self.end(tag)
                continue
            self.start(tag, attributes)
            if tag in RAW:
                end = _RAW_END[tag].search(page, at)
                at = size if end is None else end.start()
        self.say(page[at:])
        self.flush()
        return self.out


def blocks(page: str) -> list[Block]:
    """Leaf blocks of a page in order, in time proportional to its length."""
    return _Parser().read(page)


def _path_vector(path: Path) -> np.ndarray:
    """The sum of the words of all ancestors, scaled down from MANY different words on, and the tag of the innermost."""
    if path.vector is None:
        path.vector = path.sum * np.float32((MANY / max(MANY, path.count)) ** 0.5)
        _add(path.vector, "leaf:" + path.tag, 1.0)
    return path.vector


@functools.lru_cache(1 << 16)
def _word_slot(word: str) -> int:
    return _slot("w:" + word, WORD_DIM)


def _word_vectors(texts: list[str]) -> np.ndarray:
    """Per text all words, repeated ones by the logarithm, at a length of 1 for four different words or more."""
    slots, counts, sizes = [], [], []
    for text in texts:
        words = Counter(_WORDS.findall(text.lower()))
        slots.extend(map(_word_slot, words))
        counts.extend(words.values())
        sizes.append(len(words))
    own, weights = np.repeat(np.arange(len(texts)), sizes), 1 + np.log(np.array(counts, float))
    found = np.bincount(own * 2 * WORD_DIM + np.array(slots, np.int64), weights, len(texts) * 2 * WORD_DIM).reshape(-1, 2 * WORD_DIM)
    lengths = np.bincount(own, weights**2, len(texts))
    return (found[:, :WORD_DIM] - found[:, WORD_DIM:]) / np.sqrt(np.maximum(4, lengths))[:, None]


def vectors(page: list[Block]) -> np.ndarray:
    out = np.zeros((len(page), DIM), np.float32)
    if not page:
        return out
    out[:, DOWN : DOWN + WORD_DIM] = _word_vectors([b.text for b in page])
    figures = []
    for k, b in enumerate(page):
        out[k, :DOWN] = _path_vector(b.path)
        n, t = len(b.text), b.text
        figures.append((b.linked / n, (t.count(".") + t.count("!") + t.count("?")) / max(1, n / 400) / 4, n, b.path.depth))
    linked, marks, n, depth = np.array(figures).T
    place = np.arange(len(page))
    out[:, DOWN + WORD_DIM :] = np.stack([np.log1p(n) / 5, linked, n > 80, marks, place / len(page), place == 0, place == len(page) - 1, np.log1p(depth) / 2], 1)
    return out


class BiLstm:
    """A bidirectional LSTM with a logistic output per step. Arrays are (step, direction, page, ...); sequences are padded and masked."""

    def __init__(self, rng: np.random.Generator):
        init = lambda *s: (rng.standard_normal(s) / np.sqrt(s[-2])).astype(np.float32)
        self.p = {"W": init(2, DIM, 4 * HIDDEN), "U": init(2, HIDDEN, 4 * HIDDEN), "c": np.zeros((2, 1, 4 * HIDDEN), np.float32), "o": init(2 * HIDDEN, 1), "k": np.zeros(1, np.float32)}
        self.p["c"][..., HIDDEN : 2 * HIDDEN] = 1

    def run(self, z: np.ndarray, mask: np.ndarray, u: np.ndarray, h: np.ndarray, c: np.ndarray, keep: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Outputs per step and last states, from the inputs' part z of the gates and the states h and c on; z is used up."""
        out = np.empty((*z.shape[:3], HIDDEN), np.float32)
        for s in range(len(z)):
            a = z[s]
            a += h @ u
            a[..., : 3 * HIDDEN] *= 0.5
            np.tanh(a, out=a)
            a[..., : 3 * HIDDEN] = 0.5 * a[..., : 3 * HIDDEN] + 0.5
            i, f, o, v = (a[..., k * HIDDEN : (k + 1) * HIDDEN] for k in range(4))
            cell = f * c + i * v
            q = np.tanh(cell)
            if keep is not None:
                keep.append((h, c, q))
            m = mask[s]
            h, c = np.where(m, o * q, h), np.where(m, cell, c)
            out[s] = h
        return out, h, c

    def inputs(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both directions' part of the gates from x (step, page, DIM), the second one back to front."""
        return np.stack([x @ self.p["W"][0], x[::-1] @ self.p["W"][1]], 1) + self.p["c"], np.stack([mask, mask[::-1]], 1)[..., None]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        keep: list = []
        z, m = self.inputs(x, mask)
        zero = np.zeros((2, x.shape[1], HIDDEN), np.float32)
        out = self.run(z, m, self.p["U"], zero, zero, keep)[0]
        h = np.concatenate([out[:, 0], out[::-1, 1]], 2)
        s = 1 / (1 + np.exp(-np.clip((h @ self.p["o"])[..., 0] + self.p["k"], -30, 30)))
        e = ((s - y) * mask / mask.sum()).astype(np.float32)
        both = e[..., None] * self.p["o"][:, 0]
        down = np.stack([both[..., :HIDDEN], both[::-1, :, HIDDEN:]], 1)
        dz, du, back = np.empty_like(z), np.zeros_like(self.p["U"]), self.p["U"].transpose(0, 2, 1)
        dh, dc = zero, zero
        for t in range(len(z) - 1, -1, -1):
            h0, c0, q = keep[t]
            i, f, o, v = (z[t][..., k * HIDDEN : (k + 1) * HIDDEN] for k in range(4))
            dh = dh + down[t]
            own = dh * m[t]
            cell = dc * m[t] + own * o * (1 - q * q)
            a = dz[t]
            a[..., :HIDDEN], a[..., HIDDEN : 2 * HIDDEN] = cell * v * i * (1 - i), cell * c0 * f * (1 - f)
            a[..., 2 * HIDDEN : 3 * HIDDEN], a[..., 3 * HIDDEN :] = own * q * o * (1 - o), cell * i * (1 - v * v)
            du += h0.transpose(0, 2, 1) @ a
            dh, dc = np.where(m[t], a @ back, dh), np.where(m[t], cell * f, dc)
        flat = lambda w: w.reshape(-1, w.shape[-1])
        dw = np.stack([flat(x).T @ flat(dz[:, 0]), flat(x[::-1]).T @ flat(dz[:, 1])])
        return {"U": du, "W": dw, "c": dz.sum((0, 2))[:, None], "o": flat(h).T @ flat(e[..., None]), "k": e.sum(keepdims=True).reshape(1)}

    def fit(self, groups: list[tuple[np.ndarray, np.ndarray, np.ndarray]], epochs: int, rng: np.random.Generator) -> None:
        """Adam over groups of pages, each as `padded` makes it."""
        m, v, t = {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}, 0
        for epoch in range(epochs):
            for g in rng.permutation(len(groups)):
                t += 1
                for k, d in self.gradients(*groups[g]).items():
                    d = np.clip(d, -1, 1)
                    m[k], v[k] = 0.9 * m[k] + 0.1 * d, 0.999 * v[k] + 0.001 * d * d
                    self.p[k] = (self.p[k] - 0.012 * 0.1 ** max(0.0, 2 * epoch / epochs - 1) * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)


def padded(pages: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors (step, page, DIM), mask and labels of pages."""
    t = max((len(x) for x, _ in pages), default=0)
    x, mask, y = np.zeros((t, len(pages), DIM), np.float32), np.zeros((t, len(pages)), bool), np.zeros((t, len(pages)), np.float32)
    for i, (a, b) in enumerate(pages):
        x[: len(a), i], mask[: len(a), i], y[: len(b), i] = a, True, b
    return x, mask, y


# --- training pages --------------------------------------------------------

_CHROME = {
    "menu": "menu nav navbar navigation topnav main-nav site-nav breadcrumb breadcrumbs tabs pagination pager toc".split(),
    "header": "header masthead top topbar site-header banner logo branding".split(),
    "footer": "footer bottom site-footer copyright colophon legal credits".split(),
    "sidebar": "sidebar side aside widget rail secondary related recommended popular trending archive tags".split(),
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay message disclaimer paywall".split(),
    "advert": "ad ads advert advertisement sponsor sponsored promo banner-ad adsbygoogle".split(),
    "form": "form search newsletter subscribe signup login contact".split(),
    "comments": "comments comment replies discussion respond comment-list reader-comments disqus commentlist comments-area thread feedback responses user-comments".split(),
    "share": "share social sharing follow buttons author-box byline meta".split(),
}
_SAID = {
    "comments": ["Comments", "Leave a reply", "Discussion", "Responses", "Reader comments", "Join the conversation"],
    "footer": ["All rights reserved", "Privacy policy", "Terms of use", "Imprint", "Contact us"],
    "notice": ["We use cookies", "Accept all", "Please log in", "This site uses cookies to improve your experience"],
    "share": ["Share this", "Tweet", "Print", "Follow us"],
    "sidebar": ["Related articles", "Most read", "Archive", "Recent posts", "Tags"],
    "form": ["Subscribe to our newsletter", "Search", "Your email address", "Sign up"],
    "advert": ["Advertisement", "Sponsored", "Buy now"],
    "menu": ["Home", "About", "News", "Contact", "Sport", "Culture"],
    "header": ["Skip to content", "Log in", "Search"],
}
_UTILITIES = "col-xs-{} col-sm-{} col-md-{} col-lg-{} px-{} py-{} mt-{} mb-{} w-{} gap-{} z-{} order-{} d-flex flex row grid block relative absolute container wrapper inner clearfix hidden-xs text-sm text-left bg-white border rounded shadow justify-between items-center".split()
_CONTAINERS = ["<article>", "<main>", '<div class="content">', '<div class="post">', '<div id="main">', '<div class="article-body">', '<div class="entry-content">', '<section class="story">', '<main><article>', '<div class="text">', '<div role="main">', "<div>", '<div id="content"><article>', '<article class="post">', '<section><article class="article">', "<section>", ""]


def training_page(rng: np.random.Generator) -> tuple[str, list[bool]]:
    """A page and, for each of its blocks in order, whether it belongs to the article."""
    fast = random.Random(int(rng.integers(1 << 32)))
    syllables = [fast.choice("bcdfghklmnprstvz") + fast.choice("aeiou") + fast.choice(["", "n", "r", "s", "t"]) for _ in range(40)]
    word = lambda: "".join(fast.choices(syllables, k=fast.randint(1, 3)))
    said = lambda n: " ".join(word() for _ in range(n)).capitalize()
    out, truth = [], []
    # Lists of any length from 1 on, short ones oftener; on many pages all stay short.
    most = fast.choice([8, 8, 8, 30, 60, 120, 240])
    many = lambda top=1.0: int(np.exp(fast.uniform(0, np.log(max(2, most * top) + 1))))

    def put(text: str, main: bool, tag: str = "p", link: bool = False):
        out.append(f"<{tag}>" + (f'<a href="/x">{text}</a>' if link else text) + (f"</{tag}>" if fast.random() < 0.97 else ""))
        truth.append(main)

    def prose() -> str:
        """Sentences, as articles and comments have them alike."""
        return ". ".join(said(int(n)) for n in fast.choices([2, 5, 9, 15, 30], k=fast.randint(1, 4))) + "."

    long_lists, deep = fast.random() < 0.3, fast.random() < 0.3

    def utilities() -> str:
        return " ".join(str(u).format(fast.randrange(1, 13)) for u in fast.choices(_UTILITIES, k=fast.randint(1, 12)))

    def named(tags: str) -> str:
        """Opening tags, with layout classes before their own on pages that have such."""
        add = lambda m: f'<{m[1]}' + (m[2].replace('class="', f'class="{utilities()} ') if "class=" in m[2] else f' class="{utilities()}"{m[2]}') + ">"
        return re.sub(r"<(\w+)([^>]*)>", add, tags) if long_lists else tags

    def wrappers() -> int:
        """Opens so many nested containers without names of their own."""
        n = fast.randrange(1, 25) if deep and fast.random() < 0.5 else 0
        out.append("".join(named("<div>") for _ in range(n)))
        return n

    def thread():
        """Reader comments in one of many forms, all alike but for authors, replies and second paragraphs."""
        item = fast.choice(["", "", '<div class="comment">', "<li>", '<li class="comment">', "<article>", '<div class="reply">', "<div>"])
        tag = fast.choice(["p", "p", "p", "div", "blockquote", "span"] if item else ["p", "p", "div", "li"])
        authors, answers, whole = fast.random() < 0.3, fast.random() < 0.3, fast.random() < 0.5
        listed = item.startswith("<li") or tag == "li"
        out.append(fast.choice(["<ul>", "<ol>", '<ol class="children">']) if listed and fast.random() < 0.7 else "")
        for _ in range(many()):
            out.append(item)
            if authors:
                put(said(fast.randrange(1, 3)), False, fast.choice(["div", "h4", "footer", "cite"]) if item else "h4", fast.random() < 0.3)
            for _ in range(1 if whole or fast.random() < 0.8 else fast.randrange(2, 4)):
                put(prose() if fast.random() < 0.8 else said(fast.randrange(1, 6)), False, tag if item or tag != "span" else "p")
                if tag == "span":
                    out.append("<hr>")
            if answers:
                put(fast.choice(["Reply", "Report", "Like"]), False, "div", True)
            out.append("".join(f"</{t}>" for t in re.findall(r"<(\w+)", item)))
        out.append("</ul></ol>" if listed else "")

    def chrome(kind: str):
        name = fast.choice(_CHROME[kind])
        attr = f' {fast.choice(["class", "class", "id"])}="{name}{fast.choice(["", "", " box", " c" + str(fast.randrange(99))])}"'
        tag = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form", "comments": "section"}.get(kind, "div")
        listed = kind == "comments" and fast.random() < 0.3
        if listed:
            tag = fast.choice(["ul", "ol"])
        elif fast.random() < 0.35:
            tag = fast.choice(["div", "div", "section"])
        elif fast.random() < 0.6 and tag not in ("div", "section"):
            attr = ""
        out.append(named(f"<{tag}{attr}>"))
        inside = wrappers() if not listed else 0
        if kind == "menu" or kind in ("sidebar", "header", "share", "footer") and fast.random() < 0.4:
            out.append("<ul>" if (bare := fast.random() < 0.8) else "")
            equal = said(fast.randrange(1, 4)) if fast.random() < 0.1 else ""
            for _ in range(many() if fast.random() < 0.8 else 1):
                put(equal or (fast.choice(_SAID[kind]) if fast.random() < 0.1 else said(fast.randrange(1, 8))), False, "li" if bare else "div", True)
            out.append("</ul>" if bare else "")
        elif kind == "comments":
            if fast.random() < 0.5 and not listed:
                put(fast.choice(_SAID[kind]) if fast.random() < 0.6 else said(2), False, fast.choice(["h2", "h3"]))
            thread()
        else:
            if fast.random() < 0.3:
                put(fast.choice(_SAID[kind]) if fast.random() < 0.5 else said(2), False, fast.choice(["h2", "h3", "h4"]))
            for _ in range(1 if fast.random() < 0.6 else many(0.2)):
                text = prose() if fast.random() < 0.2 else said(fast.randrange(1, 22)) + ("." if fast.random() < 0.6 else "")
                text = f"&copy; {text}" if kind == "footer" and fast.random() < 0.6 else fast.choice(_SAID[kind]) if fast.random() < 0.1 else text
                if fast.random() < 0.35:
                    out.append(text)
                    out.append("<hr>")
                    truth.append(False)
                else:
                    put(text, False, fast.choice(["p", "div", "label" if kind == "form" else "p"]) if kind != "form" else "p", fast.random() < 0.25)
        out.append("</div>" * inside + f"</{tag}>")

    around = wrappers()
    for kind in ("notice", "header", "menu", "advert", "form", "sidebar"):
        if fast.random() < (0.65 if kind == "menu" else 0.35):
            chrome(kind)
    start = fast.choice(_CONTAINERS)
    out.append(named(start))
    inside = wrappers()
    if fast.random() < 0.75:
        put(said(fast.randrange(3, 10)), True, fast.choice(["h1", "h1", "h2"]))
    if fast.random() < 0.12:
        chrome("share")
    for _ in range(many(0.7) if fast.random() < 0.8 else 1):
        roll = fast.random()
        if roll < 0.07:
            put(said(fast.randrange(1, 6)), True, fast.choice(["h2", "h3"]))
        elif roll < 0.12:
            out.append("<ul>")
            for _ in range(many(0.3)):
                put(said(fast.randrange(2, 15)), True, "li")
            out.append("</ul>")
        elif roll < 0.15:
            put(said(fast.randrange(5, 30)), True, "blockquote")
        elif roll < 0.17:
            out.append("<table><tr>")
            for _ in range(fast.randrange(2, 5)):
                put(said(fast.randrange(1, 4)), True, "td")
            out.append("</tr></table>")
        elif roll < 0.2:
            chrome(fast.choice(["advert", "form", "share", "sidebar", "notice"]))
        else:
            text = prose() if fast.random() < 0.7 else said(fast.choice([1, 2, 6, 15, 60, 120])) + "."
            if fast.random() < 0.2:
                text = f'{text} <a href="/y">{said(2)}</a> {said(5)}.'
            if fast.random() < 0.2:
                text = f"<b>{text}" + ("</b>" if fast.random() < 0.5 else "<br>")
            put(text, True)
    for _ in range(fast.randrange(0, 3) if fast.random() < 0.5 else 0):
        chrome(fast.choice(["comments", "comments", "share", "sidebar", "form", "footer"]))
    out.append("</div>" * inside)
    out += [f"</{t}>" for t in reversed(re.findall(r"<(\w+)", start))]
    for kind in ("share", "comments", "advert", "sidebar", "form", "notice", "footer"):
        if fast.random() < {"footer": 0.6, "comments": 0.45}.get(kind, 0.3):
            chrome(kind)
    return "<html><head><title>x</title></head><body>" + "".join(out) + "</div>" * around + "</body></html>", truth


def training_groups(pages: int, rng: np.random.Generator, size: int = 64) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """That many pages in groups of like length."""
    data = []
    while len(data) < pages:
        page, truth = training_page(rng)
        found = blocks(page)
        if len(found) == len(truth):
            data.append((vectors(found), np.asarray(truth, np.float32)))
    data.sort(key=lambda d: len(d[0]))
    groups = []
    while data:
        groups.append(padded(data[-size:]))
        del data[-size:]
    return groups


@functools.lru_cache(1)
def trained(pages: int = PAGES, epochs: int = EPOCHS, seed: int = SEED) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    groups = training_groups(pages, rng)
    model = BiLstm(rng)
    model.fit(groups, epochs, rng)
    return model.p


def labelled(model: BiLstm, pages: list[list[Block]]) -> list[np.ndarray]:
    """Per page, which blocks belong to the article; states are carried from stretch to stretch, so each block sees its whole page."""
    seen = [vectors(page) for page in pages]
    sums = [np.full(len(v), model.p["k"][0], np.float32) for v in seen]
    order = sorted((i for i, v in enumerate(seen) if len(v)), key=lambda i: -len(seen[i]))
    for at in range(0, len(order), TOGETHER):
        group = order[at : at + TOGETHER]  # longest first, so the pages that reach a stretch come first
        starts = range(0, len(seen[group[0]]), STRETCH)
        for d in range(2):
            w, u, k = (model.p[x][d] for x in "WUc")
            o = model.p["o"][d * HIDDEN : (d + 1) * HIDDEN, 0]
            h, c = np.zeros((len(group), HIDDEN), np.float32), np.zeros((len(group), HIDDEN), np.float32)
            for a in reversed(starts) if d else starts:
                here = [i for i in group if len(seen[i]) > a]
                x, mask, _ = padded([(seen[i][a : a + STRETCH], ()) for i in here])
                step = -1 if d else 1
                out, last, cell = model.run(x[::step, None] @ w + k, mask[::step, None, :, None], u, h[None, : len(here)], c[None, : len(here)])
                h[: len(here)], c[: len(here)] = last[0], cell[0]
                part = (out[::step, 0] @ o).T
                for i, s in zip(here, part):
                    sums[i][a : a + STRETCH] += s[: len(sums[i]) - a]
    return [s >= 0 for s in sums]


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """keep, text, n_chars of every page."""
    sent = pages.sparkSession.sparkContext.broadcast(trained())
    kinds = {k: t for k, t in pages.dtypes if k in keep}
    rows = pages.selectExpr(*[f"`{k}`" for k in keep], f"cast(`{html_col}` as string) html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = BiLstm(np.random.default_rng(0))
        model.p = sent.value
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                found = [blocks(h) if h else [] for h in part.column(len(keep)).to_pylist()]
                texts = ["\n".join([b.text for b, m in zip(bs, ms) if m]) for bs, ms in zip(found, labelled(model, found))]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*keep, "text", "n_chars"])

    return rows.mapInArrow(run, ", ".join(f"`{k}` {kinds[k]}" for k in keep) + ", text string, n_chars long")


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
