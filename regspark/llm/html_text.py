"""Main text of web pages: a recurrent labeller over the page's leaf blocks.

A page is cut into leaf blocks (stretches of text between block-level tags).
Each block is a vector: mean embedding of its tag path (the different tags,
classes and ids of all open elements, however deep, that the training pages
know; others have no trained embedding and would only dilute the mean), mean
embedding of its hashed words, and six plain numbers.
A bidirectional LSTM in numpy reads the whole sequence, so every decision sees
the page before and after the block. It is trained here, on pages drawn from a
seeded grammar of page layouts whose labels are known by construction.
"""

from __future__ import annotations

import functools
import html
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pick

# --- leaf blocks -------------------------------------------------------------

_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_TAG_SIGN = re.compile("[>\"']")
_CLASS = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
# Fixed values of the markup language: elements whose content is no page text,
# elements that do not break a line, elements without content.
_RAW = {"script", "style", "title", "noscript", "template", "textarea", "svg", "iframe", "object", "math"}
# Of these: a tag that ends in "/>" is an empty element; without an end tag, only the tag itself is left out.
_FOREIGN = {"svg", "math"}
_OPEN = _FOREIGN | {"noscript", "object"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
           "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}}
_ENDS_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5",
           "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}


class Node:
    """An open block element: its tokens, those that no open element above has, and its parent."""

    __slots__ = ("parent", "tokens", "fresh", "sums")

    def __init__(self, parent: "Node | None", tokens: list[str], fresh: list[str]):
        self.parent, self.tokens, self.fresh, self.sums = parent, tokens, fresh, None


class Block:
    """A leaf block; its path is a link to the innermost open element, so a block costs its own tokens."""

    __slots__ = ("node", "text", "linked")

    def __init__(self, node: Node | None, text: str, linked: int):
        self.node, self.text, self.linked = node, text, linked

    @property
    def path(self) -> list[str]:
        chain, node = [], self.node
        while node is not None:
            chain.append(node.tokens)
            node = node.parent
        return [t for tokens in reversed(chain) for t in tokens]


class Markup:
    """Tags of a page in one pass over it, also where quotes or tags are never closed.

    A quote that is not closed any more is an ordinary character; from the first
    tag on that ends only inside quotes, quotes are ordinary too. A tag that
    never ends takes the rest of the page.
    """

    def __init__(self, page: str):
        self.page, self.quoting, self.gone = page, True, set()

    def _find(self, sign: str, at: int) -> int:
        """Next place of ``sign``, -1 if there is none; that is looked for once."""
        if sign in self.gone:
            return -1
        place = self.page.find(sign, at)
        if place < 0:
            self.gone.add(sign)
        return place

    def tag_end(self, at: int) -> int:
        """Place of the ``>`` that ends the tag whose name ends at ``at``, -1 if none does."""
        start = at
        while self.quoting:
            sign = _TAG_SIGN.search(self.page, at)
            if sign is None:
                self.quoting = False
                break
            if sign[0] == ">":
                return sign.start()
            close = self._find(sign[0], sign.end())
            at = close + 1 if close >= 0 else sign.end()
        return self._find(">", start)

    def next_tag(self, at: int):
        """(place, end, closes, name, attributes) of the next tag, comment or declaration (no name), or None."""
        page = self.page
        while (place := self._find("<", at)) >= 0:
            if page.startswith("<!--", place):
                end = self._find("-->", place + 4)
                return place, end + 3 if end >= 0 else len(page), False, "", ""
            if page.startswith(("<!", "<?"), place):
                end = self._find(">", place)
                return place, end + 1 if end >= 0 else len(page), False, "", ""
            name = _NAME.match(page, place)
            if name:
                end = self.tag_end(name.end())
                if end < 0:
                    return place, len(page), False, "", ""
                return place, end + 1, bool(name[1]), name[2].lower(), page[name.end() : end]
            at = place + 1
        return None

    def raw_end(self, name: str, at: int) -> int:
        """End of the end tag of a raw element, -1 if it has none."""
        close = re.compile(rf"</{name}\b", re.I).search(self.page, at)
        end = self._find(">", close.end()) if close else -1
        return end + 1 if end >= 0 else -1


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order: innermost element, white-space-normal text, characters inside links.

    Linear in the page, whatever is nested or left open.
    """
    out: list[Block] = []
    stack: list[tuple[str, Node | None]] = []  # name and innermost block element so far
    parts: list[str] = []
    linked = links = 0
    unclosed: set[str] = set()
    open_names: dict[str, int] = {}
    open_tokens: dict[str, int] = {}

    def flush():
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(Block(stack[-1][1] if stack else None, text, linked))
        parts.clear()
        linked = 0

    def shut_from(k: int):
        nonlocal links
        while len(stack) > k:
            name, node = stack.pop()
            open_names[name] -= 1
            links -= name == "a"
            if name not in _INLINE:
                for t in node.tokens:
                    open_tokens[t] -= 1

    markup, at, n = Markup(page), 0, len(page)
    while at < n:
        tag = markup.next_tag(at)
        piece = page[at : tag[0]] if tag else page[at:]
        if piece:
            parts.append(piece)
            if links:
                linked += len(piece)
        if not tag:
            break
        _, at, closes, name, attributes = tag
        if not name:
            continue
        if closes:
            if name not in _INLINE:
                flush()
            if open_names.get(name):
                shut_from(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name))
            continue
        if name in _RAW:
            if name != "svg" and name not in _INLINE:
                flush()
            if name in _FOREIGN and attributes.endswith("/"):
                continue
            end = -1 if name in unclosed else markup.raw_end(name, at)
            if end >= 0:
                at = end
            elif name in _OPEN:
                unclosed.add(name)  # none further on either
            else:
                at = n
            continue
        if name not in _INLINE:
            flush()
        if name in _VOID or attributes.endswith("/"):
            continue
        shut = _CLOSES.get(name, set()) | ({"p"} if name in _ENDS_P else set())
        for k in range(len(stack) - 1, max(-1, len(stack) - 8), -1):
            if stack[k][0] in shut:
                shut_from(k)
            elif stack[k][0] not in _INLINE and stack[k][0] not in {"td", "th", "tr"}:
                break
        node = stack[-1][1] if stack else None
        if name not in _INLINE:
            tokens = [name]
            if attributes and "=" in attributes:
                for a, b, c in _CLASS.findall(attributes):
                    tokens += ["." + x for x in _SPLIT.split((a or b or c).lower()) if x]
            node = Node(node, tokens, [t for t in dict.fromkeys(tokens) if not open_tokens.get(t)])
            for t in tokens:
                open_tokens[t] = open_tokens.get(t, 0) + 1
        stack.append((name, node))
        open_names[name] = open_names.get(name, 0) + 1
        links += name == "a"
    flush()
    return out


# --- features ----------------------------------------------------------------

PATHS, WORDS, PLAIN = 512, 512, 6


def _bucket(token: str, size: int) -> int:
    return zlib.crc32(token.encode("utf-8", "surrogatepass")) % size


def plain_features(page: list[Block]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the hashed words (block, bucket, share) and the plain features."""
    n, x, cells = len(page), np.zeros((len(page), PLAIN), np.float32), []
    for i, b in enumerate(page):
        words = b.text.lower().split()
        cells += [(i, zlib.crc32(t.encode("utf-8", "surrogatepass")) % WORDS, 1 / len(words)) for t in words]
        size = len(b.text)
        x[i] = (np.log1p(size) / 5, min(1.0, b.linked / size), b.text[-1] in ".!?:;", min(len(words), 50) / 50, (i + 0.5) / n,
                min(n, 100) / 100)
    return np.array(cells, np.float64).reshape(-1, 3), x


def encode(page: list[Block], known: frozenset[str] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Path, word and plain features: bags as row-normalised counts; path tokens count once, and only ``known`` ones if given."""
    n = len(page)
    p, w = np.zeros((n, PATHS), np.float32), np.zeros((n, WORDS), np.float32)
    cells, x = plain_features(page)
    np.add.at(w, (cells[:, 0].astype(np.int64), cells[:, 1].astype(np.int64)), cells[:, 2])
    for i, b in enumerate(page):
        path = b.path if known is None else [t for t in b.path if t in known]
        for t in [*dict.fromkeys(path), "leaf:" + (path[-1] if path else "")]:
            p[i, _bucket(t, PATHS)] += 1
    p /= np.maximum(1, p.sum(axis=1, keepdims=True))
    return p, w, x


# --- the network -------------------------------------------------------------

PATH_DIM, WORD_DIM, HIDDEN = 16, 6, 16


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Labeller:
    """Bidirectional LSTM with trained embeddings; all arrays are a few hundred kilobytes."""

    def __init__(self, seed: int = 3):
        self.known: frozenset[str] | None = None  # path tokens of the training pages
        r = np.random.default_rng(seed)
        d = PATH_DIM + WORD_DIM + PLAIN
        init = lambda *s: (r.standard_normal(s) * 0.3 / np.sqrt(s[0] if len(s) > 1 else 1)).astype(np.float32)
        self.w = {
            "path": r.standard_normal((PATHS, PATH_DIM)).astype(np.float32) * 0.3,
            "word": r.standard_normal((WORDS, WORD_DIM)).astype(np.float32) * 0.1,
            "out": init(2 * HIDDEN + d, 1), "bias": np.zeros(1, np.float32),
        }
        for side in "fb":
            self.w["x" + side], self.w["h" + side] = init(d, 4 * HIDDEN), init(HIDDEN, 4 * HIDDEN)
            self.w["c" + side] = np.concatenate([np.ones(HIDDEN), np.zeros(3 * HIDDEN)]).astype(np.float32)

    def _run(self, x, live, side, keep=None):
        """Hidden states of one direction; padding never changes the state."""
        w, (n, t, _) = self.w, x.shape
        gates = x @ w["x" + side] + w["c" + side]
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out = np.zeros((n, t, HIDDEN), np.float32)
        for k in range(t) if side == "f" else range(t - 1, -1, -1):
            z = gates[:, k] + h @ w["h" + side]
            f, i, o = (_sigmoid(z[:, s * HIDDEN : (s + 1) * HIDDEN]) for s in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            new = f * c + i * g
            th = np.tanh(new)
            on = live[:, k, None]
            if keep is not None:
                keep.append((k, f, i, o, g, c, h, th))
            c, h = np.where(on, new, c), np.where(on, o * th, h)
            out[:, k] = h
        return out

    def _inputs(self, p, q, x):
        return np.concatenate([p @ self.w["path"], q @ self.w["word"], x], axis=-1)

    def logits(self, p, q, x, live):
        v = self._inputs(p, q, x)
        return (np.concatenate([self._run(v, live, "f"), self._run(v, live, "b"), v], axis=-1) @ self.w["out"])[..., 0] + self.w["bias"]

    def _back(self, grad, x, live, side, keep, total):
        """Back-propagation through time of one direction; returns the gradient of its inputs."""
        w = self.w
        dx = np.zeros_like(x)
        dh_next, dc_next = np.zeros_like(grad[:, 0]), np.zeros_like(grad[:, 0])
        wx, wh, wc = (np.zeros_like(w[name + side]) for name in "xhc")
        for k, f, i, o, g, c, h, th in reversed(keep):
            on = live[:, k, None]
            dh = grad[:, k] + dh_next
            live_dh = np.where(on, dh, 0)
            dc = np.where(on, dc_next, 0) + live_dh * o * (1 - th * th)
            dz = np.concatenate([dc * c * f * (1 - f), dc * g * i * (1 - i), live_dh * th * o * (1 - o), dc * i * (1 - g * g)], axis=1)
            wx += x[:, k].T @ dz
            wh += h.T @ dz
            wc += dz.sum(axis=0)
            dx[:, k] = dz @ w["x" + side].T
            dh_next = dz @ w["h" + side].T + np.where(on, 0, dh)
            dc_next = np.where(on, dc * f, dc_next)
        total["x" + side], total["h" + side], total["c" + side] = wx, wh, wc
        return dx

    def fit(self, p, q, x, y, live, rounds: int = 120, rate: float = 0.02) -> None:
        """Adam on the mean cross-entropy of all blocks."""
        m1 = {k: np.zeros_like(v) for k, v in self.w.items()}
        m2 = {k: np.zeros_like(v) for k, v in self.w.items()}
        total = live.sum()
        rows = np.flatnonzero(live)
        flat = lambda z: z.reshape(-1, z.shape[-1])[rows]
        up, uq = np.flatnonzero(p.any(axis=(0, 1))), np.flatnonzero(q.any(axis=(0, 1)))
        fp, fq = np.ascontiguousarray(flat(p)[:, up]), np.ascontiguousarray(flat(q)[:, uq])
        v = self._inputs(p, q, x)
        for step in range(1, rounds + 1):
            v = v.copy()
            v.reshape(-1, v.shape[-1])[rows, : PATH_DIM + WORD_DIM] = np.concatenate(
                [fp @ self.w["path"][up], fq @ self.w["word"][uq]], axis=1)
            kf, kb, grads = [], [], {}
            top = np.concatenate([self._run(v, live, "f", kf), self._run(v, live, "b", kb), v], axis=-1)
            z = (top @ self.w["out"])[..., 0] + self.w["bias"]
            e = (np.where(live, _sigmoid(z) - y, 0) / total).astype(np.float32)
            grads["out"] = np.einsum("ntd,nt->d", top, e)[:, None]
            grads["bias"] = e.sum(keepdims=True).reshape(1)
            d = e[..., None] * self.w["out"][:, 0]
            dv = d[..., 2 * HIDDEN :].copy()
            dv += self._back(d[..., :HIDDEN], v, live, "f", kf, grads)
            dv += self._back(d[..., HIDDEN : 2 * HIDDEN], v, live, "b", kb, grads)
            grads["path"], grads["word"] = np.zeros_like(self.w["path"]), np.zeros_like(self.w["word"])
            grads["path"][up] = fp.T @ flat(dv)[:, :PATH_DIM]
            grads["word"][uq] = fq.T @ flat(dv)[:, PATH_DIM : PATH_DIM + WORD_DIM]
            for k in self.w:
                g = grads[k].astype(np.float32) + 1e-5 * self.w[k]
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.99 * m2[k] + 0.01 * g * g
                self.w[k] -= rate * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.99 ** step)) + 1e-8)

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Main-text flags of each page's blocks; pages of like length are read together."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            group = [order[at]]
            while at + len(group) < len(order) and len(group) < 256 and (len(group) + 1) * len(pages[order[at + len(group)]]) <= 8192:
                group.append(order[at + len(group)])
            at += len(group)
            v = np.zeros((len(group), len(pages[group[-1]]), PATH_DIM + WORD_DIM + PLAIN), np.float32)
            live = np.zeros(v.shape[:2], bool)
            for row, i in enumerate(group):
                v[row, : len(pages[i])], live[row, : len(pages[i])] = self.embedded(pages[i]), True
            z = np.concatenate([*self._both(v, live), v], axis=-1) @ self.w["out"]
            for row, i in enumerate(group):
                out[i] = z[row, : len(pages[i]), 0] + self.w["bias"][0] > 0
        return out

    def _path_sums(self, node: Node | None) -> tuple[np.ndarray, int, str]:
        """Embedding sum and number of the different known tokens above a block, and the last of them; kept at each node."""
        chain = []
        while node is not None and node.sums is None:
            chain.append(node)
            node = node.parent
        total, count, last = node.sums if node is not None else (np.zeros(PATH_DIM, np.float32), 0, "")
        for node in reversed(chain):
            fresh = [t for t in node.fresh if self.known is None or t in self.known]
            if fresh:
                total = total + self.w["path"][[_bucket(t, PATHS) for t in fresh]].sum(axis=0)
            last = next((t for t in reversed(node.tokens) if self.known is None or t in self.known), last)
            node.sums = total, count, last = total, count + len(fresh), last
        return total, count, last

    def embedded(self, page: list[Block]) -> np.ndarray:
        """What ``_inputs`` makes of ``encode``, without the bags: a block costs its own words and tokens."""
        cells, x = plain_features(page)
        v = np.zeros((len(page), PATH_DIM + WORD_DIM + PLAIN), np.float32)
        for i, b in enumerate(page):
            total, count, last = self._path_sums(b.node)
            v[i, :PATH_DIM] = (total + self.w["path"][_bucket("leaf:" + last, PATHS)]) / (count + 1)
        rows, words = cells[:, 0].astype(np.int64), cells[:, 1].astype(np.int64)
        for d in range(WORD_DIM):
            v[:, PATH_DIM + d] = np.bincount(rows, self.w["word"][words, d] * cells[:, 2], minlength=len(page))
        v[:, PATH_DIM + WORD_DIM :] = x
        return v

    def _both(self, v: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hidden states of both directions, read in one loop (the second one from the end)."""
        w, (n, t, _) = self.w, v.shape
        gates = np.stack([v @ w["xf"] + w["cf"], (v @ w["xb"] + w["cb"])[:, ::-1]]).transpose(2, 0, 1, 3)
        on = np.stack([live, live[:, ::-1]]).transpose(2, 0, 1)[..., None]
        whole, weights = on.all(axis=(1, 2, 3)).tolist(), np.stack([w["hf"], w["hb"]])
        h, c = np.zeros((2, n, HIDDEN), np.float32), np.zeros((2, n, HIDDEN), np.float32)
        out = np.zeros((t, 2, n, HIDDEN), np.float32)
        for k in range(t):
            z = gates[k] + h @ weights
            s = _sigmoid(z[..., : 3 * HIDDEN])
            new = s[..., :HIDDEN] * c + s[..., HIDDEN : 2 * HIDDEN] * np.tanh(z[..., 3 * HIDDEN :])
            read = s[..., 2 * HIDDEN :] * np.tanh(new)
            c, h = (new, read) if whole[k] else (np.where(on[k], new, c), np.where(on[k], read, h))
            out[k] = h
        both = out.transpose(1, 2, 0, 3)
        return both[0], both[1][:, ::-1]


def padded(pages):
    n, t = len(pages), max(len(p[0]) for p in pages)
    p, q, x = (np.zeros((n, t, s), np.float32) for s in (PATHS, WORDS, PLAIN))
    live = np.zeros((n, t), bool)
    for i, (a, b, c) in enumerate(pages):
        p[i, : len(a)], q[i, : len(a)], x[i, : len(a)], live[i, : len(a)] = a, b, c, True
    return p, q, x, live


# --- training pages ----------------------------------------------------------

_SYLLABLES = "an re th in on er st ti en es le de la ou ion que ment ver sch lich ar os ci ta ll mi ga te be un ge au".split()
_LAYOUT = {  # kind of page part -> ways to open it
    "nav": ["<nav>", '<nav class="main-nav">', '<div class="menu">', '<ul class="nav">', '<div id="navigation">', '<div class="breadcrumbs">'],
    "header": ["<header>", '<div id="header">', '<div class="site-header">', '<header class="top masthead">'],
    "footer": ["<footer>", '<div id="footer">', '<div class="site-footer">', '<footer class="page-footer">', '<div class="copyright">'],
    "aside": ["<aside>", '<div class="sidebar">', '<aside class="related">', '<div class="widget">', '<div id="sidebar">',
              '<section class="recommended">'],
    "ad": ['<div class="ad">', '<div class="ads">', '<div class="advert">', '<div class="sponsored">', '<div class="banner-ad">',
           '<div class="promo">', '<div id="advertisement">', '<section class="ad-slot">'],
    "notice": ['<div class="notice">', '<div class="cookie">', '<div class="cookie-banner">', '<div id="consent">',
               '<div class="alert">', '<div class="gdpr-notice">', '<div class="newsletter">', '<div role="alert">'],
    "form": ["<form>", '<form class="search">', '<form id="signup">', '<form action="/x">'],
    "comments": ['<div class="comments">', '<section id="comments">', '<section class="comments">', '<div class="comment">',
                 '<ul class="comment-list">', '<div class="replies">', '<ol class="commentlist">', '<div class="discussion">'],
    "article": ["<article>", "<article>", "<article>", "<main>", "<main><article>", '<div class="content">', '<div class="post">',
                '<article class="entry">', '<div class="article-body">', '<div id="content">', '<section class="story">', '<div class="text">'],
}


def _shut(opening: str) -> str:
    return "".join(f"</{t}>" for t in reversed(re.findall(r"<(\w+)", opening)))


def training_page(rng: random.Random) -> str:
    """A page of the grammar; main-text blocks carry the mark U+0001 in front."""
    def word():
        w = "".join(rng.choice(_SYLLABLES) for _ in range(rng.choice((1, 1, 2, 2, 3))))
        return w + rng.choice(("",) * 12 + (",", ".", "!!", "%%%", "***"))

    def words(lo, hi):
        return " ".join(word() for _ in range(rng.randint(lo, hi))).capitalize()

    def some(lo, hi, main, tag="p"):
        out = []
        for _ in range(rng.randint(lo, hi)):
            size = rng.choice(((1, 4), (5, 25), (20, 60)))
            text = words(*size) + rng.choice((".", ".", ".", ""))
            if rng.random() < 0.15:
                text = f"<b>{text}</b>"
            if rng.random() < 0.1:
                text = f'<a href="/x">{words(1, 3)}</a> ' + text
            out.append(f"<{tag}>{main}{text}</{tag}>")
        return "".join(out)

    def links(n):
        return "<ul>" + "".join(f'<li><a href="/{k}">{words(1, 3)}</a></li>' for k in range(n)) + "</ul>"

    def part(kind):
        opening = rng.choice(_LAYOUT[kind])
        if kind == "nav":
            inner = links(rng.randint(2, 8))
        elif kind == "header":
            inner = f"<h1>{words(1, 5)}</h1>" * rng.randint(0, 1) + f"<p>{words(2, 8)}</p>" + (links(3) if rng.random() < 0.3 else "")
        elif kind == "footer":
            inner = rng.choice((f"&copy; {words(1, 3)} &middot; {words(3, 20)}.", f"<p>&copy; {words(3, 15)}</p>" + links(3), some(1, 2, "")))
        elif kind == "aside":
            inner = f"<h3>{words(1, 4)}</h3>" + rng.choice((links(4), some(1, 3, "")))
        elif kind == "form":
            inner = f"<label>{words(1, 3)}</label><input name=q><button>{words(1, 2)}</button>" + (f"<p>{words(3, 12)}</p>" if rng.random() < 0.4 else "")
        elif kind == "comments":
            tag = "li" if opening[1] in "uo" else rng.choice(("p", "div"))
            inner = (f"<h3>{words(1, 3)}</h3>" if tag != "li" and rng.random() < 0.5 else "") + some(1, 4, "", tag)
        else:
            inner = rng.choice((words(5, 25) + ".", some(1, 2, "")))
        return opening + inner + _shut(opening)

    def article():
        opening = rng.choice(_LAYOUT["article"])
        body = [f"<h1>\1{words(2, 10)}</h1>"] if rng.random() < 0.8 else []
        for _ in range(rng.randint(1, 5)):
            body.append(rng.choice((
                some(1, 6, "\1"), some(1, 6, "\1"), some(1, 6, "\1"), some(2, 5, "\1").replace("</p>", ""),
                f"<p>\1<b>{words(10, 40)}.<br>" + some(1, 2, "\1"), f"<h2>\1{words(1, 6)}</h2>" + some(1, 3, "\1"),
                "<ul>" + some(2, 4, "\1", "li") + "</ul>", f"<blockquote>\1{words(8, 30)}</blockquote>", f"<pre>\1{words(4, 20)}</pre>",
                f"<table><tr><td>\1{words(1, 4)}</td><td>\1{words(1, 4)}</td></tr></table>", f"<div>\1{words(10, 40)}.</div>")))
            if rng.random() < 0.12:
                body.append(part(rng.choice(("ad", "aside", "notice", "form", "nav"))))
        if rng.random() < 0.1:
            body.append(part("comments"))
        return opening + "".join(body) + _shut(opening)

    before = [part(k) for k in ("notice", "header", "nav", "form", "ad", "aside") if rng.random() < (0.7 if k in {"nav", "ad"} else 0.3)]
    after = [part(k) for k in ("ad", "comments", "aside", "form", "notice", "footer") if rng.random() < (0.75 if k == "footer" else 0.35)]
    if rng.random() < 0.3:
        rng.shuffle(before)
    middle = article() + (article() if rng.random() < 0.1 else "")
    wrap = rng.choice(("", "", "", '<div class="wrapper">', '<div id="page">', "<div><div>"))
    page = "<html><body>" + wrap + "".join(before) + middle + "".join(after) + "</body></html>"
    return page[: int(len(page) * rng.uniform(0.6, 1))] if rng.random() < 0.1 else page


@functools.lru_cache(maxsize=4)
def train(pages: int = 400, seed: int = 11) -> Labeller:
    """Fit on ``pages`` pages of the grammar (its only bound; no corpus row is used)."""
    rng = random.Random(seed)
    seqs, labels, known = [], [], set()
    while len(seqs) < pages:
        page = blocks(training_page(rng))[:60]
        if page:
            labels.append([b.text[0] == "\1" for b in page])
            for b in page:
                b.text = b.text.replace("\1", "") or "-"
                known.update(b.path)
            seqs.append(encode(page))
    p, q, x, live = padded(seqs)
    y = np.zeros(live.shape, np.float32)
    for i, row in enumerate(labels):
        y[i, : len(row)] = row
    net = Labeller()
    net.known = frozenset(known)
    net.fit(p, q, x, y, live)
    return net


SCHEMA = "page_id long, url string, text string, n_chars long, n_blocks long, n_main long"


def _extract(net: Labeller):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                pages = [blocks(t.as_py() or "") for t in part.column(2)]
                flags = net.label(pages)
                texts = [" ".join(b.text for b, on in zip(page, keep) if on) for page, keep in zip(pages, flags)]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([len(p) for p in pages], pa.int64()), pa.array([int(f.sum()) for f in flags], pa.int64()),
                ], names=[c.split()[0] for c in SCHEMA.split(", ")])
    return run


def main_text(pages: DataFrame, net: Labeller | None = None) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars, n_blocks, n_main``.

    ``text`` joins the blocks labelled main text by single spaces; character
    references are decoded, white space in a block becomes one space.

    Defined cases: null or empty html and pages without text give the empty
    string; null ids and urls are carried; repeated rows are read once each; an
    empty table gives no rows. Other columns are ignored.
    """
    rows = pick(pages, page_id="long", url="string", html="string")
    return rows.mapInArrow(_extract(net or train()), SCHEMA)
