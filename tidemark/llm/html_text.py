"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags, in page order.  Each block has a vector of its
hashed tag path (element names, words of class and id), a vector of its hashed words, and a few measures.  A numpy
bidirectional LSTM reads the whole sequence of a page's blocks and labels every one as main text or not; the document
text is the main blocks joined by line breaks.

The tables hold no labels, so the network is trained on pages from ``synthetic_page``: random words in page layouts of
many kinds (articles in telling and in neutral containers, menus, adverts, notices, side bars, forms, comments, footers),
with unclosed tags as in the wild.  Training is deterministic, runs once for a driver and takes seconds; no row of the input is used for it.

Defined results: null and empty pages give the empty text; pages without a main block too; repeated rows are read each
for itself; scripts, styles, drawings, comments and head elements are no blocks; text of formulas, ``noscript`` and
``object`` is text like any other; body-level tags and text close an open head; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, parts_by_size

# HTML element names by what they do to the flow of text.
RAW = ("script", "style", "template", "iframe", "title")
HEAD_LEVEL = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
#: A tag of these ends an <svg> that was not closed.
ENDS_SVG = "address article aside blockquote body center div dl dd dt fieldset figure footer form h[1-6] header hr img li main nav ol p pre section span table ul".replace(" ", "|")
MATH = frozenset(
    "math mi mo mn ms mtext mrow msup msub msubsup mfrac msqrt mroot mstyle mover munder munderover mtable mtr mtd mpadded mphantom menclose mspace mmultiscripts semantics annotation annotation-xml".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br input object".split()
) | MATH
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag of the key closes an open one of the values above it, up to the nearest of BARRIERS.
CLOSES = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
BLOCKS_THAT_END_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
BARRIERS = frozenset("html body article section div ul ol dl table td th main aside nav header footer form blockquote".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<svg>svg)(?=[\s/>])(?:[^>]*/>|[^>]*>(?:(?!</?(?:" + ENDS_SVG + r")(?=[\s/>])|</svg[\s>]).)*(?:</svg\s*>)?)"
    r"""|<(?P<tag>/?[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*+"|'[^']*+')*+)>"""
    r"|<(?P<loose>/?[a-zA-Z][^\s/>]*)[^>]*>"
    r"|<[!?][^>]*>"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

PATHS, WORDS, MEASURES = 96, 32, 6
INPUTS = PATHS + WORDS + MEASURES


#: Names of so many innermost elements make a block's path.
DEEPEST = 24


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: float


# Words of class and id that training pages teach; any other word is the same unknown one.
KNOWN = frozenset(
    (
        "nav menu navbar navigation breadcrumb topbar header masthead site logo branding ad ads advert advertisement promo sponsored banner box cookie notice consent alert newsletter popup gdpr"
        " sidebar side widget related recommended trending tags share social comment comments commentlist reply discussion responses reader footer copyright bottom legal"
        " content post article entry story text body main inner wrapper container row col page wrap outer layout column center grid"
    ).split()
)


def _names(tag: str, attrs: str | None) -> tuple[str, ...]:
    out = [tag]
    if attrs and "=" in attrs:
        for value in ATTRIBUTE.findall(attrs):
            out += ["." + x.lower() if x.lower() in KNOWN else ".?" for x in NAME_PART.findall(value)]
    return tuple(out)


class _Reader:
    """Open elements and the block that is being read.  Elements are counted by name, so an end tag without a start costs nothing."""

    def __init__(self):
        self.out: list[Block] = []
        self.opened: list[tuple[str, tuple[str, ...]]] = []
        self.count: Counter = Counter()
        self.parts: list[str] = []
        self.linked = 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join(html.unescape("".join(self.parts)).split())
            if text and (not self.count["head"] or self.count["body"]):
                path = tuple(n for _, names in self.opened[-DEEPEST:] for n in names)
                self.out.append(Block(path, text, min(1.0, self.linked / len(text))))
            self.parts.clear()
        self.linked = 0

    def close(self, at: int) -> None:
        for tag, _ in self.opened[at:]:
            self.count[tag] -= 1
        del self.opened[at:]

    def close_nearest(self, tags, stops=None, inline: bool = False) -> None:
        """Close the innermost of tags and what is in it, unless an element of stops (or a block, for inline ones) is nearer."""
        if not any(self.count[t] for t in tags):
            return
        for i in range(len(self.opened) - 1, -1, -1):
            tag = self.opened[i][0]
            if tag in tags:
                self.close(i)
                return
            if stops and tag in stops or inline and tag not in INLINE:
                return

    def open(self, tag: str, names: tuple[str, ...]) -> None:
        self.opened.append((tag, names))
        self.count[tag] += 1

    def text(self, text: str) -> None:
        if self.opened and self.opened[-1][0] == "head" and text.strip():
            self.flush()
            self.close(len(self.opened) - 1)
        self.parts.append(text)
        if self.count["a"]:
            self.linked += len(text)

    def space(self) -> None:
        if self.parts:
            self.parts.append(" ")


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks of a page in order, entities decoded, white space folded."""
    page, one, m = page or "", _Reader(), None
    last = page.rfind(">") + 1  # no tag ends after it: "<" there is text, and no search for an end runs in vain
    for m in TOKEN.finditer(page, 0, last):
        kind = m.lastgroup
        if text := m["text"]:
            one.text(text)
            continue
        name = m["tag"] or m["loose"]
        if not name:
            if kind == "svg" or kind == "raw" and m["raw"].lower() != "title":
                one.space()
            continue
        end, tag = name[0] == "/", name.lstrip("/").lower()
        if not end and tag not in HEAD_LEVEL and one.opened and one.opened[-1][0] == "head":
            one.flush()
            one.close(len(one.opened) - 1)
        if tag in INLINE:
            if tag == "br":
                one.space()
            elif end:
                one.close_nearest((tag,), inline=True)
            elif tag not in VOID and not (tag in MATH and (m["attrs"] or "").endswith("/")):
                one.open(tag, (tag,))
            continue
        one.flush()
        if end:
            one.close_nearest((tag,))
            continue
        if closes := CLOSES.get(tag, frozenset()) | ({"p"} if tag in BLOCKS_THAT_END_P else frozenset()):
            one.close_nearest(closes, BARRIERS)
        if tag not in VOID:
            one.open(tag, _names(tag, m["attrs"]))
    if last < len(page) and not _open_to_the_end(m, last):
        one.text(page[last:])
    one.flush()
    return one.out


def _open_to_the_end(m: re.Match | None, last: int) -> bool:
    """Did the last token begin a comment or an element of RAW that does not end before ``last``?"""
    if m is None or m.end() != last:
        return False
    text = m[0].lower()
    return text.startswith("<!--") and not text.endswith("-->") or m.lastgroup == "raw" and not text.rstrip().endswith(f"</{m['raw'].lower()}>")


def _slot(token: str, size: int) -> tuple[int, float]:
    h = zlib.crc32(token.encode())
    return h % size, 1.0 if h >> 31 else -1.0


class _WordSlots(dict):
    """Word -> slot, WORDS higher for a negative sign; emptied when it grows too large."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        i, sign = _slot(word, WORDS)
        self[word] = i if sign > 0 else i + WORDS
        return self[word]


_WORD_SLOTS = _WordSlots()


@lru_cache(maxsize=8192)
def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    v = np.zeros(PATHS, np.float32)
    for k, token in enumerate(path):
        i, sign = _slot("p" + token, PATHS)
        v[i] += sign * (1.0 if k >= len(path) - 6 else 0.7)
    v.setflags(write=False)
    return v


WORD = re.compile(r"[^\W_]+|©")


def features(page: list[Block]) -> np.ndarray:
    """n x INPUTS."""
    x = np.zeros((len(page), INPUTS), np.float32)
    for k, b in enumerate(page):
        words = WORD.findall(b.text.lower())
        row, n = x[k], len(words)
        row[:PATHS] = _path_vector(b.path)
        if n:
            seen = np.bincount(list(map(_WORD_SLOTS.__getitem__, words)), minlength=2 * WORDS)
            vector = (seen[:WORDS] - seen[WORDS:]).astype(np.float64)
            row[PATHS : PATHS + WORDS] = vector / max(1.0, np.sqrt(vector @ vector))
        row[PATHS + WORDS :] = (np.log1p(len(b.text)) / 6, b.linked, 1.0 if b.text[-1] in ".!?…" else 0.0, min(1.0, n / 20), k / len(page), 1.0)
    return x


class BlockLstm:
    """One layer, both directions, logistic output.  Gates in the order input, forget, output, candidate."""

    def __init__(self, hidden: int = 12, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.W = (rng.standard_normal((2, INPUTS, 4 * hidden)) / np.sqrt(INPUTS / 4)).astype(np.float32)
        self.U = (rng.standard_normal((2, hidden, 4 * hidden)) / np.sqrt(hidden)).astype(np.float32)
        self.b = np.zeros((2, 4 * hidden), np.float32)
        self.b[:, hidden : 2 * hidden] = 1
        self.v = (rng.standard_normal(2 * hidden) / np.sqrt(hidden)).astype(np.float32)
        self.c = np.zeros(1, np.float32)

    def weights(self) -> list[np.ndarray]:
        return [self.W, self.U, self.b, self.v, self.c]

    def _direction(self, x: np.ndarray, real: np.ndarray, d: int, keep: list | None) -> np.ndarray:
        """x: T x B x INPUTS, real: T x B; padding leaves the state as it is."""
        n, gates = self.hidden, x @ self.W[d] + self.b[d]
        h = np.zeros((x.shape[1], n), np.float32)
        cell, out = h, np.empty((*x.shape[:2], n), np.float32)
        for t in range(len(x)):
            g = gates[t] + h @ self.U[d]
            s = 1 / (1 + np.exp(-g[:, : 3 * n]))
            new = np.tanh(g[:, 3 * n :])
            i, f, o = s[:, :n], s[:, n : 2 * n], s[:, 2 * n :]
            m = real[t][:, None]
            after = f * cell + i * new
            squashed = np.tanh(after)
            if keep is not None:
                keep.append((h, cell, i, f, o, new, squashed, m))
            cell = np.where(m, after, cell)
            h = np.where(m, o * squashed, h)
            out[t] = h
        return out

    def logits(self, x: np.ndarray, real: np.ndarray, keep: tuple[list, list] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(T x B logits, T x B x 2H states)."""
        a = self._direction(x, real, 0, keep and keep[0])
        b = self._direction(x[::-1], real[::-1], 1, keep and keep[1])[::-1]
        h = np.concatenate([a, b], axis=2)
        return h @ self.v + self.c, h

    def step(self, x: np.ndarray, real: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Loss and gradients by backpropagation through time."""
        kept: tuple[list, list] = ([], [])
        a = self._direction(x, real, 0, kept[0])
        b = self._direction(x[::-1], real[::-1], 1, kept[1])[::-1]
        h, n = np.concatenate([a, b], axis=2), self.hidden
        p = 1 / (1 + np.exp(-(h @ self.v + self.c)))
        w = real / real.sum()
        loss = float(-(w * (y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7))).sum())
        dz = ((p - y) * w).astype(np.float32)
        dv, dc = np.einsum("tbh,tb->h", h, dz), np.array([dz.sum()], np.float32)
        dh_all = dz[..., None] * self.v
        dW, dU, db = np.zeros_like(self.W), np.zeros_like(self.U), np.zeros_like(self.b)
        for d in range(2):
            seq, outer = (x, dh_all[..., :n]) if d == 0 else (x[::-1], dh_all[::-1, :, n:])
            dh, dcell = np.zeros_like(outer[0]), np.zeros_like(outer[0])
            grads = np.empty((*x.shape[:2], 4 * n), np.float32)
            for t in range(len(seq) - 1, -1, -1):
                before, cell, i, f, o, new, squashed, m = kept[d][t]
                dh = dh + outer[t]
                dc_t = np.where(m, dcell + dh * o * (1 - squashed**2), 0)
                g = grads[t]
                g[:, :n] = dc_t * new * i * (1 - i)
                g[:, n : 2 * n] = dc_t * cell * f * (1 - f)
                g[:, 2 * n : 3 * n] = np.where(m, dh * squashed * o * (1 - o), 0)
                g[:, 3 * n :] = dc_t * i * (1 - new**2)
                dU[d] += before.T @ g
                dh = np.where(m, g @ self.U[d].T, dh)
                dcell = np.where(m, dc_t * f, dcell)
            dW[d] = np.tensordot(seq, grads, axes=([0, 1], [0, 1]))
            db[d] = grads.sum(axis=(0, 1))
        return loss, [dW, dU, db, dv, dc]

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """A boolean for each block.  Pages of like length share a batch, so that padding stays small."""
        out: list = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            to = at + 1
            while to < len(order) and to - at < 64 and len(pages[order[to]]) <= 1.25 * len(pages[order[at]]) + 4:
                to += 1
            part = order[at:to]
            x, real, _ = _batch([features(pages[i]) for i in part])
            z, _ = self.logits(x, real)
            for k, i in enumerate(part):
                out[i] = z[: len(pages[i]), k] > 0
            at = to
        return out


def _batch(xs: list[np.ndarray], ys: list[np.ndarray] | None = None):
    steps = max(map(len, xs))
    x, real, y = np.zeros((steps, len(xs), INPUTS), np.float32), np.zeros((steps, len(xs)), bool), np.zeros((steps, len(xs)), np.float32)
    for k, v in enumerate(xs):
        x[: len(v), k], real[: len(v), k] = v, True
        if ys is not None:
            y[: len(v), k] = ys[k]
    return x, real, y


MAIN, OTHER = "\x02", "\x03"
# Frequent words of some languages, so that ordinary text is no surprise.
COMMON = tuple(
    tuple(x.split())
    for x in (
        "the of and to in a is that it was for on are as with his they at be this from have or by one had not but what all were when we there can an your which their said if do will each about how up out them then she many some so these would other into has more two like him see time could no make than first been its who now people my made over did down only way find use may water long little very after words called just where most know",
        "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sei",
        "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec mais ou son lui nous comme tout fait été aussi leur bien être deux même",
        "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo esta ser son dos también fue",
    )
)


def synthetic_page(rng: np.random.Generator) -> str:
    """A random page; each text starts with MAIN or OTHER, its label."""
    pick = lambda *xs: xs[int(rng.integers(len(xs)))]
    chance = lambda p: rng.random() < p
    common = pick((), *COMMON)

    def word() -> str:
        if common and chance(0.45):
            return pick(*common)
        letters = "aeiouéñü", "bcdfghklmnprstvwzß"
        return "".join(pick(*letters[1]) + pick(*letters[0]) for _ in range(int(rng.integers(1, 4)))) + pick("", "", "n", "s", "r")

    def words(low: int, high: int, end: str = "") -> str:
        marks = pick("", "", "", ",", ";", "!", "###", " &amp;") if chance(0.15) else ""
        text = " ".join(word() + marks for _ in range(int(rng.integers(low, high + 1))))
        if chance(0.03):
            text = " ".join([word()] * int(rng.integers(low, high + 1)))
        return (text.upper() if chance(0.05) else text.capitalize()) + end

    def links(n: int, label: str = OTHER) -> str:
        return "".join(f'<li><a href="/{word()}">{label}{words(1, 3)}</a>' + pick("</li>", "</li>", "") for _ in range(n))

    def other(kind: str) -> str:
        few = int(rng.integers(2, 9))
        if kind == "menu":
            body = f"<ul>{links(few)}</ul>" if chance(0.8) else " ".join(f'<a href="/{word()}">{OTHER if i == 0 else ""}{words(1, 2)}</a>' for i in range(few))
            return pick(f"<nav>{body}</nav>", f'<div class="{pick("nav", "menu", "navbar", "navigation", "breadcrumb", "topbar")}">{body}</div>', f'<div id="{pick("menu", "nav", "navigation")}">{body}</div>')
        if kind == "header":
            body = f"<{pick('h1', 'div', 'p')}>{OTHER}{words(1, 5)}" + pick("</p>", "</div>", "</h1>")
            return pick(f"<header>{body}</header>", f'<div class="{pick("header", "masthead", "site-header", "logo", "branding")}">{body}</div>')
        if kind == "ad":
            body = pick(f"{OTHER}{words(2, 20, '.')}", f"<p>{OTHER}{words(3, 18, '.')}</p>", f'<a href="#">{OTHER}{words(2, 10)}</a>')
            return f'<{(t := pick("div", "div", "aside", "section"))} class="{pick("ad", "ads", "advert", "advertisement", "promo", "sponsored", "banner", "ad box")}">{body}</{t}>'
        if kind == "notice":
            return f'<div {pick("class", "id")}="{pick("cookie", "cookie-banner", "notice", "consent", "alert", "newsletter", "popup", "gdpr")}">{pick("<p>", "", "<span>")}{OTHER}{words(4, 25, ".")} <button>{words(1, 2)}</button></div>'
        if kind == "side":
            body = f"<h3>{OTHER}{words(1, 4)}</h3>" + pick(f"<ul>{links(few)}</ul>", f"<p>{OTHER}{words(5, 30, '.')}</p>")
            return pick(f"<aside>{body}</aside>", f'<div class="{pick("sidebar", "side", "widget", "related", "recommended", "trending", "tags", "share", "social")}">{body}</div>')
        if kind == "form":
            return f'<form action="/{word()}"><label>{OTHER}{words(1, 3)}</label><input name="q"><select><option>{OTHER}{words(1, 2)}<option>{OTHER}{words(1, 2)}</select><button>{OTHER}{words(1, 2)}</button></form>'
        if kind == "comments":
            each = "".join(f'<{(t := pick("li", "div", "article"))} class="{pick("comment", "reply", "comment-body")}"><b>{OTHER}{words(1, 2)}</b><p>{OTHER}{words(3, 60, ".")}</p></{t}>' for _ in range(few))
            return f'<{(s := pick("section", "div", "ol"))} {pick("class", "id")}="{pick("comments", "commentlist", "discussion", "responses", "reader-comments")}">{each}</{s}>'
        body = pick(f"&copy; {OTHER}{word()}.example.com &middot; {words(3, 15, '.')}", f"<p>{OTHER}{words(3, 25, '.')}</p>", f"<ul>{links(few)}</ul>", f"{OTHER}© {words(2, 9)}")
        return pick(f"<footer>{body}</footer>", f"<footer>{body}</footer>", f'<div class="{pick("footer", "site-footer", "copyright", "bottom", "legal")}">{body}</div>')

    def main() -> str:
        title = pick(f"<h1>{MAIN}{words(2, 12)}</h1>", f"<h2>{MAIN}{words(2, 12, '.')}</h2>", "", f"<header><h1>{MAIN}{words(2, 10)}</h1></header>")
        parts = [title]
        for _ in range(int(rng.integers(1, 4)) if chance(0.4) else int(rng.integers(2, 22))):
            long = words(1, 6, pick(".", "", "!")) if chance(0.25) else words(6, 70, pick(".", ".", ".", ""))
            parts.append(
                pick(f"<p>{MAIN}{long}</p>", f"<p>{MAIN}{long}</p>", f"<p>{MAIN}{long}</p>", f"<p><b>{MAIN}{long}<br>", f"<p>{MAIN}{long}<br>", f'<p>{MAIN}{words(3, 20)} <a href="/{word()}">{words(1, 4)}</a> {long}</p>', f"<p><em>{MAIN}{long}</em></p>")
                if chance(0.85)
                else pick(f"<h2>{MAIN}{words(1, 8)}</h2>", f"<ul><li>{MAIN}{words(2, 20)}<li>{MAIN}{words(2, 20)}</ul>", f"<blockquote>{MAIN}{long}</blockquote>", f"<table><tr><td>{MAIN}{words(1, 4)}<td>{MAIN}{words(1, 4)}</table>", f"<pre>{MAIN}{long}</pre>")
            )
            if chance(0.06):
                parts.append(other(pick("ad", "ad", "side", "notice", "form")))
        body = "".join(parts)
        if chance(0.1):
            body += other("comments")
        neutral = lambda: word() if chance(0.6) else pick("inner", "wrapper", "container", "row", "col", "page", "wrap", "outer", "layout", "column", "center", "grid")
        plain = lambda: pick("", "", f' class="{neutral()}"', f' class="{neutral()} {neutral()}"', f' id="{neutral()}"')
        if chance(0.45):  # containers that say nothing
            for _ in range(int(rng.integers(0, 4))):
                body = f"<div{plain()}>{body}</div>"
            return body
        return pick(f"<article>{body}</article>", f"<article>{body}</article>", f"<main>{body}</main>", f"<main><article>{body}</article></main>", f'<div class="{pick("content", "post", "article", "entry-content", "story", "text", "post-body", "main")}">{body}</div>', f'<section id="{pick("content", "article", "main", "body")}">{body}</section>')

    before = [other(k) for k in ("header", "menu", "notice", "ad", "form", "side") if chance(0.75 if k in ("menu", "ad") else 0.35)]
    after = [other(k) for k in ("side", "menu", "comments", "ad", "form", "notice") if chance(0.25)] + ([other("footer")] if chance(0.9) else [])
    comment = f"<!-- {words(1, 4)} -->"
    head = f"<!DOCTYPE html><html><head><title>{words(2, 9)}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head><body>" if chance(0.9) else ""
    return head + comment.join(before) + main() + pick("", "\n").join(after) + pick("</body></html>", "")


def _labelled(rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    page = blocks(synthetic_page(rng))
    y = np.array([MAIN in b.text for b in page], np.float32)
    for b in page:
        b.text = b.text.replace(MAIN, "").replace(OTHER, "") or "-"
    return features(page), y


@lru_cache(maxsize=1)
def trained(pages: int = 1100, epochs: int = 5, batch: int = 20, rate: float = 0.01, seed: int = 11) -> BlockLstm:
    """The network after so many epochs over so many synthetic pages, by Adam."""
    rng = np.random.default_rng(seed)
    data = [d for d in (_labelled(rng) for _ in range(pages)) if len(d[0])]
    model = BlockLstm()
    moment, k, total = [(np.zeros_like(w), np.zeros_like(w)) for w in model.weights()], 0, epochs * (len(data) // batch)
    for _ in range(epochs):
        order = sorted(rng.permutation(len(data)).tolist(), key=lambda i: len(data[i][0]) // 12)
        groups = [order[at : at + batch] for at in range(0, len(order), batch)]
        for g in rng.permutation(len(groups)):
            x, real, y = _batch([data[i][0] for i in groups[g]], [data[i][1] for i in groups[g]])
            _, grads = model.step(x, real, y)
            k += 1
            norm = float(np.sqrt(sum(float((v * v).sum()) for v in grads)))
            for w, v, (m, s) in zip(model.weights(), grads, moment, strict=True):
                v = v * min(1.0, 2.0 / (norm + 1e-9))
                m += 0.1 * (v - m)
                s += 0.01 * (v * v - s)
                w -= (rate * max(0.05, 1 - k / max(1, total)) * (m / (1 - 0.9**k)) / (np.sqrt(s / (1 - 0.99**k)) + 1e-8)).astype(np.float32)
    return model


def main_texts(pages: list[str | None], model: BlockLstm) -> list[str]:
    parsed = [blocks(p) for p in pages]
    return ["\n".join(b.text for b, keep in zip(page, label, strict=True) if keep) for page, label in zip(parsed, model.label(parsed), strict=True)]


def main_text(page: Column, model: BlockLstm | None = None) -> Column:
    """The main text of a column of pages."""
    one = model or trained()

    @F.pandas_udf("string")
    def run(pages):
        import pandas as pd

        out, every = [], pages.tolist()
        for at, to in parts_by_size(every, 256):
            out += main_texts(every[at:to], one)
        return pd.Series(out, dtype=object)

    return run(page)


def extract(pages: DataFrame, model: BlockLstm | None = None) -> DataFrame:
    """page_id, url, text, n_chars: one row for each row of pages."""
    return bounded_batches(pages).select("page_id", "url", main_text(F.col("html"), model).alias("text")).withColumn("n_chars", F.length("text").cast("long"))
