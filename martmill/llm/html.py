"""Main text of web pages: a recurrent block labeller.

A page is read as a sequence of leaf blocks (text between block-level tags). Each block gets a vector from its tag path
(tags, classes and ids of its ancestors, hashed), its words (hashed) and a few measures; a bidirectional LSTM in numpy
reads the whole sequence and labels every block article or not. The network is trained on layouts that are composed
here, with the words of a bounded sample of the pages' own blocks as their text, so every block's label is known.

Defined cases
* Null or empty html, or a page without article blocks: empty text, 0 characters.
* Unclosed tags, comments, quotes and raw-text elements are read to the end of the page; an end tag without a start is
  ignored; a ``<`` that starts no tag is text. ``br`` is white space.
* Repeated rows are each extracted. An empty table gives no rows. Other columns are not read.
* All ancestors of a block make its tag path, however deep it lies; text is never cut. The words of the training layouts
  come from the first 20,000 characters of each page of the sample.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATHS, WORDS, MEASURES, WIDTH, HIDDEN = 1024, 256, 6, 24, 16
DEPTH = 16

TAG = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S
)
NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
# Fixed values of the HTML standard: elements without content, with raw text, and those that stand within a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template textarea title noscript iframe xmp noembed noframes svg math".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var img br wbr".split())
ENDS_P = frozenset("address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
ENDS_LIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
STOPS = frozenset("table ul ol dl select body article section div td th".split())


@lru_cache(100_000)
def _path_ids(tag: str, attributes: str) -> tuple[int, ...]:
    """Hash numbers of a tag and of the words of its class, id and role."""
    found = [tag]
    for _, *values in NAMES.findall(attributes):
        found += [w for w in re.split(r"[^a-z]+", "".join(values).lower()) if w]
    return tuple(zlib.crc32(x.encode()) % PATHS for x in found)


class Block:
    """``path``: the ids of all ancestors; ``own``: those of the nearest; ``depth``: how many ancestors there are."""

    __slots__ = ("path", "own", "depth", "parts", "linked", "text")

    def __init__(self, path: frozenset[int], own: tuple[int, ...], depth: int) -> None:
        self.path, self.own, self.depth, self.parts, self.linked, self.text = path, own, depth, [], 0, ""


def blocks(html: str) -> list[Block]:
    """Leaf blocks with text, in page order; white space within a block is one blank."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[int, ...], frozenset[int]]] = []  # tag, its ids, the ids down to it
    places: defaultdict[str, list[int]] = defaultdict(list)  # of the open elements, by tag
    links, at, current, end = 0, 0, None, len(html)

    def cut(i: int) -> None:
        while len(stack) > i:
            places[stack.pop()[0]].pop()

    def innermost(tags) -> int:
        return max((places[t][-1] for t in tags if places[t]), default=-1)

    def text(piece: str) -> None:
        nonlocal current
        if current is None:
            if not piece.strip():
                return
            current = Block(stack[-1][2], stack[-1][1], len(stack)) if stack else Block(frozenset(), (), 0)
            out.append(current)
        current.parts.append(piece)
        if links:
            current.linked += len(piece)

    while at < end:
        m = TAG.search(html, at)
        if m is None:
            text(unescape(html[at:]))
            break
        if m.start() > at:
            text(unescape(html[at : m.start()]))
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "br":
                text(" ")
            elif tag == "a":
                links = 0 if closing else 1
            continue
        if closing:
            if places[tag]:
                cut(places[tag][-1])
            current, links = None, 0
            continue
        current, links = None, 0
        if tag in RAW and not attributes.endswith("/"):
            closed = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(html, at)
            at = closed.end() if closed else end
            continue
        if tag in ENDS_P or tag in ENDS_LIKE:
            ended = innermost({"p"} | ENDS_LIKE.get(tag, set()))
            if ended >= 0 and ended >= innermost(STOPS):
                cut(ended)
        if tag not in VOID and not attributes.endswith("/"):
            ids, above = _path_ids(tag, attributes), stack[-1][2] if stack else frozenset()
            places[tag].append(len(stack))
            stack.append((tag, ids, above if above.issuperset(ids) else above.union(ids)))
    kept = []
    for b in out:
        b.text = " ".join("".join(b.parts).split())
        if b.text:
            kept.append(b)
    return kept


def features(page: list[Block], start: int = 0, stop: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marks of path ids, shares of hashed words, and measures of a page's blocks, or of those from start to stop."""
    of_page, page = len(page), page[start:stop]
    n = len(page)
    paths, words, measures = np.zeros((n, PATHS), np.float32), np.zeros((n, WORDS), np.float32), np.zeros((n, MEASURES), np.float32)
    for i, b in enumerate(page):
        paths[i, list(b.path)] = 1
        measures[i, 5] = max(0, len(b.own) - 1)
        tokens = b.text.lower().split(" ")
        words[i] = np.bincount([zlib.crc32(w.encode("utf-8", "replace")) % WORDS for w in tokens], minlength=WORDS) / len(tokens)
        measures[i, :5] = np.log1p(len(tokens)) / 5, min(1.0, b.linked / len(b.text)), b.text[-1] in ".!?", (start + i) / of_page, min(1.0, b.depth / DEPTH)
    return paths, words, measures


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def initial(seed: int = 7) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    make = lambda *shape: (r.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    net = {"paths": make(PATHS, WIDTH) * 8, "words": make(WORDS, WIDTH), "measures": make(MEASURES, WIDTH), "bias": np.zeros(WIDTH, np.float32), "out": make(2 * HIDDEN + WIDTH, 1), "out_bias": np.zeros(1, np.float32)}
    for d in "fb":
        gate_bias = np.zeros(4 * HIDDEN, np.float32)
        gate_bias[HIDDEN : 2 * HIDDEN] = 1
        net |= {f"in_{d}": make(WIDTH, 4 * HIDDEN), f"re_{d}": make(HIDDEN, 4 * HIDDEN), f"b_{d}": gate_bias}
    return net


def _scan(net, d: str, x: np.ndarray, mask: np.ndarray, keep: bool = True, block: int = 4096):
    """One direction over [time, page, width]; padded steps leave the state as it is. ``keep``: every step's states."""
    steps, pages, _ = x.shape
    h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
    out, kept, first, z = np.zeros((steps, pages, HIDDEN), np.float32), {}, steps, None
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        if z is None or not first <= t < first + len(z):
            first = t // block * block
            z = x[first : first + block] @ net[f"in_{d}"] + net[f"b_{d}"]
        gates = z[t - first] + h @ net[f"re_{d}"]
        i, f, o, g = _sigmoid(gates[:, :HIDDEN]), _sigmoid(gates[:, HIDDEN : 2 * HIDDEN]), _sigmoid(gates[:, 2 * HIDDEN : 3 * HIDDEN]), np.tanh(gates[:, 3 * HIDDEN :])
        m, before = mask[t][:, None], (h, c)
        c = m * (f * c + i * g) + (1 - m) * c
        tanh_c = np.tanh(c)
        h = m * (o * tanh_c) + (1 - m) * h
        out[t] = h
        if keep:
            kept[t] = (i, f, o, g, tanh_c, m, *before)
    return out, kept


def project(net, paths: np.ndarray, words: np.ndarray, measures: np.ndarray) -> np.ndarray:
    """What the network reads of a block, from its features."""
    return np.tanh(paths @ net["paths"] + words @ net["words"] + measures @ net["measures"] + net["bias"])


def read(net, x: np.ndarray, mask: np.ndarray, keep: bool = True):
    """The probability of being article for every block of [time, page, width], and what training needs."""
    (f, kept_f), (b, kept_b) = _scan(net, "f", x, mask, keep), _scan(net, "b", x, mask, keep)
    joined = np.concatenate([f, b, x], axis=2)
    return _sigmoid((joined @ net["out"] + net["out_bias"])[..., 0]), (x, joined, kept_f, kept_b)


def forward(net, paths: np.ndarray, words: np.ndarray, measures: np.ndarray, mask: np.ndarray):
    return read(net, project(net, paths, words, measures), mask)


def gradients(net, paths, words, measures, mask, labels):
    """Gradients of the mean cross entropy over the blocks of a batch: back-propagation through time."""
    p, (x, joined, kept_f, kept_b) = forward(net, paths, words, measures, mask)
    error = (mask * (p - labels) / mask.sum())[..., None].astype(np.float32)
    grad = {"out": np.einsum("tpi,tpo->io", joined, error), "out_bias": error.sum((0, 1))}
    into = error @ net["out"].T
    dx = into[..., 2 * HIDDEN :].copy()
    for d, kept, dh_all in (("f", kept_f, into[..., :HIDDEN]), ("b", kept_b, into[..., HIDDEN : 2 * HIDDEN])):
        dz = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
        dre = np.zeros_like(net[f"re_{d}"])
        dh, dc = np.zeros_like(dh_all[0]), np.zeros_like(dh_all[0])
        for t in reversed(list(kept)):
            i, f, o, g, tanh_c, m, h0, c0 = kept[t]
            dh = dh + dh_all[t]
            live = m * dh
            dc_t = m * dc + live * o * (1 - tanh_c**2)
            dgates = np.concatenate([dc_t * g * i * (1 - i), dc_t * c0 * f * (1 - f), live * tanh_c * o * (1 - o), dc_t * i * (1 - g**2)], axis=1)
            dz[t] = dgates
            dre += h0.T @ dgates
            dh = (1 - m) * dh + dgates @ net[f"re_{d}"].T
            dc = (1 - m) * dc + dc_t * f
        grad |= {f"in_{d}": np.einsum("tpi,tpo->io", x, dz), f"re_{d}": dre, f"b_{d}": dz.sum((0, 1))}
        dx += dz @ net[f"in_{d}"].T
    dx *= 1 - x**2
    flat = dx.reshape(-1, WIDTH)
    grad |= {"paths": paths.reshape(-1, PATHS).T @ flat, "words": words.reshape(-1, WORDS).T @ flat, "measures": measures.reshape(-1, MEASURES).T @ flat, "bias": flat.sum(0)}
    return grad


def _padded(pages: list[tuple[np.ndarray, ...]]):
    """Features of several pages as [time, page, ...] and the mask of real blocks."""
    steps = max(len(p[0]) for p in pages)
    out = [np.zeros((steps, len(pages), f.shape[1]), np.float32) for f in pages[0][:3]]
    mask = np.zeros((steps, len(pages)), np.float32)
    for i, page in enumerate(pages):
        for a, f in zip(out, page):
            a[: len(f), i] = f
        mask[: len(page[0]), i] = 1
    return (*out, mask)


# --- training layouts ------------------------------------------------------------------------------------------------
ARTICLE = ["<article>", "<article class='post'>", "<main><article>", "<main>", "<div class='content'>", "<div id='content'>", "<div class='post entry'>", "<div class='entry-content'>",
           "<div class='article-body'>", "<section class='article'>", "<div id='main'><div class='text'>", "<div role='main'>", "<div class='story'>", "<div class='page-content'>"]
SIDE = ["<aside>", "<aside class='sidebar'>", "<div class='sidebar'>", "<div id='sidebar'>", "<div class='side-bar widget'>", "<div class='related'>", "<section class='related-posts'>", "<div class='recommended'>",
        "<div class='widget'>", "<div class='popular trending'>", "<aside class='related-links'>"]
TOP = ["<header>", "<header class='site-header'>", "<div class='header'>", "<div id='header'>", "<div class='masthead'>", "<div class='topbar'>", "<div class='site-title logo'>", "<div role='banner'>"]
MENU = ["<nav>", "<nav class='menu'>", "<div class='nav'>", "<div class='menu'>", "<div id='navigation'>", "<div class='navbar'>", "<div role='navigation'>", "<ul class='breadcrumb'>", "<div class='breadcrumbs'>", "<menu>", "<div class='pagination'>", "<div class='tags'>"]
NOTICE = ["<div class='notice'>", "<div class='cookie-notice'>", "<div id='cookie-banner'>", "<div class='cookie consent'>", "<div class='alert'>", "<div class='banner'>", "<div class='popup modal'>", "<div class='gdpr'>", "<dialog>", "<div role='alert'>",
          "<div class='subscribe newsletter'>", "<div class='paywall'>", "<div class='disclaimer'>", "<section class='notice'>", "<p class='notice'>", "<div class='cookie'>", "<div class='cookies'>", "<div class='warning message'>"]
ADVERT = ["<div class='ad'>", "<div class='ads'>", "<div class='advert'>", "<div class='advertisement'>", "<div class='sponsored'>", "<div class='promo'>", "<ins class='adsbygoogle'><div class='ad-slot'>", "<aside class='ad'>", "<p class='ad'>", "<section class='promotion sponsor'>", "<div id='ad-top'>"]
COMMENTS = ["<section class='comments'>", "<section id='comments'>", "<div id='comments'>", "<div class='comments'>", "<div class='comment-list'>", "<ol class='commentlist'>", "<div class='comment'>", "<div class='replies discussion'>", "<div id='disqus' class='thread'>", "<ul class='comments'>", "<div class='reader-comments'>", "<aside class='comments'>"]
FOOT = ["<footer>", "<footer class='site-footer'>", "<div class='footer'>", "<div id='footer'>", "<div class='copyright'>", "<div role='contentinfo'>", "<div class='legal imprint'>", "<div class='share social'>", "<div class='author-bio byline'>"]
FORM = ["<form>", "<form class='search'>", "<form id='login'>", "<div class='search'><form>", "<form class='newsletter'>", "<fieldset>", "<div class='form contact'>"]
LEAF, WRAP = ["<p>", "<p>", "<p>", "<div>", "<li>", "<h2>", "<h3>"], ["", "", "", "<div>", "<div class='wrapper'>", "<div id='page'>", "<div class='container'><div class='row'>", "<main>", "<table><tr><td>"]


def _close(opened: str) -> str:
    return "".join(f"</{t}>" for t in reversed(re.findall(r"<(\w+)", opened)))


def layout(r: random.Random, texts: list[str]) -> tuple[str, list[int]]:
    """A page of random layout and the label of each of its blocks."""
    labels: list[int] = []

    def say(least: int, most: int) -> str:
        words = r.choice(texts).split()
        a = r.randrange(max(1, len(words) - most + 1))
        return " ".join(words[a : a + r.randint(least, most)])

    def leaf(tag: str, words: str, label: int, close: bool = True) -> str:
        labels.append(label)
        inner = r.choice(["{}", "{}", "{}", "<b>{}</b>", "<b>{}<br>", "<em>{}</em>", "<span class='text'>{}</span>"]).format(words)
        return tag + inner + (_close(tag) if close else "")

    def deep(chance: float = 0.04) -> str:
        return "".join(r.choice(["<div>", "<div>", "<section>"]) for _ in range(r.randint(20, 40))) if r.random() < chance else ""

    def group(opened: str, items: list[str]) -> str:
        body = "".join(items)
        if "<p" not in opened and (nest := deep()):
            body = nest + body + _close(nest)
        return opened + body + (_close(opened) if r.random() < 0.98 else "")

    def links() -> list[str]:
        shape = r.choice(["<li>", "<li>", "<div>", "<p>"])
        return [leaf(shape, f"<a href='/x'>{say(1, 4)}</a>", 0) for _ in range(r.randint(2, 9))]

    def prose(least: int, most: int, tags=None) -> list[str]:
        return [leaf(r.choice(tags or LEAF), say(3, 40), 0) for _ in range(r.randint(least, most))]

    def inputs() -> list[str]:
        return [leaf(r.choice(["<label>", "<button>", "<option>", "<legend>", "<p>"]), say(1, 6), 0) + r.choice(["<input>", ""]) for _ in range(r.randint(1, 5))]

    def comments() -> str:
        each = r.choice(["<div class='comment'>", "<li>", "<article class='comment'>", "<div>", "", "<blockquote>"])
        return group(r.choice(COMMENTS), [each + leaf("<p>", say(3, 60), 0) + _close(each) for _ in range(r.randint(1, 6))])

    def boiler(kind: int) -> str:
        if kind == 0:
            opened = r.choice(MENU)
            return group(opened + ("<ul>" if r.random() < 0.7 else ""), links())
        if kind == 1:
            return group(r.choice(TOP), [leaf(r.choice(["<h1>", "<p>", "<div>", "<h2>"]), say(1, 8), 0)] + (links() if r.random() < 0.3 else []))
        if kind == 2:
            return group(r.choice(SIDE), links() if r.random() < 0.5 else prose(1, 5))
        if kind == 3:
            opened = r.choice(NOTICE)
            return leaf(opened, say(3, 30), 0) if "<p" in opened or r.random() < 0.5 else group(opened, prose(1, 2, ["<p>", "<div>"]) + ([leaf("<button>", say(1, 2), 0)] if r.random() < 0.5 else []))
        if kind == 4:
            opened = r.choice(ADVERT)
            return leaf(opened, say(3, 40), 0) if "<p" in opened or r.random() < 0.6 else group(opened, prose(1, 3))
        if kind == 5:
            return group(r.choice(FORM), inputs())
        if kind == 6:
            return comments()
        opened = r.choice(FOOT)
        return leaf(opened, say(3, 30), 0) if r.random() < 0.5 else group(opened, prose(1, 3) if r.random() < 0.6 else links())

    def article() -> str:
        opened, parts = r.choice(ARTICLE[:2] if r.random() < 0.4 else ARTICLE), []
        if r.random() < 0.8:
            parts.append(leaf("<h1>", say(2, 12), 1))
        for _ in range(r.choice([1, 2, 4, 8, 16, 30])):
            draw = r.random()
            if draw < 0.75:
                parts.append(leaf("<p>", say(1, 80), 1, r.random() < 0.85))
            elif draw < 0.82:
                parts.append(leaf(r.choice(["<h2>", "<h3>", "<h4>"]), say(1, 9), 1))
            elif draw < 0.88:
                parts.append("<ul>" + "".join(leaf("<li>", say(1, 20), 1) for _ in range(r.randint(1, 5))) + "</ul>")
            elif draw < 0.93:
                parts.append(leaf(r.choice(["<blockquote>", "<pre>", "<div>", "<figcaption>", "<table><tr><td>", "<p class='lead'>", "<section><p>"]), say(2, 40), 1))
            elif draw < 0.97:
                parts.append(boiler(r.choice([3, 4, 4, 2, 5, 7])))
            else:
                parts.append(leaf("<p>", f"{say(2, 9)} <a href='/y'>{say(1, 5)}</a> {say(1, 20)}", 1))
        if r.random() < 0.12:
            parts.append(comments())
        nest = deep(0.08)
        return opened + nest + "".join(parts) + _close(nest) + _close(opened)

    wrap, around = r.choice(WRAP), deep(0.06)
    before = [boiler(k) for k in r.sample([0, 1, 2, 3, 4, 5], r.randint(0, 4))]
    middle = article()
    after = [boiler(k) for k in r.sample([0, 2, 3, 4, 5, 6, 6, 7, 7], r.randint(0, 5))]
    return "<html><body>" + around + "".join(before) + wrap + middle + (_close(wrap) if r.random() < 0.7 else "") + "".join(after) + "</body></html>", labels


def train(texts: list[str], layouts: int = 3000, epochs: int = 4, batch: int = 16, seed: int = 5, rate: float = 0.01) -> dict[str, np.ndarray]:
    """The network fitted to ``layouts`` composed pages: Adam on batches of pages of like length."""
    r, examples = random.Random(seed), []
    while len(examples) < layouts:
        html, labels = layout(r, texts or ["text"])
        page = blocks(html)
        if page and len(page) == len(labels):
            examples.append((*features(page), np.array(labels, np.float32)))
    examples.sort(key=lambda e: len(e[3]))
    net, step = initial(), 0
    first, second = ({k: np.zeros_like(v) for k, v in net.items()} for _ in range(2))
    groups = [examples[i : i + batch] for i in range(0, len(examples), batch)]
    for epoch in range(epochs):
        r.shuffle(groups)
        for group in groups:
            paths, words, measures, mask = _padded(group)
            labels = np.zeros(mask.shape, np.float32)
            for i, e in enumerate(group):
                labels[: len(e[3]), i] = e[3]
            step += 1
            pace = rate * (1 - step / (epochs * len(groups) + 1))
            for k, g in gradients(net, paths, words, measures, mask, labels).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                net[k] = (net[k] - pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def label(net, pages: list[list[Block]], budget: int = 6_000, block: int = 2048) -> list[np.ndarray]:
    """Article (True) or not for every block of every page; pages of like length share a pass.

    Features are projected ``block`` blocks at a time, and no step's states are kept.
    """
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    a = 0
    while a < len(order):
        b = a + 1
        while b < len(order) and (b - a + 1) * len(pages[order[b]]) <= budget:
            b += 1
        own = order[a:b]
        read_of = [(np.concatenate([project(net, *features(pages[i], k, k + block)) for k in range(0, len(pages[i]), block)]),) for i in own]
        p, _ = read(net, *_padded(read_of), keep=False)
        for j, i in enumerate(own):
            out[i] = p[: len(pages[i]), j] > 0.5
        a = b
    return out


def sample_texts(df: DataFrame, html: str = "html", rows: int = 200) -> list[str]:
    """Block texts of at most ``rows`` pages, those with the smallest hash: material for the training layouts."""
    hashed = df.where(F.col(html).isNotNull()).select(F.xxhash64(html).alias("h"), F.substring(html, 1, 20_000).alias("html"))
    least = [r["h"] for r in hashed.select("h").distinct().orderBy("h").limit(rows).collect()]  # only numbers are sorted
    picked = hashed.where(F.col("h") <= least[-1]).dropDuplicates(["h"]).orderBy("h").collect() if least else []
    texts = [b.text for r in picked for b in blocks(r["html"])]
    return [t for t in texts if len(t.split()) > 3] or texts


def extract(df: DataFrame, net: dict[str, np.ndarray], key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every row."""
    sent = df.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 256):
                batch = whole.slice(a, 256)
                pages = [blocks(h) if h else [] for h in batch.column(2).to_pylist()]
                texts = ["\n".join(b.text for b, keep in zip(p, own) if keep) for p, own in zip(pages, label(sent.value, pages))]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return df.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).alias("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")


_trained: dict[int, dict[str, np.ndarray]] = {}


def fitted(df: DataFrame, html: str = "html") -> dict[str, np.ndarray]:
    """The network for a table, trained once a process for each sample."""
    texts = sample_texts(df, html)
    known = zlib.crc32("\n".join(texts).encode("utf-8", "replace"))
    if known not in _trained:
        _trained.clear()
        _trained[known] = train(texts)
    return _trained[known]
