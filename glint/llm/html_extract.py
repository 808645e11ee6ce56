"""Main-text extraction by a recurrent block labeller.

A page becomes its sequence of leaf blocks (runs of text between block-level
tags). Every block has a vector: hashed tokens of its tag path (names, class
and id words of the open elements, weaker the farther out), hashed words, and
a few shape figures, among them the share of the page's text that its
container and the containers inside it hold, and whether it lies outside
the article or main element of a page that has one. A bidirectional LSTM in numpy
reads the whole sequence, so each block is labelled with the document around
it; blocks labelled as main text are joined.

There is no labelled page table, so the labeller is trained here, on a
bounded sample of `sample_pages` distinct pages: the innermost element whose
name or class a lexicon knows (navigation, advert, comment, article, ...)
labels each sampled block, and copies of the pages with renamed wrappers,
lists, tables, quotes and code inside the article, added boilerplate of every
kind, whole pages inside a form and hidden class words teach it to use other
names and the context. Pages are labelled in the tasks, all of them whole.

Defined cases: a null or empty page gives an empty text; a page without a
main block too; classes of html and body say nothing; markup that is cut off is dropped, open raw elements
(script, style, title, textarea, noscript, iframe) run to the end; svg, math,
object, video, select, template and the like are elements as any other, whose
blocks are labelled; malformed references stay as they are;
repeated pages give the same text."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

# Element kinds of HTML.
RAW = "script style title textarea noscript iframe".split()
FOREIGN = "svg math".split()  # the only elements that "/>" closes
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr nobr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SELF_NESTED = frozenset("li dt dd tr td th option p".split())

# quotes count only after "="
_ATTRS = r"(?:[^>=]++|=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))?)*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>]|\Z)" + _ATTRS + r"(?:>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>" + _ATTRS + r")(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)|(?P<text>[^<]+|<)", re.S | re.I)
_ATTR = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[a-z]+")

# Words of element names, classes and ids.
BOILER = frozenset(
    "nav navbar navigation menu header masthead footer foot aside sidebar form login search ad ads advert adverts "
    "advertisement sponsor sponsored banner promo cookie cookies consent notice alert popup modal overlay newsletter "
    "subscribe signup share sharing social related recommended breadcrumb breadcrumbs pagination pager toolbar widget "
    "comment comments comentarios disqus discussion replies reply respond legal copyright disclaimer skip button "
    "topbar toc teaser gdpr privacy feedback pagefooter siteheader".split())
MAIN = frozenset("article main content post entry story text articlebody body prose".split())

# Classes such as "no-sidebar" say what an element lacks, has elsewhere or is.
STATE_WORDS = frozenset("no not non has have with without hide hidden is js".split())
# Elements of a text: the block's container is what is around them.
TEXT_PARTS = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th pre blockquote figure figcaption hgroup".split())

PATH_DIM, WORD_DIM = 160, 24
SHAPE = 15
FADE = 0.75  # of a path word, an element farther out
DIM = PATH_DIM + WORD_DIM + SHAPE


# --- blocks ---------------------------------------------------------------

@lru_cache(65_536)
def _path_words(name: str, attrs: str) -> tuple[str, ...]:
    words = [name]
    if name in ("html", "body"):
        return (name,)
    for m in _ATTR.finditer(attrs):
        for token in (m[2] or m[3] or m[4] or "").split():
            parts = _WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower())
            words += ["-".join(parts)] if parts and parts[0] in STATE_WORDS else parts
    return tuple(words)


def blocks(html: str) -> list[tuple[tuple, str, int]]:
    """(path as a tuple of word tuples, text, characters inside links)."""
    out, stack, parts, links, in_a = [], [], [], 0, 0

    def flush():
        nonlocal parts, links
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                out.append((tuple(w for _, w in stack), text, min(links, len(text))))
            parts, links = [], 0

    for m in _TOKEN.finditer(html):
        t = m["text"]
        if t is not None:
            parts.append(t)
            links += len(t) * (in_a > 0)
            continue
        if m["raw"]:
            parts.append(" ")
            continue
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name in INLINE:
            if name == "a":
                in_a = 0 if m["close"] else 1
            elif name == "br":
                parts.append(" ")
            continue
        flush()
        if m["close"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
            continue
        in_a = 0 if name not in VOID else in_a
        if name in CLOSES_P or name in SELF_NESTED:
            shut = "p" if name in CLOSES_P else name
            if stack and stack[-1][0] == shut:
                stack.pop()
        if name not in VOID and not (name in FOREIGN and m["attrs"].endswith("/")):
            stack.append((name, _path_words(name, m["attrs"])))
    flush()
    return out


def teacher(path: tuple) -> int:
    """1 main, 0 boilerplate, -1 unknown: the innermost element that the
    lexicon knows decides. A heading group of an article is part of it, and a
    form around all of a page may be the page itself."""
    for i in range(len(path) - 1, -1, -1):
        part = path[i]
        if part[0] == "header" and any(p[0] in ("article", "main") for p in path[:i]):
            continue
        if part == ("form",) and all(p[0] in ("html", "body", "div") and len(p) == 1 for p in path[:i]):
            continue
        if any(w in BOILER for w in part):
            return 0
        if any(w in MAIN and w != "body" for w in part[:1]) or any(w in MAIN for w in part[1:]):
            return 1
    return -1


# --- features -------------------------------------------------------------

@lru_cache(200_000)
def _bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % WORD_DIM


@lru_cache(65_536)
def _path_vector(path: tuple) -> np.ndarray:
    v = np.zeros(PATH_DIM, np.float32)
    for depth, part in enumerate(reversed(path)):
        for w in part:
            h = zlib.crc32(w.encode("utf-8", "surrogatepass"))
            for k in range(3):  # three places a word, as a Bloom filter
                at = (h >> (8 * k)) % PATH_DIM
                v[at] = max(v[at], FADE**depth)
    return v


def _container(path: tuple) -> tuple:
    n = len(path)
    while n and path[n - 1][0] in TEXT_PARTS:
        n -= 1
    return path[:n]


def _shares(page: list[tuple[tuple, str, int]]) -> list[tuple[float, float, float]]:
    """Per block, of the page's prose (text outside links): the share inside
    its container, inside the element around that, and the container's rank
    as a share of the largest container's own prose."""
    own, inside, total = {}, {}, 0
    holders = [_container(path) for path, _, _ in page]
    for c, (_, text, links) in zip(holders, page):
        n = len(text) - links
        total += n
        own[c] = own.get(c, 0) + n
    for c, n in own.items():
        for i in range(len(c) + 1):
            inside[c[:i]] = inside.get(c[:i], 0) + n
    total, most = max(1, total), max(1, max(own.values(), default=0))
    return [(inside[c] / total, inside[c[:-1]] / total, own[c] / most) for c in holders]


def features(page: list[tuple[tuple, str, int]]) -> np.ndarray:
    x, n = np.zeros((len(page), DIM), np.float32), len(page)
    marks = [(any(marked), marked) for name in ("article", "main") for marked in [[any(part[0] == name for part in path) for path, _, _ in page]]]
    for i, ((path, text, links), share) in enumerate(zip(page, _shares(page))):
        words = text.split(" ")
        x[i, :PATH_DIM] = _path_vector(path)
        counts = np.bincount([_bucket(w) for w in words], minlength=WORD_DIM)
        x[i, PATH_DIM: PATH_DIM + WORD_DIM] = np.sqrt(counts / len(words))
        x[i, PATH_DIM + WORD_DIM:] = (
            min(1.0, np.log1p(len(text)) / 8), min(1.0, np.log1p(len(words)) / 6), links / len(text),
            text[-1] in ".!?:;\"'", sum(map(text.count, ".,;")) / len(words), i / n, (n - i) / n, min(1.0, len(path) / 10), *share,
            *(float(v) for has, marked in marks for v in (has and marked[i], has and not marked[i])))
    return x


# --- the network ----------------------------------------------------------

def _sig(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    def __init__(self, hidden: int = 20, seed: int = 1):
        r = np.random.default_rng(seed)
        self.h = hidden
        w = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {}
        for d in "fb":
            self.p |= {f"W{d}": w(DIM, 4 * hidden), f"U{d}": w(hidden, 4 * hidden), f"c{d}": np.zeros(4 * hidden, np.float32)}
            self.p[f"c{d}"][hidden: 2 * hidden] = 1  # remember at first
        self.p |= {"V": w(2 * hidden, 1)[:, 0], "D": w(DIM, 1)[:, 0] * 0.1, "o": np.zeros(1, np.float32)}

    def _run(self, x, mask, d):
        """One direction over (pages, blocks, DIM)."""
        n, t, _ = x.shape
        h, c, H = np.zeros((n, self.h), np.float32), np.zeros((n, self.h), np.float32), self.h
        z = x @ self.p["W" + d] + self.p["c" + d]
        states, out = [None] * t, np.zeros((n, t, H), np.float32)
        for i in range(t) if d == "f" else range(t - 1, -1, -1):
            g = z[:, i] + h @ self.p["U" + d]
            a = _sig(g[:, : 3 * H])
            u = np.tanh(g[:, 3 * H:])
            m = mask[:, i, None]
            c2 = m * (a[:, H: 2 * H] * c + a[:, :H] * u) + (1 - m) * c
            tc = np.tanh(c2)
            h2 = m * (a[:, 2 * H:] * tc) + (1 - m) * h
            states[i] = (h, c, a, u, tc)
            h, c = h2, c2
            out[:, i] = h
        return out, states

    def score(self, x, mask):
        return self._forward(x, mask)[0]

    def _forward(self, x, mask):
        f, sf = self._run(x, mask, "f")
        b, sb = self._run(x, mask, "b")
        both = np.concatenate((f, b), 2)
        return _sig(both @ self.p["V"] + x @ self.p["D"] + self.p["o"]), both, sf, sb

    def gradients(self, x, mask, y, known):
        p, both, sf, sb = self._forward(x, mask)
        e = ((p - y) * known / max(1.0, known.sum())).astype(np.float32)
        grad = {"V": np.einsum("nt,nth->h", e, both), "D": np.einsum("nt,ntd->d", e, x), "o": e.sum(keepdims=True)[0]}
        dh_all, H = e[:, :, None] * self.p["V"], self.h
        for d, states, part in (("f", sf, slice(0, H)), ("b", sb, slice(H, None))):
            dz = np.zeros((*x.shape[:2], 4 * H), np.float32)
            dh, dc = np.zeros((len(x), H), np.float32), np.zeros((len(x), H), np.float32)
            gu, t = np.zeros_like(self.p["U" + d]), x.shape[1]
            for i in range(t - 1, -1, -1) if d == "f" else range(t):
                h, c, a, u, tc = states[i]
                m = mask[:, i, None]
                dh = dh + dh_all[:, i, part]
                dcur = m * (dc + dh * a[:, 2 * H:] * (1 - tc**2))
                dg = np.concatenate((
                    dcur * u * a[:, :H] * (1 - a[:, :H]), dcur * c * a[:, H: 2 * H] * (1 - a[:, H: 2 * H]),
                    m * dh * tc * a[:, 2 * H:] * (1 - a[:, 2 * H:]), dcur * a[:, :H] * (1 - u**2)), 1)
                dz[:, i] = dg
                gu += h.T @ dg
                dh = dg @ self.p["U" + d].T + (1 - m) * dh
                dc = dcur * a[:, H: 2 * H] + (1 - m) * dc
            grad |= {"W" + d: np.einsum("ntd,ntk->dk", x, dz, optimize=True), "U" + d: gu, "c" + d: dz.sum((0, 1))}
        return grad

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 12, batch: int = 32, rate: float = 0.01) -> None:
        """Adam over batches of pages of like length; labels -1 don't count."""
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        order = sorted(range(len(pages)), key=lambda i: len(pages[i][1]))
        groups = [order[i: i + batch] for i in range(0, len(order), batch)]
        rng, step = np.random.default_rng(3), 0
        for epoch in range(epochs):
            for g in rng.permutation(len(groups)):
                x, mask = padded([pages[i][0] for i in groups[g]])
                y = np.full(mask.shape, -1.0, np.float32)
                for j, i in enumerate(groups[g]):
                    y[j, : len(pages[i][1])] = pages[i][1]
                step += 1
                for k, d in self.gradients(x, mask, y, (y >= 0) * mask).items():
                    m[k] += 0.1 * (d - m[k])
                    v[k] += 0.001 * (d * d - v[k])
                    size = rate * (1 - 0.8 * epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    self.p[k] = (self.p[k] - size * m[k] / (np.sqrt(v[k]) + 1e-8)).astype(np.float32)


def padded(xs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    t = max(map(len, xs))
    x, mask = np.zeros((len(xs), t, DIM), np.float32), np.zeros((len(xs), t), np.float32)
    for j, a in enumerate(xs):
        x[j, : len(a)], mask[j, : len(a)] = a, 1
    return x, mask


# --- training pages -------------------------------------------------------

def _varied(page, others: list[str], rng) -> tuple[list, list[int]]:
    """A page with other wrappers around its blocks and more boilerplate;
    the blocks and their labels."""
    pick = lambda *x: x[rng.integers(len(x))]
    main = pick(
        (("article",),), (("main",),), (("div", "content"),), (("div", "post", "body"),), (("section", "entry"),),
        (("div", "main", "content"), ("article",)), (("div", "story", "text"),), (("main",), ("section",)), (("div",), ("article", "post")))
    junk = {0: pick((("nav",), ("ul",)), (("div", "menu"),), (("ul", "navbar", "nav"),), (("header",), ("nav",)), (("div", "breadcrumb"),)),
            1: pick((("div", "ad"),), (("div", "advert"),), (("div", "banner"),), (("div", "sponsored"),), (("ins", "ads"),)),
            2: pick((("footer",),), (("div", "footer"),), (("div", "copyright", "legal"),))}
    out, labels = [], []

    def add(path, text, links, label):
        out.append(((("html",), ("body",), *path), text, links))
        labels.append(label)

    def extra(kinds):
        for _ in range(rng.integers(0, 3)):
            path = pick(*kinds)
            for _ in range(rng.integers(1, 4)):
                words = others[rng.integers(len(others))].split(" ")
                at, n = rng.integers(len(words)), int(rng.choice([2, 5, 12, 40]))
                text = " ".join(words[at: at + n])
                if text:
                    leaf = pick((("p",),), (("li",),), (("div",),), (), (("h3",),), (("button",),))
                    add((*path, *leaf), text, len(text) * int(rng.random() < 0.3), 0)

    def element():
        """A list, table, quote, code or subheading of the article."""
        leaf, n = pick(
            ((("ul",), ("li",)), 4), ((("ol",), ("li",)), 4), ((("table",), ("tr",), ("td",)), 5), ((("table",), ("tbody",), ("tr",), ("td",)), 6),
            ((("table",), ("thead",), ("tr",), ("th",)), 3), ((("blockquote",),), 1), ((("blockquote",), ("p",)), 2), ((("pre",),), 1), ((("h2",),), 1),
            ((("h3",),), 1), ((("dl",), ("dt",)), 1), ((("dl",), ("dd",)), 2), ((("figure",), ("figcaption",)), 1), ((("section",), ("p",)), 2),
            ((("section",), ("h2",)), 1), ((("div",),), 2), ((("div",), ("p",)), 2))
        for _ in range(rng.integers(1, n + 1)):
            words = others[rng.integers(len(others))].split(" ")
            at, long = rng.integers(len(words)), int(rng.choice([1, 3, 8, 30]))
            text = " ".join(words[at: at + long])
            if text:
                add((*main, *leaf), text, len(text) * int(rng.random() < 0.1), 1)

    top = [(("header",),), (("div", "header", "masthead"),), (("div",),), (("div", "cookie", "notice"),), (("div", "consent", "banner"),),
           (("form", "search"),), (("div", "alert", "notice"),), (("form", "login"),)]
    late = [(("aside", "sidebar"),), (("section", "comments"),), (("div", "comment", "list"),), (("ol", "comments"), ("li", "comment")),
            (("form", "newsletter"),), (("div", "related"),), (("div", "share", "social"),), (("aside",),), (("div", "sidebar"),),
            (("div", "popup", "modal"),), (("form",),), (("div", "widget"),)]
    late += [(("main",), *p) for p in late[:6]] * (main[0] == ("main",))
    inner = [(*main[: rng.integers(1, len(main) + 1)], *p) for p in ((("div", "ad"),), (("aside",),), (("div", "share"),), (("section", "comments"),), (("div", "comment"),),
                                    (("form",),), (("div", "notice"),), (("figure", "advert"),), (("nav",),), (("ul", "menu"),), (("div", "related"),))]
    extra(top)
    mains, rich = sum(teacher(b[0]) == 1 for b in page), rng.random() < 0.6
    seen = 0
    for path, text, links in page:
        label = teacher(path)
        leaf = (path[-1],) if path and path[-1][0] in ("p", "li", "h1", "h2", "h3", "div", "td", "blockquote", "pre") else ()
        leaf = (leaf[0][:1],) if leaf else ()
        if label == 1:
            seen += 1
            if seen == 1 and leaf and leaf[0][0] in ("h1", "h2") and rng.random() < 0.3:
                leaf = (("header",), *leaf)
            add((*main, *(leaf or pick((("p",),), ()))), text, links, 1)
            if rich and rng.random() < 0.3:
                element()
            if seen in (mains // 3, 2 * mains // 3) and rng.random() < 0.4:
                extra(inner)
        elif label == 0:
            words = {w for part in path for w in part}
            kind = 2 if "footer" in words else 0 if words & {"nav", "menu", "header"} else 1
            add((*junk[kind], *leaf), text, links, 0)
    for _ in range(2):
        extra(inner if rng.random() < 0.4 else late)
    extra(late)
    if rng.random() < 0.15:  # the page lies in a form, or in plain boxes
        box = pick((("form",),), (("form",), ("div",)), (("div",),), (("div",), ("div",)))
        out = [((*path[:2], *box, *path[2:]), text, links) for path, text, links in out]
    if rng.random() < 0.4:  # names that say nothing: the context must do
        share, salt = pick(0.3, 1.0), int(rng.integers(1 << 20))
        spare = MAIN if rng.random() < 0.5 else ()
        hide = {w for path, _, _ in out for part in path for w in part[1:] if w not in spare and rng.random() < share}
        out = [(tuple(tuple(f"x{salt + zlib.crc32(w.encode()) % 997}" if w in hide else w for w in part) for part in path), t, k) for path, t, k in out]
    return out, labels


def fit(pages: list[str], copies: int = 3, seed: int = 1) -> Labeller:
    """Train on a bounded list of raw pages."""
    rng, data = np.random.default_rng(seed), []
    read = [b[:400] for b in map(blocks, pages) if b]  # training sequences are bounded, labelling is not
    others = [t for b in read for _, t, _ in b] or ["text"]
    for b in read:
        y = np.array([teacher(p) for p, _, _ in b])
        if (y >= 0).any():
            data.append((features(b), y))
        if (y == 1).any():
            for _ in range(copies):
                v, labels = _varied(b, others, rng)
                data.append((features(v), np.array(labels)))
    model = Labeller()
    if data:
        model.train(data)
    return model


def label_pages(model: Labeller, pages: list[list]) -> list[np.ndarray]:
    """Per page, which blocks are main text; pages of like length are run
    together."""
    out: list = [np.zeros(0, bool)] * len(pages)
    order = [i for i in sorted(range(len(pages)), key=lambda i: len(pages[i])) if pages[i]]
    at = 0
    while at < len(order):
        size = max(1, min(64, 20_000 // max(1, len(pages[order[at]])), len(order) - at))
        part = order[at: at + size]
        x, mask = padded([features(pages[i]) for i in part])
        p = model.score(x, mask)
        for j, i in enumerate(part):
            out[i] = p[j, : len(pages[i])] > 0.5
        at += size
    return out


def _extract(model: Labeller):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                pages = [blocks(h or "") for h in part.column(2).to_pylist()]
                texts = ["\n\n".join(t for (_, t, _), k in zip(p, keep) if k) for p, keep in zip(pages, label_pages(model, pages))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    return run


def extract_main(
    pages: DataFrame, sample_pages: int = 300, sample_chars: int = 50_000,
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """page_id, url, text, n_chars for every row of `pages`. Training reads
    at most `sample_pages` distinct pages of at most `sample_chars`
    characters, chosen by a hash."""
    small_batches(pages.sparkSession)
    fitting = pages.select(F.col(html_col).alias("html")).where(F.length("html").between(1, sample_chars))
    h = F.xxhash64("html")
    n = fitting.agg(F.approx_count_distinct(h)).first()[0]  # copies of a page count once
    share = min(1.0, 2.0 * sample_pages / max(1, n))
    sample = fitting.where(F.pmod(h, F.lit(1 << 20)) / float(1 << 20) < share).withColumn("h", h).groupBy("h").agg(
        F.first("html").alias("html")).orderBy("h").limit(sample_pages)
    model = fit([r.html for r in sample.collect()])
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kinds = [rows.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return rows.mapInArrow(_extract(model), f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")


def op5_html(spark, sf_dir) -> DataFrame:
    return extract_main(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
