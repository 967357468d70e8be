"""Main text of web pages by a recurrent block labeller.

A page is read into its sequence of leaf blocks: runs of text between block
tags, each with the tags, classes and ids above it. A bidirectional LSTM (numpy)
reads a vector per block, hashed tag path, hashed words and a few counts, and
labels every block in the context of the whole page. It is trained here: a
bounded sample of the pages that have semantic tags is labelled by them, and laid
out anew in many ways (plain divisions with telling class names, notices, forms, reader
comments, boilerplate inside the article), where the labels are known.

Blocks of the article are joined in page order by two line feeds. White space
inside a block, a line break tag too, becomes one space; character references
are decoded once. Scripts, styles, comments and other raw elements are no text.

Defined results: null or empty html, and pages without any block of text, give
an empty text. Markup that never ends is read as text, but comments, scripts and
styles go on to the page's end; a raw element that never ends loses its tag only.
A self-closing svg tag is empty, text of formulas is text. Repeated rows are each
extracted; extra columns pass by. If no page of the table has text under a semantic
tag (an empty table too), nothing can be learned: then a block is text unless a tag,
class or id above it names what is no article (``OUTSIDE``).
"""

from __future__ import annotations

import html as references
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import hash_below, map_batches, of_this_process

#: What every page with semantic tags has, if maybe inside a comment or script.
SEMANTIC = r"(?i)<(?:article|main)[\s/>]"
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>""")
NAMES = re.compile(r"""(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
WORD = re.compile(r"\w+")
RAW = frozenset("script style noscript template textarea title iframe object svg canvas audio video select datalist".split())
#: The slash after an unquoted value belongs to that.
UNQUOTED = re.compile(r"""=\s*[^\s"'=<>`]+$""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html label legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: A new one of these ends an open one of the same kind, up to its container.
ENDS_ITSELF = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",)}

PATH_DIM, WORD_DIM, COUNT_DIM = 96, 48, 6
INPUT = PATH_DIM + WORD_DIM + COUNT_DIM
HIDDEN = 16
#: Trained on about so many pages that have semantic tags, each in its own and in new layouts.
SAMPLE_PAGES = 200
LAYOUTS = 3
#: Blocks of a page that one training sequence spans.
WINDOW = 64
PAGES_AT_ONCE = 128


@dataclass
class Leaf:
    text: str
    path: tuple[str, ...]
    linked: int  # characters inside links


def leaves(html: str | None) -> list[Leaf]:
    """The blocks of text of a page, in order."""
    out: list[Leaf] = []
    if not html:
        return out
    stack: list[tuple[str, tuple[str, ...]]] = []
    # How often each tag, class and id is open, in the order of their first places; the
    # names as a path, made anew after a change; where each tag is open.
    opened: dict[str, int] = {}
    path: tuple[str, ...] | None = ()
    places: dict[str, list[int]] = {}
    pieces: list[str] = []
    links, linked = 0, 0
    at, n, last_end = 0, len(html), html.rfind(">")
    lower = None
    endless: set[str] = set()  # raw elements without an end from here on

    def add(raw: str) -> None:
        nonlocal linked
        text = references.unescape(raw)
        pieces.append(text)
        if links:
            linked += len(text.strip())

    def push(name: str, tokens: tuple[str, ...]) -> None:
        nonlocal path
        places.setdefault(name, []).append(len(stack))
        stack.append((name, tokens))
        for t in tokens:
            count = opened.get(t, 0)
            opened[t] = count + 1
            path = path if count else None

    def cut(depth: int) -> None:
        """Close all elements from ``depth`` on."""
        nonlocal path
        while len(stack) > depth:
            name, tokens = stack.pop()
            places[name].pop()
            for t in tokens:
                opened[t] -= 1
                if not opened[t]:
                    del opened[t]
                    path = None

    def flush() -> None:
        nonlocal linked, path
        text = " ".join("".join(pieces).split())
        pieces.clear()
        if text:
            path = tuple(opened) if path is None else path
            out.append(Leaf(text, path, linked))
        linked = 0

    while at < n:
        start = html.find("<", at)
        if start < 0 or start > last_end:
            add(html[at:])
            break
        if start > at:
            add(html[at:start])
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4)
            at = n if end < 0 else end + 3
            continue
        m = TAG.match(html, start)
        if not m:
            add("<")
            at = start + 1
            continue
        at = m.end()
        name = (m.group(2) or m.group(5) or "").lower()
        closing = m.group(1) or m.group(4)
        if name == "svg" and html.endswith("/>", start, at) and not UNQUOTED.search(m.group(3) or m.group(6) or ""):
            continue
        if name in RAW and not closing and name not in endless:
            lower = html.lower() if lower is None and html.isascii() else lower
            end = lower.find("</" + name, at) if lower is not None else next((x.start() for x in re.compile("</" + name, re.IGNORECASE).finditer(html, at)), -1)
            if end < 0 and name not in ("script", "style"):
                endless.add(name)
            else:
                at = n if end < 0 else end
            continue
        if name == "br":
            pieces.append(" ")
        elif name == "a":
            links = max(0, links + (-1 if closing else 1))
        if name not in BLOCK:
            continue
        flush()
        if closing:
            if places.get(name):
                cut(places[name][-1])
                links = 0
        elif name not in VOID:
            if stack and stack[-1][0] == "p":
                cut(len(stack) - 1)
            holders = ENDS_ITSELF.get(name)
            if holders and places.get(name) and places[name][-1] > max((places[h][-1] for h in holders if places.get(h)), default=-1):
                cut(places[name][-1])
            tokens = (name, *("." + p.lower() for value in NAMES.findall(m.group(3) or m.group(6) or "") for p in PART.findall(value)))
            push(name, tokens)
    flush()
    return out


def _bucket(token: str, size: int, held: dict) -> int:
    known = held.get((token, size))
    if known is None:
        if len(held) >= 200_000:
            held.clear()
        known = held[token, size] = zlib.crc32(token.encode("utf-8", "surrogatepass")) % size
    return known


def vectors(blocks: list[Leaf]) -> np.ndarray:
    x = np.zeros((len(blocks), INPUT), np.float32)
    held = of_this_process("buckets").setdefault("held", {})
    for i, (row, leaf) in enumerate(zip(x, blocks)):
        for token in leaf.path:
            row[_bucket(token, PATH_DIM, held)] += 1
        words = WORD.findall(leaf.text)
        if words:
            hashed = np.bincount([_bucket(w.lower(), WORD_DIM, held) for w in words], minlength=WORD_DIM)
            row[PATH_DIM : PATH_DIM + WORD_DIM] = np.sqrt(hashed / len(words))
        size = len(leaf.text)
        row[PATH_DIM + WORD_DIM :] = (np.log1p(size) / 5, min(1.0, leaf.linked / size), np.log1p(len(words)) / 4, sum(map(leaf.text.count, ".!?,;")) / size * 10, i / len(blocks), 1.0 if len(blocks) == 1 else 0.0)
    return x


class BiLstm:
    """A bidirectional LSTM with one logistic output per step."""

    def __init__(self, rng: np.random.Generator) -> None:
        wide = INPUT + HIDDEN + 1
        self.p = {d: (rng.standard_normal((wide, 4 * HIDDEN)) / np.sqrt(wide)).astype(np.float32) for d in ("forth", "back")}
        for d in ("forth", "back"):
            self.p[d][-1, HIDDEN : 2 * HIDDEN] = 1.0  # the forget gates begin open
        self.p["out"] = (rng.standard_normal(2 * HIDDEN + 1) / 4).astype(np.float32)

    @staticmethod
    def _sigmoid(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    def _run(self, x: np.ndarray, mask: np.ndarray, w: np.ndarray, keep: list | None) -> np.ndarray:
        """x: pages x steps x INPUT. A masked step leaves the state as it is."""
        b, steps, _ = x.shape
        h, c = np.zeros((b, HIDDEN), np.float32), np.zeros((b, HIDDEN), np.float32)
        out = np.zeros((b, steps, HIDDEN), np.float32)
        driven = x @ w[:INPUT] + w[-1]
        for t in range(steps):
            z = driven[:, t] + h @ w[INPUT:-1]
            i, f, o = (self._sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in (0, 1, 2))
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[:, t, None]
            new_c = f * c + i * g
            tc = np.tanh(new_c)
            if keep is not None:
                keep.append((h, c, i, f, o, g, tc, m))
            c = np.where(m, new_c, c)
            h = np.where(m, o * tc, h)
            out[:, t] = h
        return out

    def states(self, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        kept = {"forth": [], "back": []} if keep is not None else {"forth": None, "back": None}
        forth = self._run(x, mask, self.p["forth"], kept["forth"])
        back = self._run(x[:, ::-1], mask[:, ::-1], self.p["back"], kept["back"])[:, ::-1]
        if keep is not None:
            keep.update(kept)
        return np.concatenate((forth, back), axis=2)

    def predict(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        return self._sigmoid(self.states(x, mask) @ self.p["out"][:-1] + self.p["out"][-1])

    def _back(self, x: np.ndarray, grad: np.ndarray, kept: list, w: np.ndarray) -> np.ndarray:
        dw = np.zeros_like(w)
        dh, dc = np.zeros((len(x), HIDDEN), np.float32), np.zeros((len(x), HIDDEN), np.float32)
        for t in range(x.shape[1] - 1, -1, -1):
            h, c, i, f, o, g, tc, m = kept[t]
            dh = dh + grad[:, t]
            dh_in, dc_in = np.where(m, dh, 0), np.where(m, dc, 0)
            through = dc_in + dh_in * o * (1 - tc * tc)
            dz = np.concatenate((through * g * i * (1 - i), through * c * f * (1 - f), dh_in * tc * o * (1 - o), through * i * (1 - g * g)), axis=1)
            dw[:INPUT] += x[:, t].T @ dz
            dw[INPUT:-1] += h.T @ dz
            dw[-1] += dz.sum(0)
            dh = np.where(m, 0, dh) + dz @ w[INPUT:-1].T
            dc = np.where(m, through * f, dc)
        return dw

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        keep: dict = {}
        s = self.states(x, mask, keep)
        p = self._sigmoid(s @ self.p["out"][:-1] + self.p["out"][-1])
        pull = np.where(mask, p - y, 0).astype(np.float32) / max(1, mask.sum())
        ds = pull[:, :, None] * self.p["out"][:-1]
        return {
            "out": np.append(np.einsum("bt,bth->h", pull, s), pull.sum()).astype(np.float32),
            "forth": self._back(x, ds[:, :, :HIDDEN], keep["forth"], self.p["forth"]),
            "back": self._back(x[:, ::-1], ds[:, ::-1, HIDDEN:], keep["back"], self.p["back"]),
        }


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x, mask = np.zeros((len(pages), steps, INPUT), np.float32), np.zeros((len(pages), steps), bool)
    for i, p in enumerate(pages):
        x[i, : len(p)], mask[i, : len(p)] = p, True
    return x, mask


OUTSIDE = frozenset("nav footer aside form header menu button dialog .ad .ads .advert .sidebar .comments .comment .notice .cookie .menu .footer .header .related .share".split())


def semantic_labels(blocks: list[Leaf]) -> list[int] | None:
    """1 for blocks of the article by its tags; None if the page has no such tag."""
    if not any("article" in b.path or "main" in b.path for b in blocks):
        return None
    return [int(("article" in b.path or "main" in b.path) and not OUTSIDE.intersection(b.path)) for b in blocks]


#: Names that pages commonly give to their parts.
CONTENT_NAMES = ("content", "article", "post", "entry", "story", "main", "article-body", "post-content", "entry-content", "main-content", "page-text", "body-text")
WRAPPERS = {
    "nav": ("nav", "menu", "navbar", "navigation", "breadcrumb", "topnav", "main-menu", "site-nav", "links"),
    "header": ("header", "masthead", "banner", "site-header", "page-header", "top-bar", "logo"),
    "footer": ("footer", "site-footer", "page-footer", "bottom", "copyright", "legal", "colophon"),
    "aside": ("sidebar", "aside", "widget", "related", "side-column", "recommended", "popular", "more-stories", "share", "social", "tags"),
    "notice": ("notice", "cookie", "cookie-notice", "consent", "alert", "gdpr", "popup", "modal", "disclaimer", "subscribe"),
    "ad": ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-slot", "banner-ad"),
    "form": ("form", "newsletter", "signup", "login", "search", "subscribe-form", "contact-form"),
    "comments": ("comments", "comment", "comment-list", "replies", "discussion", "responses", "reader-comments", "thread"),
}
TAGS = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}


def new_layout(article: list[str], other: list[str], rng: np.random.Generator) -> tuple[list[Leaf], list[int]]:
    """A page of the given article blocks and of boilerplate from ``other``, by a
    random layout, with its labels."""
    blocks: list[Leaf] = []
    labels: list[int] = []

    def pick(names: tuple[str, ...]) -> tuple[str, ...]:
        name = names[rng.integers(len(names))]
        return tuple("." + p for p in PART.findall(name))

    def boilerplate(kind: str, above: tuple[str, ...]) -> None:
        tag = TAGS.get(kind, "section" if kind == "comments" and rng.random() < 0.3 else "div")
        semantic = rng.random() < 0.5 and kind in TAGS
        path = (*above, tag, *(() if semantic and rng.random() < 0.6 else pick(WRAPPERS[kind]))) if semantic else (*above, "div" if kind != "form" else "form", *pick(WRAPPERS[kind]))
        for _ in range(int(rng.integers(1, 8 if kind in ("nav", "comments") else 4))):
            words = other[rng.integers(len(other))].split()
            if kind in ("nav", "header", "form"):
                words = words[: int(rng.integers(1, 5))]
            text = " ".join(words) or "x"
            inner = {"nav": ("ul", "li"), "comments": ("p",), "form": ("label",)}.get(kind, ("p",) if rng.random() < 0.5 else ())
            blocks.append(Leaf(text, tuple(dict.fromkeys((*path, *inner))), len(text) if kind == "nav" or (kind in ("aside", "footer") and rng.random() < 0.5) else 0))
            labels.append(0)

    base = ("html", "body")
    for kind in ("notice", "header", "nav", "ad", "aside", "form"):
        if rng.random() < (0.7 if kind == "nav" else 0.4):
            boilerplate(kind, base)
    own = (*base, *(("article",) if rng.random() < 0.4 else ("main",) if rng.random() < 0.3 else ("div", *pick(CONTENT_NAMES))))
    for i, text in enumerate(article):
        tag = "h1" if i == 0 else ("h2", "li", "blockquote", "td", "pre")[rng.integers(5)] if rng.random() < 0.15 else "p"
        blocks.append(Leaf(text, tuple(dict.fromkeys((*own, *(("ul",) if tag == "li" else ("table", "tr") if tag == "td" else ()), tag))), int(len(text) * rng.random() * 0.3) if rng.random() < 0.2 else 0))
        labels.append(1)
        if rng.random() < 0.08:
            boilerplate(("ad", "aside", "form", "notice", "nav")[rng.integers(5)], own)
    if rng.random() < 0.5:
        boilerplate("comments", own if rng.random() < 0.5 else base)
    for kind in ("aside", "form", "ad", "nav", "footer"):
        if rng.random() < (0.8 if kind == "footer" else 0.35):
            boilerplate(kind, base)
    return blocks, labels


def fit(pages: list[list[Leaf]], epochs: int = 14, rate: float = 0.02, seed: int = 5) -> BiLstm:
    rng = np.random.default_rng(seed)
    model = BiLstm(rng)
    labelled = [(b, y) for b in pages if (y := semantic_labels(b)) is not None and any(y)]
    other = [leaf.text for b, y in labelled for leaf, k in zip(b, y) if not k] or ["x"]
    other += [leaf.text for b, y in labelled for leaf, k in zip(b, y) if k][::3]
    examples = [(vectors(b), y) for b, y in labelled]
    for b, y in labelled:
        article = [leaf.text for leaf, k in zip(b, y) if k]
        for _ in range(LAYOUTS):
            blocks, labels = new_layout(article, other, rng)
            examples.append((vectors(blocks), labels))
    sequences = [(x[a : a + WINDOW], np.array(y[a : a + WINDOW], np.float32)) for x, y in examples for a in range(0, len(x), WINDOW)]
    sequences.sort(key=lambda s: len(s[0]))
    batches = []
    for a in range(0, len(sequences), 32):
        part = sequences[a : a + 32]
        x, mask = padded([s[0] for s in part])
        y = np.zeros(mask.shape, np.float32)
        for row, s in zip(y, part):
            row[: len(s[1])] = s[1]
        batches.append((x, mask, y))
    first, second = ({k: np.zeros_like(v) for k, v in model.p.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        for n in rng.permutation(len(batches)):
            step += 1
            now = rate * (1 - epoch / epochs)
            for k, g in model.gradients(*batches[n]).items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                model.p[k] -= now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return model


def learnable(html: str | None) -> bool:
    """Whether the semantic tags of a page label some of its text."""
    return any(semantic_labels(leaves(html)) or ())


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> BiLstm | None:
    """Fit on a hash sample of about ``sample_pages`` of the pages that have text
    under semantic tags; None if no page has."""

    def draw(found: DataFrame) -> list[str]:
        total = found.count()
        if not total:
            return []
        rows = found.where(hash_below(F.lit(min(1.0, sample_pages / total)), "page_id", "url", salt="html")).select("page_id", "html").collect()
        return [r["html"] for r in sorted(rows, key=lambda r: (r["page_id"] is None, r["page_id"] or 0, r["html"]))]

    def exact(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array([learnable(h) for h in batch.column("html").to_pylist()], pa.bool_()))

    found = pages.select("page_id", "url", "html").where(F.col("html").rlike(SEMANTIC))
    sample = draw(found)
    if 2 * sum(map(learnable, sample)) <= len(sample):
        # Most tags are in comments or scripts, or none was drawn: every such page is read.
        found = map_batches(found, exact, found.schema.simpleString()[len("struct<") : -1])
        sample = draw(found) or [r["html"] for r in found.select("html").limit(sample_pages).collect()]
    return fit([leaves(h) for h in sample]) if sample else None


def label(model: BiLstm | None, pages: list[list[Leaf]]) -> list[np.ndarray]:
    """The probability of every block of every page; pages of like length are
    run together. Without a model: 1 outside of what names no article."""
    if model is None:
        return [np.array([float(not OUTSIDE.intersection(b.path)) for b in p]) for p in pages]
    out: list[np.ndarray] = [np.zeros(0)] * len(pages)
    order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    at = 0
    while at < len(order):
        # A page of very many blocks is run alone, so that padding stays small.
        now = order[at : at + (PAGES_AT_ONCE if len(pages[order[min(at + PAGES_AT_ONCE, len(order)) - 1]]) <= 512 else 1)]
        x, mask = padded([vectors(pages[i]) for i in now])
        for i, p in zip(now, model.predict(x, mask)):
            out[i] = p[: len(pages[i])]
        at += len(now)
    return out


def main_text(pages: DataFrame, model: BiLstm | None, html: Column | str = "html") -> DataFrame:
    """page_id, url, text of every page."""
    df = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.col(html).alias("html") if isinstance(html, str) else html.alias("html"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [leaves(h) for h in batch.column("html").to_pylist()]
        texts = ["\n\n".join(b.text for b, q in zip(blocks, p) if q >= 0.5) for blocks, p in zip(found, label(model, found))]
        return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return map_batches(df, run, "page_id long, url string, text string")
