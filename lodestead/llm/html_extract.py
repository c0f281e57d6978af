"""Main-text extraction: boosted trees over DOM nodes and a hierarchical decoding.

Each element gets features (subtree text density, links, attribute tokens, depth, siblings,
ancestors), boosted regression trees give the odds that its subtree holds main text, and
the decoding picks the most likely set of kept elements in which no kept element lies in
a dropped one.  The text of kept elements is returned.

No page is labelled, so the trees are trained here on pages laid out from the article
sentences of a bounded sample of the table (``TRAINING_PAGES``), in random layouts with
known roles: tags and attribute words vary, so that the trees rely on the structure too.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, hash_sampled

TRAINING_PAGES = 500
#: Pages that lend their paragraphs to the layouts, paragraphs used, and their least and greatest length.
SAMPLE_PAGES = 200
SENTENCES = 4000
SENTENCE_CHARS = (30, 600)
TREES, DEPTH, RATE, BINS = 60, 4, 0.25, 32

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Never text of a page, even if their end tag is left out.
RAW = {"head", "script", "style", "title", "iframe", "textarea"}
#: Not text of a page either, up to their end tag; what follows is text if that is left out.
SKIPPED = RAW | {"noscript", "template", "object", "svg", "math", "select", "button", "datalist"}
IN_HEAD = {"head", "title", "meta", "link", "base", "script", "style", "noscript", "template"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer",
    "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "legend", "li", "main", "nav", "ol", "p", "pre", "section", "summary",
    "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
CLOSES_P = BLOCKS - {"body", "html", "caption", "dd", "dt", "li", "tbody", "td", "tfoot", "th", "thead", "tr"}
#: An open element of the set ends when the key starts.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
P_BOUNDS = {"td", "th", "table", "div", "article", "section", "body", "button", "object"}
BOUNDS = {"ul", "ol", "dl", "table", "div", "body", "article", "section"}
TAGS = ("p", "h1", "h2", "h3", "h4", "li", "ul", "ol", "a", "div", "section", "article", "main", "nav", "header", "footer", "aside", "form", "table", "td", "blockquote", "figure", "span", "b", "label", "pre")
#: Words of class, id and role attributes that tell what an element holds.
GOOD = ("article", "content", "main", "body", "post", "entry", "story", "text", "page")
BAD = (
    "ad", "ads", "advert", "advertisement", "banner", "sponsor", "promo", "nav", "navigation", "menu", "breadcrumb", "breadcrumbs", "header", "masthead", "top", "footer",
    "bottom", "copyright", "sidebar", "aside", "widget", "related", "share", "social", "cookie", "consent", "notice", "alert", "popup", "modal", "newsletter", "subscribe",
    "login", "search", "form", "comment", "comments", "reply", "discussion", "disqus", "tags", "pagination", "pager", "meta", "toolbar",
)


class _Tree(HTMLParser):
    """Elements in page order with their parents, and the pieces of text in page order.

    What a skipped element holds is taken back when it ends.  One that an end tag of an
    enclosing element or the end of the page ends instead has lost its own: then only what
    stands before the first block in it is taken back, and at the end of the page nothing
    if there is no block.  A head ends at the first tag or text that can't be in it.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.words, self.pieces = ["#page"], [-1], [()], []
        self.stack = [0]
        #: Places of the open elements of each tag in the stack.
        self.places: dict[str, list[int]] = {}
        #: Of each open skipped element: numbers of elements and pieces at its start, and of pieces before its first block.
        self.skips: dict[int, list] = {}
        self.unmarked: list[int] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in IN_HEAD:
            self._leave_head()
        if tag in BLOCKS:
            for node in self.unmarked:
                if node in self.skips:
                    self.skips[node][2] = len(self.pieces)
            self.unmarked.clear()
        if tag in CLOSES_P:
            self._end("p", P_BOUNDS - {tag})
        for other in ENDS.get(tag, ()):
            self._end(other, BOUNDS if tag in ("li", "dt", "dd") else {"table"})
        if tag in VOID:
            self.pieces.append((self.stack[-1], " " if tag in ("br", "hr") else ""))
            return
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append(self._new(tag, attrs))
        if tag in SKIPPED:
            self.skips[self.stack[-1]] = [len(self.tags), len(self.pieces), None]
            self.unmarked.append(self.stack[-1])
        elif tag in BLOCKS:
            self.pieces.append((self.stack[-1], " "))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in VOID:
            self._end(tag, set())

    def handle_data(self, data: str) -> None:
        if self.tags[self.stack[-1]] == "head" and data.strip():
            self._leave_head()
        self.pieces.append((self.stack[-1], data))

    def close(self) -> None:
        super().close()
        for node, (_, start, block) in reversed(self.skips.items()):
            if self.tags[node] in RAW:
                self._take_back(node, start, None)
            elif block is not None:
                self._take_back(node, start, block)
        self.skips.clear()

    def _new(self, tag: str, attrs: list) -> int:
        named = " ".join(v for k, v in attrs if v and k in ("class", "id", "role", "itemprop", "aria-label"))
        self.tags.append(tag)
        self.parents.append(self.stack[-1])
        self.words.append(tuple(re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", named).lower())))
        return len(self.tags) - 1

    def _end(self, tag: str, bounds: set) -> None:
        """Ends the innermost open element of the tag, unless one of ``bounds`` is open inside it."""
        at = self.places.get(tag)
        if not at or any(self.places[b][-1] > at[-1] for b in bounds if self.places.get(b)):
            return
        low = at[-1]
        while len(self.stack) > low:
            node = self.stack.pop()
            self.places[self.tags[node]].pop()
            if node in self.skips:
                elements, start, block = self.skips.pop(node)
                if len(self.stack) > low and self.tags[node] not in RAW and block is not None:
                    self._take_back(node, start, block)
                else:
                    self._take_back(node, start, None)
                    self._forget(elements)
            elif self.tags[node] in BLOCKS:
                self.pieces.append((self.stack[low - 1], " "))

    def _take_back(self, node: int, start: int, end: int | None) -> None:
        end = len(self.pieces) if end is None else end
        self.pieces[start:end] = [(node, "")] * (end > start)

    def _forget(self, elements: int) -> None:
        del self.tags[elements:], self.parents[elements:], self.words[elements:]

    def _leave_head(self) -> None:
        if self.places.get("head"):
            self._end("head", set())


def parse(html: str | None) -> _Tree:
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    return tree


FEATURES = 17 + 8 + len(TAGS) + 3


def features(tree: _Tree) -> np.ndarray:
    """A row per element."""
    n = len(tree.tags)
    parent = np.array(tree.parents)
    own, commas = np.zeros(n), np.zeros(n)
    for node, piece in tree.pieces:
        own[node] += len("".join(piece.split()))
        commas[node] += piece.count(",") + piece.count(".")
    is_link = np.array([t == "a" for t in tree.tags])
    depth, linked = np.zeros(n), is_link.copy()
    for k in range(1, n):
        depth[k] = depth[parent[k]] + 1
        linked[k] |= linked[parent[k]]
    text, link, marks, size, paragraphs = own.copy(), np.where(linked, own, 0.0), commas.copy(), np.ones(n), np.array([float(t == "p") for t in tree.tags])
    for k in range(n - 1, 0, -1):
        for total in (text, link, marks, size, paragraphs):
            total[parent[k]] += total[k]
    up = np.maximum(parent, 0)
    children = np.bincount(up[1:], minlength=n) if n > 1 else np.zeros(n)
    place, seen = np.zeros(n), np.zeros(n)
    for k in range(1, n):
        place[k] = seen[parent[k]]
        seen[parent[k]] += 1
    siblings = children[up]
    good = np.array([float(any(w in GOOD for w in ws)) for ws in tree.words])
    bad = np.array([float(any(w in BAD for w in ws)) for ws in tree.words])
    tag_bad = np.array([float(t in ("nav", "footer", "aside", "form", "header")) for t in tree.tags])
    tag_good = np.array([float(t in ("article", "main")) for t in tree.tags])
    above = np.zeros((n, 4))
    for k in range(1, n):
        above[k] = np.maximum(above[parent[k]], (good[parent[k]], bad[parent[k]], tag_bad[parent[k]], tag_good[parent[k]]))
    total = max(text[0], 1.0)
    sibling_text = (text[up] - own[up] - text) / np.maximum(siblings - 1, 1)
    number = {t: k for k, t in enumerate(TAGS)}
    tags = np.zeros((n, len(TAGS)))
    for k, t in enumerate(tree.tags):
        if t in number:
            tags[k, number[t]] = 1
    columns = (
        np.log1p(text), np.log1p(own), text / total, link / np.maximum(text, 1), text / size, np.log1p(size), marks / np.maximum(text, 1), depth, children,
        siblings, place / np.maximum(siblings - 1, 1), np.log1p(np.maximum(sibling_text, 0)), (link / np.maximum(text, 1))[up], np.log1p(text[up]), paragraphs,
        paragraphs[up], text / np.maximum(text[up], 1), good, bad, tag_bad, tag_good, above[:, 0], above[:, 1], above[:, 2], above[:, 3],
        good[up], bad[up], np.array([len(w) for w in tree.words], float),
    )
    return np.hstack((np.column_stack(columns), tags))


class BoostedTrees:
    """Regression trees on histograms, boosted for the logistic loss."""

    def __init__(self, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS):
        self.trees, self.depth, self.rate, self.bins = trees, depth, rate, bins
        self.cuts: list[np.ndarray] = []
        self.splits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.start = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(self.cuts)])

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, self.bins + 1)[1:-1])) for k in range(x.shape[1])]
        binned, width = self._binned(x), self.bins + 1
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        score = np.full(len(y), self.start)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            gradient, weight = y - p, p * (1 - p)
            feature, cut, value = np.zeros(2**self.depth, int), np.full(2**self.depth, self.bins + 1), np.zeros(2 ** (self.depth + 1))
            node = np.ones(len(y), int)
            for level in range(self.depth):
                low = 2**level
                best = np.full(low, 1e-6)
                cells = (node - low) * width
                for k in range(x.shape[1]):
                    g = np.bincount(cells + binned[:, k], weights=gradient, minlength=low * width).reshape(low, width).cumsum(axis=1)
                    h = np.bincount(cells + binned[:, k], weights=weight, minlength=low * width).reshape(low, width).cumsum(axis=1)
                    total_g, total_h = g[:, -1:], h[:, -1:]
                    gain = g**2 / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g**2 / (total_h + 1)
                    gain[(h < 1) | (total_h - h < 1)] = 0
                    at = gain.argmax(axis=1)
                    top = gain[np.arange(low), at]
                    better = top > best
                    best[better] = top[better]
                    feature[low : 2 * low][better] = k
                    cut[low : 2 * low][better] = at[better]
                node = 2 * node + (binned[np.arange(len(y)), feature[node]] > cut[node])
            g, h = np.bincount(node, weights=gradient, minlength=len(value)), np.bincount(node, weights=weight, minlength=len(value))
            value = self.rate * g / (h + 1)
            self.splits.append((feature, cut, value))
            score += value[node]
        return self

    def odds(self, x: np.ndarray) -> np.ndarray:
        """Logarithm of the odds of each row."""
        binned, rows = self._binned(x), np.arange(len(x))
        score = np.full(len(x), self.start)
        for feature, cut, value in self.splits:
            node = np.ones(len(x), int)
            for _ in range(self.depth):
                node = 2 * node + (binned[rows, feature[node]] > cut[node])
            score += value[node]
        return score


def decode(tree: _Tree, odds: np.ndarray) -> np.ndarray:
    """The most likely kept elements, such that all ancestors of a kept one are kept.

    A subtree is dropped as a whole or its root is kept and each child subtree decided by
    itself, whichever is likelier; elements without any text decide nothing.
    """
    n = len(tree.tags)
    has = np.zeros(n, bool)
    for node, piece in tree.pieces:
        has[node] |= bool(piece.strip())
    for k in range(n - 1, 0, -1):
        has[tree.parents[k]] |= has[k]
    keep_log, drop_log = -np.logaddexp(0, -odds) * has, -np.logaddexp(0, odds) * has
    dropped, kept = drop_log.copy(), keep_log.copy()
    for k in range(n - 1, 0, -1):
        up = tree.parents[k]
        dropped[up] += dropped[k]
        kept[up] += max(kept[k], dropped[k])
    keep = np.zeros(n, bool)
    keep[0] = True
    for k in range(1, n):
        keep[k] = keep[tree.parents[k]] and (kept[k] > dropped[k] or tree.tags[k] in ("html", "body"))
    return keep


def kept_text(tree: _Tree, keep: np.ndarray) -> str:
    """Text of the kept elements in page order; dropped pieces leave a boundary."""
    return " ".join("".join(piece if keep[node] or piece == " " else " " for node, piece in tree.pieces).split())


def _layout(rng: random.Random, sentences: list[str]) -> str:
    """A page in a random layout; elements that hold main text carry the attribute ``data-k``."""

    def words(low: int, high: int) -> str:
        text = " ".join(rng.choice(sentences) for _ in range(1 + high // 8)).split() or ["text"]
        return " ".join(text[: rng.randint(low, high)])

    def links(n: int) -> str:
        return "".join(f'<li><a href="/x">{words(1, 3)}</a></li>' for _ in range(n))

    def named(options: list[str]) -> str:
        return rng.choice(options)

    def paragraph(k: str) -> str:
        text = " ".join(rng.choice(sentences) for _ in range(rng.randint(1, 7)))
        if rng.random() < 0.1:
            text = words(1, 3)
        if rng.random() < 0.15:
            text += f' <a {k} href="/y">{words(1, 4)}</a> {words(2, 9)}'
        return rng.choice([f"<p {k}>{text}</p>"] * 6 + [f"<p {k}><b {k}>{text}<br><p {k}>{words(3, 30)}</p>", f"<div {k}>{text}</div>", f"<blockquote {k}><p {k}>{text}</p></blockquote>", f"<ul {k}><li {k}>{words(3, 12)}</li><li {k}>{words(3, 12)}</li></ul>", f"<h2 {k}>{words(2, 6)}</h2><p {k}>{text}</p>", f"<table {k}><tr {k}><td {k}>{words(1, 5)}</td><td {k}>{words(1, 5)}</td></tr></table>"])

    k = "data-k=1"

    def ad() -> str:
        return f'<{(t := named(["div", "aside", "section", "div"]))} {named(["class=ad", "class=advert", "id=banner-top", "class=sponsor-box", "class=promo", "class=x7"])}>{rng.choice(["", "<p>"])}{words(3, 40)}</{t}>'

    inner = f"<h1 {k}>{words(3, 12)}</h1>" if rng.random() < 0.8 else ""
    if inner and rng.random() < 0.15:
        inner = f"<header {k}>{inner}</header>"
    body = [paragraph(k) for _ in range(rng.choice([1, 2, 4, 8, 14]))]
    if rng.random() < 0.25:
        body.insert(rng.randint(0, len(body)), ad())
    if rng.random() < 0.15:
        body.append(f"<div class=share><a href=/s>{words(1, 2)}</a> <a href=/t>{words(1, 2)}</a></div>")
    tag = rng.choice(["article", "article", "main", "div", "div", "section"])
    mark = named(["", "", "class=content", "id=main-content", "class=post-body", "class=entry", "class=story", "class=c12"]) if tag in ("div", "section") else named(["", "", "class=post"])
    main = f"<{tag} {mark} {k}>{inner}{''.join(body)}</{tag}>"
    if rng.random() < 0.3:
        main = f"<div {named(['class=wrap', 'id=page', 'class=col', ''])} {k}>{main}</div>"
    comments = "".join(f"<{(t := named(['div', 'li']))} class=comment><p>{words(5, 60)}</p></{t}>" for _ in range(rng.randint(1, 5)))
    parts = [
        (0.4, f"<{(t := named(['header', 'div']))} {named(['class=header', 'id=masthead', 'class=top'])}>{named(['<h2>', '<p>', '<span>'])}{words(1, 5)}</{t}>"),
        (0.85, named([f"<nav><ul>{links(rng.randint(3, 9))}</ul></nav>", f"<div class=menu><ul>{links(5)}</ul></div>", f"<ul class=nav>{links(6)}</ul>"])),
        (0.3, f"<div {named(['class=cookie-notice', 'id=consent', 'class=alert', 'role=alert', 'class=notice'])}><p>{words(4, 30)}</p></div>"),
        (0.6, ad()),
        (1.0, main),
        (0.35, f"<{(t := named(['div', 'section']))} {named(['id=comments', 'class=comments', 'class=discussion'])}><h3>{words(1, 3)}</h3>{comments}</{t}>"),
        (0.3, f"<form {named(['class=newsletter', 'id=search', ''])}><label>{words(1, 4)}</label><input><p>{words(1, 12)}</p></form>"),
        (0.4, f"<{(t := named(['aside', 'div']))} {named(['class=sidebar', 'id=sidebar', 'class=widget'])}><h3>{words(1, 3)}</h3><ul>{links(4)}</ul><p>{words(3, 30)}</p></{t}>"),
        (0.25, f"<div {named(['class=related', 'class=more'])}><h3>{words(1, 3)}</h3><ul>{links(4)}</ul></div>"),
        (0.85, f"<{(t := named(['footer', 'footer', 'div']))} {named(['class=footer', 'id=footer'])}>{named(['&copy; ', ''])}{words(1, 25)}{named(['', '<p>' + words(1, 9) + '</p>'])}</{t}>"),
    ]
    return f"<html><body {k}>" + "".join(html for chance, html in parts if rng.random() < chance) + "</body></html>"


class _Marked(_Tree):
    def __init__(self) -> None:
        super().__init__()
        self.marked = [True]

    def _new(self, tag: str, attrs: list) -> int:
        self.marked.append(any(name == "data-k" for name, _ in attrs) or tag == "html")
        return super()._new(tag, attrs)

    def _forget(self, elements: int) -> None:
        super()._forget(elements)
        del self.marked[elements:]


def train_extractor(sentences: list[str], pages: int = TRAINING_PAGES, seed: int = 4) -> BoostedTrees:
    """Trees fitted on ``pages`` random layouts of the sentences."""
    rng, rows, marks = random.Random(seed), [], []
    for _ in range(pages):
        tree = _Marked()
        tree.feed(_layout(rng, sentences or ["No sentence was given."]))
        tree.close()
        x = features(tree)
        own = x[:, 0] > 0
        rows.append(x[own])
        marks.append(np.array(tree.marked, float)[own])
    return BoostedTrees().fit(np.vstack(rows), np.concatenate(marks))


def extract_text(
    pages: DataFrame, *, sample: int = SAMPLE_PAGES, sentences: int = SENTENCES, sentence_chars: tuple[int, int] = SENTENCE_CHARS, training_pages: int = TRAINING_PAGES
) -> DataFrame:
    """``pages(page_id, url, html)`` -> ``(page_id, url, text, n_chars)``, a row per row.

    Character references are decoded, white space inside a block becomes one space, and
    blocks are joined by one space.  A null or empty html gives an empty text, markup that
    is cut off or wrongly nested is read as far as it goes, and a page of plain text is
    judged as one element.  About ``sample`` pages, whatever the table's size, lend at most
    ``sentences`` plain paragraphs of ``sentence_chars`` characters to the training layouts;
    the same table gives the same trees.  Repeated rows are answered alike; other columns
    are not looked at; an empty table gives no rows.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    lent = rows.where(F.col("html").isNotNull() & hash_sampled(F.col("page_id"), sample, rows.count()))
    pattern = rf"(?s)<p>([^<]{{{sentence_chars[0]},{sentence_chars[1]}}})"
    paragraphs = lent.select(F.explode(F.regexp_extract_all("html", F.lit(pattern), F.lit(1))).alias("s")).orderBy(F.xxhash64("s"), "s").limit(sentences)
    model = train_extractor([re.sub(r"\s+", " ", r["s"]) for r in paragraphs.collect()], training_pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "html"):
            trees = [parse(h) for h in part.column("html").to_pylist()]
            x = [features(t) for t in trees]
            odds = np.split(model.odds(np.vstack(x)), np.cumsum([len(r) for r in x])[:-1])
            texts = [kept_text(t, decode(t, o)) for t, o in zip(trees, odds, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
