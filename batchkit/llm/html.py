"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its leaf blocks. Each block is a vector of its tag path, its hashed words and a few
measures; a bidirectional LSTM reads the sequence in both directions and labels every block with the whole page as
context. The network is trained here, on a bounded sample of pages: their own blocks where the markup says what they
are, and pages put together from their texts in other layouts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchkit.llm.sampling import first_texts

TRAINING_PAGES = 200  # bound of the sample the network is trained on
LONGEST_SAMPLE = 1 << 16  # bytes of a page in it
MADE_PAGES = 600  # pages put together from its texts
EPOCHS = 8
PATH_SIZE, WORD_SIZE, MEASURES = 256, 48, 5
HIDDEN = 12
CELLS = 16_384  # blocks, padding included, that are labelled at a time
PATH_ENDS = 24  # elements of a path's beginning and end that a block's vector has

_ATTRIBUTES = r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+)"""
# An element left out that is never closed ends at the next of these.
_BLOCKS = (
    "address|article|aside|blockquote|body|center|dd|details|dialog|dir|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|"
    "header|hgroup|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|tr|ul"
)
_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)
    |<(?P<raw>script|style|textarea|title)\b{_ATTRIBUTES}>.*?(?:</(?P=raw)\s*>|\Z)
    |<svg\b{_ATTRIBUTES}(?<=/)>
    |<(?P<part>noscript|template|svg|iframe|select|object|canvas)\b{_ATTRIBUTES}>
        (?:(?:(?!<(?P=part)\b).)*?</(?P=part)\s*>|.*?(?=</?(?:{_BLOCKS})\b|\Z))
    |<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attributes>{_ATTRIBUTES})>
    |</?[a-zA-Z!?][^>]*+(?:>|\Z)|<[!?][^>]*+(?:>|\Z)""",
    re.S | re.I | re.X,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"\w+")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr input button".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# What an open paragraph or list item ends with.
_CLOSES = {"p": "p", "li": "li", "dt": "dd dt", "dd": "dd dt", "tr": "tr", "td": "td th", "th": "td th", "option": "option"}


@dataclass
class Leaf:
    text: str
    path: tuple[str, ...]
    linked: float  # share of characters inside links


def leaves(page: str) -> list[Leaf]:
    """The text blocks of a page in order, each with the elements it is in; white space is one space."""
    found: list[Leaf] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    in_link = linked = 0

    def flush() -> None:
        nonlocal parts, linked
        text = _SPACE.sub(" ", unescape("".join(parts))).strip()
        if text:
            ends = stack if len(stack) <= 2 * PATH_ENDS else stack[:PATH_ENDS] + stack[-PATH_ENDS:]
            path = tuple(name for _, names in ends for name in names)
            found.append(Leaf(text, path, min(1.0, linked / len(text))))
        parts, linked = [], 0

    def text_between(start: int, end: int) -> None:
        nonlocal linked
        if end > start:
            parts.append(page[start:end])
            linked += (end - start) * bool(in_link)

    at = 0
    for token in _TOKEN.finditer(page):
        text_between(at, token.start())
        at = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = not token["end"]
            if tag == "br":
                parts.append(" ")
            continue
        flush()
        if token["end"]:
            if any(open_tag == tag for open_tag, _ in reversed(stack)):
                while stack.pop()[0] != tag:
                    pass
            in_link = 0
            continue
        if stack and stack[-1][0] in _CLOSES.get(tag, "").split() or stack and stack[-1][0] == "p":
            stack.pop()
        if tag not in VOID:
            names = [w for m in _NAMES.finditer(token["attributes"]) for w in (m[1] or m[2] or m[3] or "").lower().split()]
            parted = [p for n in names for p in re.split(r"[^a-z]+", n) if p]
            stack.append((tag, (tag, *(f".{p}" for p in parted))))
    text_between(at, len(page))
    flush()
    return found


def _bucket(word: str, size: int) -> int:
    return zlib.crc32(word.encode()) % size


_cached_bucket = lru_cache(1 << 17)(_bucket)


def vectors(blocks: list[Leaf]) -> np.ndarray:
    """A row per block: path elements, hashed words of unit length, and measures."""
    rows = np.zeros((len(blocks), PATH_SIZE + WORD_SIZE + MEASURES), np.float32)
    for i, block in enumerate(blocks):
        for name in block.path:
            rows[i, _cached_bucket(name, PATH_SIZE)] = 1
        words = block.text.lower().split()
        counts = np.bincount([_cached_bucket(w, WORD_SIZE) for w in words], minlength=WORD_SIZE)
        rows[i, PATH_SIZE : PATH_SIZE + WORD_SIZE] = counts / np.sqrt((counts**2).sum())
        size = len(block.text)
        ends = block.text[-1] in ".!?…:;\"”»"
        rows[i, -MEASURES:] = np.log1p(len(words)) / 5, block.linked, ends, i / len(blocks), np.log1p(size) / 8
    return rows


class Labeller:
    """A bidirectional LSTM with a logistic output, in numpy."""

    def __init__(self, size: int, hidden: int = HIDDEN, seed: int = 7):
        random = np.random.default_rng(seed)
        self.weights: dict[str, np.ndarray] = {}
        for side in "fb":
            self.weights[f"x{side}"] = random.normal(0, size**-0.5, (size, 4 * hidden)).astype(np.float32)
            self.weights[f"h{side}"] = random.normal(0, hidden**-0.5, (hidden, 4 * hidden)).astype(np.float32)
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden : 2 * hidden] = 1  # remember at first
            self.weights[f"b{side}"] = bias
        self.weights["out"] = random.normal(0, 0.3, (2 * hidden, 1)).astype(np.float32)
        self.weights["bias"] = np.zeros(1, np.float32)

    def _walk(self, x: np.ndarray, mask: np.ndarray, side: str, keep: list | None = None) -> np.ndarray:
        """Hidden states (steps, pages, hidden) in page order; padding leaves the state as it is."""
        w = self.weights
        hidden = w[f"h{side}"].shape[0]
        given = x @ w[f"x{side}"] + w[f"b{side}"]
        h = c = np.zeros((x.shape[1], hidden), np.float32)
        out = np.zeros((*x.shape[:2], hidden), np.float32)
        order = range(len(x)) if side == "f" else reversed(range(len(x)))
        for t in order:
            gates = given[t] + h @ w[f"h{side}"]
            i, f, o = (1 / (1 + np.exp(-gates[:, k * hidden : (k + 1) * hidden])) for k in range(3))
            g = np.tanh(gates[:, 3 * hidden :])
            new_c = f * c + i * g
            tanh_c = np.tanh(new_c)
            m = mask[t][:, None]
            if keep is not None:
                keep.append((t, i, f, o, g, c, tanh_c, h, m))
            h, c = m * (o * tanh_c) + (1 - m) * h, m * new_c + (1 - m) * c
            out[t] = h
        return out

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        states = np.concatenate([self._walk(x, mask, side) for side in "fb"], axis=2)
        return (states @ self.weights["out"] + self.weights["bias"])[..., 0]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        kept: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([self._walk(x, mask, side, kept[side]) for side in "fb"], axis=2)
        score = (states @ w["out"] + w["bias"])[..., 0]
        error = ((1 / (1 + np.exp(-score))) - y) * mask / mask.sum()
        grads = {"out": np.einsum("tbh,tb->h", states, error)[:, None], "bias": error.sum(keepdims=True)[0]}
        hidden = w["hf"].shape[0]
        for n, side in enumerate("fb"):
            d_states = error[..., None] * w["out"][n * hidden : (n + 1) * hidden, 0]
            d_given = np.zeros((*x.shape[:2], 4 * hidden), np.float32)
            d_h = d_c = np.zeros((x.shape[1], hidden), np.float32)
            grads[f"h{side}"] = np.zeros_like(w[f"h{side}"])
            for t, i, f, o, g, c, tanh_c, h, m in reversed(kept[side]):
                d_h = d_h + d_states[t]
                now = m * d_h
                cell = m * d_c + now * o * (1 - tanh_c**2)
                gates = np.concatenate(
                    [cell * g * i * (1 - i), cell * c * f * (1 - f), now * tanh_c * o * (1 - o), cell * i * (1 - g**2)], axis=1
                )
                d_given[t] = gates
                grads[f"h{side}"] += h.T @ gates
                d_h = gates @ w[f"h{side}"].T + (1 - m) * d_h
                d_c = cell * f + (1 - m) * d_c
            grads[f"x{side}"] = np.einsum("tbd,tbg->dg", x, d_given, optimize=True)
            grads[f"b{side}"] = d_given.sum(axis=(0, 1))
        return grads

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS, batch: int = 32, rate: float = 0.01):
        """Adam over batches of pages of like length."""
        order = np.argsort([len(p) for p in pages], kind="stable")
        groups = [order[i : i + batch] for i in range(0, len(order), batch)]
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        random, step = np.random.default_rng(11), 0
        for _ in range(epochs):
            for n in random.permutation(len(groups)):
                x, mask = padded([pages[i] for i in groups[n]])
                y = padded([labels[i][:, None] for i in groups[n]])[0][..., 0]
                step += 1
                for name, grad in self.gradients(x, mask, y).items():
                    grad = np.clip(grad, -1, 1)
                    mean[name] = 0.9 * mean[name] + 0.1 * grad
                    square[name] = 0.999 * square[name] + 0.001 * grad**2
                    change = (mean[name] / (1 - 0.9**step)) / (np.sqrt(square[name] / (1 - 0.999**step)) + 1e-8)
                    self.weights[name] = (self.weights[name] - rate * change).astype(np.float32)
        return self

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block of each page is main text; pages of like length share a pass of bounded size."""
        result: list[np.ndarray] = [np.empty(0, bool)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if len(p)), key=lambda i: len(pages[i]))
        while order:
            longest = len(pages[order[-1]])
            group = order[-max(1, CELLS // longest) :]
            del order[-len(group) :]
            scores = self.scores(*padded([pages[i] for i in group]))
            for place, i in enumerate(group):
                result[i] = scores[: len(pages[i]), place] > 0
        return result


def padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(steps, sequences, values) and the mask of steps that are there."""
    steps = max(map(len, sequences))
    x = np.zeros((steps, len(sequences), sequences[0].shape[1]), np.float32)
    mask = np.zeros((steps, len(sequences)), np.float32)
    for i, own in enumerate(sequences):
        x[: len(own), i], mask[: len(own), i] = own, 1
    return x, mask


# Names by which markup tells what is main text, and layouts of what is not.
MAIN_NAMES = "article main"
OTHER_NAMES = (
    "nav header footer aside form menu .nav .menu .header .footer .sidebar .ad .ads .advert .banner .cookie .consent .notice "
    ".comment .comments .related .share .social .breadcrumb .promo .newsletter"
)
ARTICLES = (
    "<article>{}</article>",
    "<main>{}</main>",
    '<main><article class="post">{}</article></main>',
    '<div class="content">{}</div>',
    '<div id="main-content"><div class="text">{}</div></div>',
    '<div class="post entry">{}</div>',
    '<section class="article-body story">{}</section>',
    '<div id="content"><div class="article">{}</div></div>',
    '<div role="main">{}</div>',
)
BEFORE = (
    "<nav><ul>{items}</ul></nav>",
    '<div class="menu navigation"><ul>{items}</ul></div>',
    "<header><h2>{short}</h2><p>{short}</p></header>",
    '<div id="header"><div class="logo">{short}</div><ul class="nav">{items}</ul></div>',
    '<div class="breadcrumb breadcrumbs">{links}</div>',
    '<div class="cookie-notice consent"><p>{long}</p><button>{short}</button></div>',
    '<div class="notice alert">{long}</div>',
    '<div class="banner ad ads">{long}</div>',
    '<div class="ad advert sponsored">{short}</div>',
    '<div class="search"><form><label>{short}</label><input name=q><button>{short}</button></form></div>',
)
AFTER = (
    "<footer><p>{long}</p></footer>",
    "<footer>&copy; {short} &middot; {links}</footer>",
    '<div class="footer copyright">{long}</div>',
    "<aside><h3>{short}</h3><ul>{items}</ul></aside>",
    "<aside><p>{long}</p></aside>",
    '<div class="sidebar widget"><h3>{short}</h3><p>{long}</p></div>',
    '<div class="related recommended"><h4>{short}</h4><ul>{items}</ul></div>',
    '<section class="comments"><h3>{short}</h3><div class="comment"><p>{long}</p></div><div class="comment"><p>{long}</p></div></section>',
    '<div id="comments"><ol class="comment-list"><li class="comment"><p>{long}</p></li><li class="comment">{long}</li></ol></div>',
    '<form action="/x"><p>{short}</p><label>{short}</label><input><button>{short}</button></form>',
    '<div class="share social"><ul>{items}</ul></div>',
    '<div class="newsletter subscribe promo popup modal"><p>{long}</p><form><input><button>{short}</button></form></div>',
    '<div class="pagination pager">{links}</div>',
    '<div class="ad advertisement">{long}</div>',
    '<div class="author-bio meta tags">{links}</div>',
)
MAIN_BLOCKS = ("<p>{}</p>", "<p>{}", "<p><b>{}</b></p>", "<h2>{}</h2>", "<h3>{}</h3>", "<li>{}</li>", "<blockquote>{}</blockquote>", "<pre>{}</pre>", "<td>{}</td>", "<div>{}</div>")


def told_by_markup(blocks: list[Leaf]) -> np.ndarray | None:
    """Labels where the page names its main text, else None."""
    main, other = set(MAIN_NAMES.split()), set(OTHER_NAMES.split())
    labels = np.array([bool(main & set(b.path)) and not other & set(b.path) for b in blocks], np.float32)
    return labels if labels.any() else None


def training_pages(sample: list[str], made: int = MADE_PAGES, seed: int = 5) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Vectors and labels of the sample's own pages and of pages in other layouts that hold its texts."""
    random = np.random.default_rng(seed)
    pages, labels, texts = [], [], []
    for page in sample:
        blocks = leaves(page)
        told = told_by_markup(blocks) if blocks else None
        texts += [b.text for b in blocks if len(b.text) > 20]
        if told is not None:
            pages.append(vectors(blocks))
            labels.append(told)
    texts = texts or ["text"]

    def text(most: int) -> str:
        words = texts[random.integers(len(texts))].split()
        start = random.integers(max(1, len(words) - most // 2))
        return " ".join(words[start : start + random.integers(1, most + 1)]).replace("<", " ").replace("&", " ") or "text"

    def other(layout: str) -> str:
        items = "".join(f'<li><a href="/">{text(3)}</a></li>' for _ in range(random.integers(2, 8)))
        links = " ".join(f'<a href="/">{text(2)}</a>' for _ in range(random.integers(2, 6)))
        while "{long}" in layout or "{short}" in layout:
            layout = layout.replace("{short}", text(4), 1).replace("{long}", text(60), 1)
        return layout.format(items=items, links=links)

    for _ in range(made):
        outer, close = ("<html><body>", "") if random.random() < 0.7 else ('<html><body><div class="page wrapper">', "</div>")
        article = ARTICLES[random.integers(len(ARTICLES))]
        opened = outer + article.split("{}")[0]
        sections = [(outer + other(BEFORE[i]), 0) for i in random.choice(len(BEFORE), random.integers(0, 5), replace=False)]
        main = [(opened + f"<h1>{text(8)}</h1>", 1)] if random.random() < 0.8 else []
        for _ in range(random.integers(1, 25)):
            if random.random() < 0.08:
                inside = AFTER if random.random() < 0.5 else BEFORE
                main.append((opened + other(inside[random.integers(len(inside))]), 0))
            block = MAIN_BLOCKS[0] if random.random() < 0.7 else MAIN_BLOCKS[random.integers(len(MAIN_BLOCKS))]
            main.append((opened + block.format(text(90 if random.random() < 0.8 else 5)), 1))
        after = [(outer + other(AFTER[i]), 0) for i in random.choice(len(AFTER), random.integers(0, 6), replace=False)]
        blocks, told = [], []
        for markup, label in sections + main + after:
            found = leaves(markup)
            blocks += found
            told += [label] * len(found)
        pages.append(vectors(blocks))
        labels.append(np.array(told, np.float32))
    return pages, labels


def train(pages: DataFrame, id_col: str, html_col: str, most: int = TRAINING_PAGES) -> Labeller:
    """The network for these pages, from the pages of at most ``LONGEST_SAMPLE`` bytes that come first in order of a hash
    of their id; the same on every run."""
    html = F.col(f"`{html_col}`")
    short = F.when(F.octet_length(html).between(1, LONGEST_SAMPLE), html)
    return Labeller(PATH_SIZE + WORD_SIZE + MEASURES).fit(*training_pages(first_texts(pages, id_col, short, most)))


def main_texts(network: Labeller, pages: list[str]) -> list[str]:
    blocks = [leaves(page) for page in pages]
    labels = network.label([vectors(own) for own in blocks])
    return ["\n".join(b.text for b, keep in zip(own, told) if keep) for own, told in zip(blocks, labels)]


def extract(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    network: Labeller | None = None,
) -> DataFrame:
    """Per page: id, url, ``text``, ``n_chars``.

    Every page is read whole; no shuffle. A null or empty html, or one without main text, has an empty text. Rows that
    repeat an id, null ids and null urls are kept as they are. Other columns are not read. An empty table gives no rows.
    """
    network = network or train(pages, id_col, html_col)
    html = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), html.alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str] = []
            for start in range(0, len(batch), 64):
                texts += main_texts(network, batch.column("html")[start : start + 64].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[id_col, url_col, "text", "n_chars"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, `{url_col}` string, text string, n_chars bigint")
