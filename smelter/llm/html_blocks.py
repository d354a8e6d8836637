"""Main text of web pages: a bidirectional LSTM labels each block from the whole page's blocks.

A page becomes a sequence of leaf blocks, each with its path of tags and its words. Both
are hashed into vectors; the network reads the sequence in both directions and says
which blocks belong to the article. It is trained on pages of the table itself, whose
blocks are labelled by their markup where it says something, with containers renamed or
stripped of their names and furniture added, so that it knows more ways of writing a
page than the table has, and has to go by words, lengths and neighbours as well.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.words import word_hashes

#: Pages that the network is trained on, at most, and the blocks that are used of each.
TRAINING_PAGES, TRAINING_BLOCKS = 240, 60
PATH_WIDTH, WORD_WIDTH, HIDDEN = 128, 16, 12
EPOCHS, BATCH, RATE = 20, 24, 0.015
#: Words that a block has at least to count as prose where no markup names an article.
PROSE = 12
#: Blocks times pages that are labelled at a time.
LABEL_CELLS = 40_000

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>"']|"[^"]*"|'[^']*')*/?)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[^<]+|<""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: Elements by their role in HTML.
HIDDEN_TEXT = {"script", "style", "template", "noscript", "textarea", "title", "iframe", "object", "svg", "head", "select", "button"}
RAW_TEXT = {"script", "style", "textarea", "title", "iframe", "noscript"}
#: Where the text of such an element ends; nothing else in it is markup.
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW_TEXT}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label",
    "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
#: An element that ends when one of these begins beside it.
ENDED_BY = {
    "p": {"p", "div", "ul", "ol", "dl", "table", "section", "article", "aside", "header", "footer", "nav", "form", "pre", "blockquote", "figure", "main", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "address", "fieldset"},
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}, "head": {"body"},
}
#: Names that authors give to the article, and to what stands around it.
ARTICLE_NAMES = ["article", "main", "content", "post", "entry", "story", "text", "body", "page"]
FURNITURE_NAMES = [
    "ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "banner", "promo", "nav", "navbar", "menu", "breadcrumb", "breadcrumbs", "header", "masthead",
    "footer", "sidebar", "aside", "widget", "related", "share", "social", "comment", "comments", "reply", "discussion", "notice", "cookie", "consent", "popup",
    "modal", "newsletter", "subscribe", "signup", "login", "search", "form", "pagination", "pager", "copyright", "legal", "disclaimer", "toolbar", "tags", "alert",
]
FURNITURE_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset"}
ARTICLE, FURNITURE = frozenset(ARTICLE_NAMES), frozenset(FURNITURE_NAMES)

Block = tuple[tuple[str, ...], str, int]


def names_of(tag: str, attributes: str) -> tuple[str, ...]:
    """An element as tokens: its tag, and the parts of its class, id and role."""
    out = [tag]
    for kind, *values in ATTRIBUTE.findall(attributes):
        for name in "".join(values).lower().split():
            out += [f".{part}" for part in re.split(r"[-_:]+", name) if part]
    return tuple(out)


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in their order: path tokens, text, and characters inside links.

    A block ends where an element begins or ends that isn't inline; a line break is
    white space in it. Unclosed and misnested elements are closed as browsers do.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    held: list[str] = []
    linked = hidden = at = 0

    def end_block() -> None:
        nonlocal linked
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            if text:
                out.append((tuple(t for _, names in stack if _ not in INLINE for t in names), text, linked))
            held.clear()
        linked = 0

    def close(tag: str, within: int = 0) -> None:
        nonlocal hidden
        at = next((i for i in range(len(stack) - 1, within - 1, -1) if stack[i][0] == tag), None)
        if at is not None:
            if any(name not in INLINE for name, _ in stack[at:]):
                end_block()
            hidden -= sum(name in HIDDEN_TEXT for name, _ in stack[at:])
            del stack[at:]

    while m := TOKEN.match(page, at):
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            found = m[0]
            if not hidden and (found[0] != "<" or found == "<"):
                held.append(found)
                if any(name == "a" for name, _ in stack):
                    linked += len(found)
        elif m[1] or m[4]:
            if tag == "br":
                held.append(" ")
            elif tag not in VOID:
                close(tag)
        else:
            for i in range(len(stack) - 1, -1, -1):
                name = stack[i][0]
                if tag in ENDED_BY.get(name, ()):
                    close(name, i)
                    break
                if name not in INLINE and name not in ENDED_BY:
                    break
            if tag == "br":
                held.append(" ")
            elif tag not in INLINE:
                end_block()
            attributes = m[3] if m[2] else m[6]
            if tag not in VOID and not attributes.endswith("/"):
                stack.append((tag, names_of(tag, attributes)))
                hidden += tag in HIDDEN_TEXT
                if tag in RAW_TEXT:
                    found = RAW_END[tag].search(page, at)
                    at = found.start() if found else len(page)
    end_block()
    return out


def marked(path: tuple[str, ...]) -> bool | None:
    """Whether the markup says that a block is of the article; None if it says nothing."""
    bare = {t.lstrip(".") for t in path if t[0] == "."}
    if FURNITURE_TAGS & {*path} or FURNITURE & bare:
        return False
    if {"article", "main"} & {*path} or ARTICLE & bare:
        return True
    return None


def labels_of(page: list[Block]) -> list[bool | None]:
    """What the markup says of each block. If it names no article, unlinked sentences that it says nothing of are taken for one."""
    out = [marked(path) for path, _, _ in page]
    if True not in out:
        prose = [len(text.split()) >= PROSE and text[-1] in ".!?\"\u201d" and 4 * linked < len(text) for _, text, linked in page]
        out = [True if told is None and p else told for told, p in zip(out, prose)]
    return out


def inside(path: tuple[str, ...]) -> tuple[str, ...]:
    """The path of an article's block below the element that marks it, without further marks."""
    mark = lambda t: t in ("article", "main") or t[0] == "." and t[1:] in ARTICLE
    at = next((i for i, t in enumerate(path) if mark(t)), None)
    if at is None:
        at = max((i for i, t in enumerate(path) if t in ("html", "body")), default=-1)
    at += 1
    while at < len(path) and path[at][0] == ".":
        at += 1
    return tuple(t for t in path[at:] if not mark(t))


def token_vector(token: str, width: int, known: dict = {}) -> np.ndarray:  # noqa: B006
    """A fixed pseudo-random vector of a token."""
    if (token, width) not in known:
        if len(known) > 50_000:
            known.clear()
        rng = np.random.default_rng(zlib.crc32(token.encode()))
        known[token, width] = rng.standard_normal(width).astype(np.float32)
    return known[token, width]


def word_vectors(texts: list[str]) -> np.ndarray:
    """Each text's words hashed into signed counts, scaled to length one."""
    hashes, bounds = word_hashes([t.lower().encode() for t in texts])
    block = np.repeat(np.arange(len(texts)), np.diff(bounds))
    at = block * WORD_WIDTH + ((hashes >> np.uint64(1)) % np.uint64(WORD_WIDTH)).astype(np.int64)
    sign = (hashes & np.uint64(1)).astype(np.float64) * 2 - 1
    out = np.bincount(at, sign, len(texts) * WORD_WIDTH).reshape(len(texts), WORD_WIDTH)
    return (out / np.maximum(1.0, np.sqrt((out * out).sum(axis=1, keepdims=True)))).astype(np.float32)


def vectors(page: list[Block]) -> np.ndarray:
    """The network's input for each block of a page."""
    out = np.zeros((len(page), PATH_WIDTH + WORD_WIDTH + 5), np.float32)
    paths: dict[tuple[str, ...], np.ndarray] = {}
    for i, (path, text, linked) in enumerate(page):
        if path not in paths:
            paths[path] = sum((token_vector(t, PATH_WIDTH) for t in dict.fromkeys(path)), np.zeros(PATH_WIDTH, np.float32)) / 4
        out[i, :PATH_WIDTH] = paths[path]
        out[i, -5:] = (np.log1p(len(text)) / 5, min(1.0, linked / len(text)), text[-1:] in ".!?", i == 0, i == len(page) - 1)
    out[:, PATH_WIDTH:-5] = word_vectors([text for _, text, _ in page])
    return out


@dataclass
class Network:
    """Input, recurrent and bias weights for each direction, and the output's weights."""

    w: list[np.ndarray]

    @classmethod
    def new(cls, rng: np.random.Generator) -> Network:
        width = PATH_WIDTH + WORD_WIDTH + 5
        one = lambda a, b: (rng.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
        bias = np.zeros(4 * HIDDEN, np.float32)
        bias[HIDDEN : 2 * HIDDEN] = 1  # remember at first
        return cls([one(width, 4 * HIDDEN), one(HIDDEN, 4 * HIDDEN), bias, one(width, 4 * HIDDEN), one(HIDDEN, 4 * HIDDEN), bias.copy(), one(2 * HIDDEN + width, 1)[:, 0], np.zeros(1, np.float32)])

    def read(self, x: np.ndarray, mask: np.ndarray, way: int) -> tuple[np.ndarray, list]:
        """Hidden states of one direction; x is blocks by pages by width."""
        wx, wh, b = self.w[3 * way : 3 * way + 3]
        steps = range(len(x)) if way == 0 else range(len(x) - 1, -1, -1)
        inputs = x @ wx + b
        h = c = np.zeros((x.shape[1], HIDDEN), np.float32)
        out, kept = np.zeros((len(x), x.shape[1], HIDDEN), np.float32), []
        for t in steps:
            z = inputs[t] + h @ wh
            gates = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            c_new = (f * c + i * g) * m
            squashed = np.tanh(c_new)
            h_new = o * squashed * m
            kept.append((t, h, c, i, f, o, g, squashed, m))
            h, c = h_new, c_new
            out[t] = h
        return out, kept

    def forward(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, tuple]:
        """The probability that each block is of the article, and what learning needs of the way there."""
        ahead, kept_a = self.read(x, mask, 0)
        back, kept_b = self.read(x, mask, 1)
        both = np.concatenate([ahead, back, x], axis=2)
        return 1 / (1 + np.exp(-(both @ self.w[6] + self.w[7]))), (both, kept_a, kept_b)

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray, told: np.ndarray | None = None) -> list[np.ndarray]:
        """Of the mean cross entropy over the blocks, or over those of them that are told."""
        p, (both, kept_a, kept_b) = self.forward(x, mask)
        told = mask if told is None else told
        d = ((p - y) * told / max(1.0, float(told.sum()))).astype(np.float32)
        grads = [np.zeros_like(w) for w in self.w]
        grads[6], grads[7] = np.tensordot(d, both, 2), d.sum(keepdims=True)[0]
        for way, kept in ((0, kept_a), (1, kept_b)):
            wh = self.w[3 * way + 1]
            out_w = self.w[6][way * HIDDEN : (way + 1) * HIDDEN]
            dh = dc = np.zeros((x.shape[1], HIDDEN), np.float32)
            dz_all = np.zeros((len(x), x.shape[1], 4 * HIDDEN), np.float32)
            for t, h, c, i, f, o, g, squashed, m in reversed(kept):
                dh = (dh + d[t][:, None] * out_w) * m
                dc = (dc + dh * o * (1 - squashed * squashed)) * m
                dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g * g)], axis=1)
                grads[3 * way + 1] += h.T @ dz
                dz_all[t] = dz
                dh, dc = dz @ wh.T, dc * f
            grads[3 * way] = np.tensordot(x, dz_all, ((0, 1), (0, 1)))
            grads[3 * way + 2] = dz_all.sum(axis=(0, 1))
        return grads


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(len(p) for p in pages)
    x = np.zeros((longest, len(pages), pages[0].shape[1]), np.float32)
    mask = np.zeros((longest, len(pages)), np.float32)
    for i, p in enumerate(pages):
        x[: len(p), i] = p
        mask[: len(p), i] = 1
    return x, mask


def redressed(page: list[Block], rng: np.random.Generator) -> tuple[list[Block], list[bool | None]]:
    """A page with its labels, its containers renamed at random, and furniture of other kinds around and inside.

    In a part of the pages nothing in the article's path tells it, and in half of those the
    page's own furniture around it has no telling names either.
    """
    pick = lambda names: names[rng.integers(len(names))]
    noise = lambda: (f".{pick('abcdefgh')}{rng.integers(99)}",) if rng.random() < 0.4 else ()
    some_name = lambda: tuple("." + "".join(pick("abcdefghiklmnoprstuw") for _ in range(rng.integers(2, 9))) for _ in range(rng.integers(0, 4)))

    def unnamed() -> tuple[str, ...]:
        if rng.random() < 0.25:
            return ("table", *some_name(), "tbody", "tr", "td", *some_name())
        return tuple(t for _ in range(rng.integers(0, 4)) for t in (pick(["div", "div", "section", "center"]), *some_name()))

    container = ("html", "body", *noise())
    plain = rng.random() < 0.4
    bare = plain and rng.random() < 0.5
    if plain:
        container += unnamed()
    elif rng.random() < 0.5:
        container += ("article",) + noise()
    elif rng.random() < 0.4:
        container += ("main", "article")
    else:
        container += (pick(["div", "section", "main"]), f".{pick(ARTICLE_NAMES)}", *noise())
    labels, out, around = labels_of(page), [], {}
    texts = [b for b in page if b[1]]
    for (path, text, linked), told in zip(page, labels):
        if told and plain:
            path = container + inside(path)
        elif told and "article" in path:
            path = container + path[path.index("article") + 1 :]
        elif told is False and bare and not ({"article", "main"} & {*path}):
            if path not in around:
                kept = tuple(t for t in path if t[0] != "." and t not in FURNITURE_TAGS and t not in ("html", "body"))
                around[path] = ("html", "body", *unnamed(), *kept)
            path = around[path]
        out.append((path, text, linked))

    def furniture() -> Block:
        _, text, linked = texts[rng.integers(len(texts))]
        words = text.split()
        start = int(rng.integers(max(1, len(words))))
        text = " ".join(words[start : start + int(rng.integers(1, 60))]) or text
        tag = pick(sorted(FURNITURE_TAGS)) if rng.random() < 0.4 else pick(["div", "section", "ul", "p", "span", "aside"])
        names = () if tag in FURNITURE_TAGS and rng.random() < 0.7 else (f".{pick(FURNITURE_NAMES)}", *noise())
        outer = container if rng.random() < 0.4 else ("html", "body")
        inner = pick([(), ("p",), ("ul", "li"), ("div", "p"), ("h3",), ("h2",), ("label",)])
        return (*outer, tag, *names, *inner), text, linked if rng.random() < 0.5 else 0

    for _ in range(int(rng.integers(0, 7))):
        where, block = int(rng.integers(len(out) + 1)), furniture()
        for k in range(int(rng.integers(1, 4))):
            out.insert(where, block if not k else (block[0], furniture()[1], block[2]))
            labels.insert(where, False)
    return out, labels


def train(pages: list[str], seed: int = 5) -> Network:
    """A network from raw pages; without any block to learn from it knows only its beginning."""
    rng = np.random.default_rng(seed)
    network = Network.new(rng)
    known = [b[:TRAINING_BLOCKS] if rng.random() < 0.5 else b[-TRAINING_BLOCKS:] for b in map(blocks_of, pages) if b]
    first, second = ([np.zeros_like(w) for w in network.w] for _ in range(2))
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(known))
        for at in range(0, len(order), BATCH):
            chosen = [known[i] for i in order[at : at + BATCH]]
            dressed = [redressed(b, rng) if rng.random() < 0.75 else (b, labels_of(b)) for b in chosen]
            x, mask = padded([vectors(b) for b, _ in dressed])
            y, _ = padded([np.array([bool(t) for t in labels], np.float32)[:, None] for _, labels in dressed])
            told, _ = padded([np.array([t is not None for t in labels], np.float32)[:, None] for _, labels in dressed])
            step += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for w, g, a, b in zip(network.w, network.gradients(x, mask, y[:, :, 0], told[:, :, 0]), first, second):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                w -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return network


def label(network: Network, pages: list[list[Block]]) -> list[np.ndarray]:
    """For each page, which of its blocks are of the article."""
    out = [np.zeros(0, bool)] * len(pages)
    order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and len(pages[order[end]]) * (end + 1 - at) <= LABEL_CELLS // 8:
            end += 1
        x, mask = padded([vectors(pages[i]) for i in order[at:end]])
        p, _ = network.forward(x, mask)
        for k, i in enumerate(order[at:end]):
            out[i] = p[: len(pages[i]), k] > 0.5
        at = end
    return out


def extractor(network: Network):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for at in range(0, batch.num_rows, 256):
                pages = [blocks_of(h.as_py() or "") for h in batch.column(2).slice(at, 256)]
                for page, chosen in zip(pages, label(network, pages)):
                    texts.append("\n".join(b[1] for b, c in zip(page, chosen) if c))
            n_chars = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), n_chars], ["page_id", "url", "text", "n_chars"])

    return extract


def training_pages(pages: DataFrame, most: int = TRAINING_PAGES) -> list[str]:
    """At most `most` pages, the ones with the smallest hashes of page_id."""
    ids = pages.filter("page_id is not null and length(html) > 0").select("page_id", F.xxhash64("page_id").alias("order")).distinct()
    drawn = ids.orderBy("order", "page_id").limit(most).select(F.col("page_id").alias("drawn_id"), "order")
    # only the chosen pages come to the driver, not the best ones of each task
    found = pages.join(F.broadcast(drawn), F.col("page_id") == F.col("drawn_id")).groupBy("order", "page_id").agg(F.max("html").alias("html"))
    return [row.html for row in sorted(found.collect(), key=lambda row: (row.order, row.page_id))]


def extract_main_text(pages: DataFrame, most: int = TRAINING_PAGES) -> DataFrame:
    """One row for each row of `pages`: page_id, url, text, n_chars.

    `text` has the blocks of the article in page order, a line each; it is empty for a
    null, empty or text-free page. Other columns are ignored; repeated rows give
    repeated results; an empty table gives no rows.
    """
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    network = train(training_pages(slim, most))
    return slim.mapInArrow(extractor(network), "page_id long, url string, text string, n_chars long")
