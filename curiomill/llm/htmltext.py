"""Operator 5: main text of web pages by a recurrent block labeller.

A page is cut at block tags into leaf blocks with their tag path. Each block becomes a vector: hashed tags and class
words of its path, hashed words of its text, and a few measures (length, links, position). A bidirectional LSTM in numpy
reads the blocks of a page in order and gives each the probability of being article text, so a block is judged by all
that stands before and after it.

The network is trained on the driver when the operator starts, from a bounded number of pages: TAUGHT_PAGES given pages
whose own semantic tags tell what the article is, and WRITTEN_PAGES pages written by rule in many layouts (with and
without semantic tags, with menus, notices, adverts, forms, sidebars and comments), whose blocks have known labels.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curiomill.llm.tables import bounded_sample

TAG_BINS, WORD_BINS, MEASURES = 160, 32, 8
INPUTS = TAG_BINS + WORD_BINS + MEASURES
HIDDEN = 20
TAUGHT_PAGES = 150
TAUGHT_CHARACTERS = 20_000  # given pages of fewer characters may be learned from; all pages are extracted
WRITTEN_PAGES = 450
EPOCHS = 14
PAGES_AT_ONCE = 128

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"<>]*\"|'[^'<>]*')*)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>|<[!?][^>]*>|</[^>]*>",
    re.S,
)
NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
TEXT_ONLY = {"script", "style", "textarea", "iframe"}  # without an end tag they reach to the end of the page
RAW = {"script", "style", "noscript", "template", "textarea", "svg", "iframe", "object"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "s",
    "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
ENDED_BY_BLOCK = {"p", "h1", "h2", "h3", "h4", "h5", "h6"}
ENDED_BY_SAME = {"li", "dt", "dd", "tr", "td", "th", "option"}
SPLIT = re.compile(r"[^a-z]+")


class Leaf(NamedTuple):
    text: str
    path: tuple[str, ...]  # tags from the outermost, each with its class words
    linked: int  # characters in links


def leaves(page: str) -> list[Leaf]:
    """Blocks of a page in order: text between block tags, with white space as one space and references decoded."""
    out: list[Leaf] = []
    stack: list[tuple[str, str]] = []
    held: list[tuple[str, bool]] = []

    def flush() -> None:
        if held:
            text = " ".join(html.unescape("".join(t for t, _ in held)).split())
            if text:
                linked = sum(len(" ".join(html.unescape(t).split())) for t, link in held if link)
                out.append(Leaf(text, tuple(k for _, k in stack if k), linked))
            held.clear()

    def cut_to(depth: int) -> None:
        del stack[depth:]

    at, n, links = 0, len(page), 0
    last = page.rfind(">") + 1  # no tag ends after this, so none is looked for
    endless: set[str] = set()  # elements known to have no end tag in the rest of the page
    while at < n:
        m = TOKEN.search(page, at, last) if at < last else None
        if m is None:
            comment = page.find("<!--", at)
            held.append((page[at : comment if comment >= 0 else n], links > 0))
            break
        if m.start() > at:
            held.append((page[at : m.start()], links > 0))
        at = m.end()
        name = m[2] or m[5]
        if not name:
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                at = n  # a comment without end
            continue
        name, closing, rest = name.lower(), m[1] or m[4], m[3] or m[6] or ""
        if name in RAW:
            if not closing and not rest.endswith("/"):
                end = None if name in endless else re.compile(rf"</{name}\b[^<>]*>", re.I).search(page, at)
                if end is not None:
                    at = end.end()
                elif name in TEXT_ONLY:
                    at = n
                else:  # only the tag goes: what follows may be the article
                    endless.add(name)
            continue
        if name == "a":
            links = max(0, links + (-1 if closing else 1))
            continue
        if name in INLINE:
            if name == "br":
                held.append((" ", False))
            continue
        flush()
        links = 0
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    cut_to(k)
                    break
            continue
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in ENDED_BY_BLOCK:
                cut_to(k)
                break
            if name in ENDED_BY_SAME and stack[k][0] == name:
                cut_to(k)
                break
            if stack[k][0] not in INLINE:
                break
        if name not in VOID and not rest.endswith("/"):
            words = sorted({w for found in NAMED.findall(rest) for part in found for w in SPLIT.split(part.lower()) if w}) if rest else []
            stack.append((name, " ".join([name, *words])))
    flush()
    return out


_tag_bins: dict[tuple[str, ...], np.ndarray] = {}


def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    """Hashed tags, tag pairs and class words; the innermost count most."""
    if path not in _tag_bins:
        if len(_tag_bins) > 50_000:
            _tag_bins.clear()
        v = np.zeros(TAG_BINS)
        for back, level in enumerate(reversed(path)):
            tag, *words = level.split(" ")
            for key in (f"t:{tag}", *(f"c:{w}" for w in words)):
                v[crc32(key.encode()) % TAG_BINS] += 1.0 if back < 3 else 0.7
            if back == 0:
                v[crc32(f"l:{tag}".encode()) % TAG_BINS] += 1
        _tag_bins[path] = v
    return _tag_bins[path]


def vectors(blocks: list[Leaf]) -> np.ndarray:
    x = np.zeros((len(blocks), INPUTS))
    for i, b in enumerate(blocks):
        x[i, :TAG_BINS] = _path_vector(b.path)
        words = b.text.lower().split(" ")
        bins = np.bincount([crc32(w.encode("utf-8", "surrogatepass")) % WORD_BINS for w in words], minlength=WORD_BINS)
        x[i, TAG_BINS : TAG_BINS + WORD_BINS] = bins / np.sqrt((bins * bins).sum())
        n = len(b.text)
        x[i, -MEASURES:] = (
            np.log1p(n) / 5, np.log1p(len(words)) / 4, min(b.linked, n) / n, i / len(blocks), len(blocks) ** -0.5,
            b.text[-1] in ".!?…\"'", sum(map(b.text.count, ",.;")) / len(words), "©" in b.text,
        )
    return x


class Net(NamedTuple):
    """Weights of the two directions (input, recurrent, bias; gates in order: in, forget, out, new) and of the output."""

    w: np.ndarray  # (2, INPUTS, 4 * HIDDEN)
    u: np.ndarray  # (2, HIDDEN, 4 * HIDDEN)
    b: np.ndarray  # (2, 4 * HIDDEN)
    v: np.ndarray  # (2 * HIDDEN,)
    c: np.ndarray  # (1,)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _run(net: Net, x: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
    """Output logits (pages, steps) of padded pages (pages, steps, INPUTS); ``keep`` holds what training needs."""
    pages, steps, _ = x.shape
    held, hidden = [], np.zeros((pages, steps, 2 * HIDDEN))
    for side in range(2):
        order = range(steps) if side == 0 else range(steps - 1, -1, -1)
        pre = x @ net.w[side] + net.b[side]
        h, c = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN))
        for t in order:
            z = pre[:, t] + h @ net.u[side]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[:, t : t + 1]
            new_c = m * (f * c + i * g) + (1 - m) * c
            tc = np.tanh(new_c)
            new_h = m * (o * tc) + (1 - m) * h
            if keep:
                held.append((side, t, h, c, i, f, o, g, tc, m))
            h, c = new_h, new_c
            hidden[:, t, side * HIDDEN : (side + 1) * HIDDEN] = h
    return hidden @ net.v + net.c[0], [hidden, held]


def _gradient(net: Net, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[float, Net]:
    logits, (hidden, held) = _run(net, x, mask, keep=True)
    p = _sigmoid(logits)
    count = mask.sum()
    loss = -(mask * (y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9))).sum() / count
    d = mask * (p - y) / count
    out = Net(*(np.zeros_like(a) for a in net))
    out.v[:] = np.einsum("pt,pth->h", d, hidden)
    out.c[0] = d.sum()
    dh_out = d[:, :, None] * net.v
    steps = x.shape[1]
    for side in range(2):
        dz = np.zeros((len(x), steps, 4 * HIDDEN))
        dh, dc = np.zeros((len(x), HIDDEN)), np.zeros((len(x), HIDDEN))
        for s, t, h, c, i, f, o, g, tc, m in reversed(held):
            if s != side:
                continue
            dh = dh + dh_out[:, t, side * HIDDEN : (side + 1) * HIDDEN]
            inner, inner_c = dh * m, dc * m
            inner_c = inner_c + inner * o * (1 - tc * tc)
            z = np.concatenate([inner_c * g * i * (1 - i), inner_c * c * f * (1 - f), inner * tc * o * (1 - o), inner_c * i * (1 - g * g)], axis=1)
            dz[:, t] = z
            out.u[side] += h.T @ z
            dh = z @ net.u[side].T + dh * (1 - m)
            dc = inner_c * f + dc * (1 - m)
        out.w[side] += np.einsum("pti,ptg->ig", x, dz, optimize=True)
        out.b[side] += dz.sum(axis=(0, 1))
    return float(loss), out


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, mask = np.zeros((len(pages), steps, INPUTS)), np.zeros((len(pages), steps))
    for k, p in enumerate(pages):
        x[k, : len(p)] = p
        mask[k, : len(p)] = 1
    return x, mask


def train(pages: list[tuple[np.ndarray, np.ndarray]], seed: int = 11) -> Net:
    """Fit the network to pages of block vectors and labels, with Adam; tag inputs are dropped at random."""
    rng = np.random.default_rng(seed)
    net = Net(rng.normal(0, 0.15, (2, INPUTS, 4 * HIDDEN)), rng.normal(0, 0.15, (2, HIDDEN, 4 * HIDDEN)), np.zeros((2, 4 * HIDDEN)), rng.normal(0, 0.2, 2 * HIDDEN), np.zeros(1))
    net.b[:, HIDDEN : 2 * HIDDEN] = 1
    first, second = [np.zeros_like(a) for a in net], [np.zeros_like(a) for a in net]
    pages = sorted(pages, key=lambda p: len(p[0]))
    batches = [pages[i : i + 24] for i in range(0, len(pages), 24)]
    step = 0
    for epoch in range(EPOCHS):
        for k in rng.permutation(len(batches)):
            x, mask = _padded([p for p, _ in batches[k]])
            y = np.zeros(mask.shape)
            for row, (_, labels) in enumerate(batches[k]):
                y[row, : len(labels)] = labels
            x[:, :, :TAG_BINS] *= rng.random((len(x), 1, TAG_BINS)) > 0.05
            _, grads = _gradient(net, x, y, mask)
            step += 1
            rate = 0.02 * (1 - epoch / EPOCHS) + 0.002
            norm = np.sqrt(sum((g * g).sum() for g in grads))
            for a, g, m, v in zip(net, grads, first, second, strict=True):
                g = g * min(1, 1 / (norm + 1e-9))
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                a -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


PLAIN = {"nav", "header", "footer", "aside", "form", "head", "menu", "dialog"}
PLAIN_WORDS = {"ad", "ads", "advert", "sidebar", "menu", "comment", "comments", "notice", "cookie", "banner", "promo", "share", "related", "widget"}


def taught(blocks: list[Leaf]) -> np.ndarray | None:
    """Labels by a page's semantic tags; None if it has no article."""
    inside = np.array([any(level.split(" ")[0] in ("article", "main") for level in b.path) for b in blocks])
    other = np.array([any(set(level.split(" ")[1:]) & PLAIN_WORDS or level.split(" ")[0] in PLAIN for level in b.path) for b in blocks])
    good = inside & ~other if len(blocks) else inside
    return good.astype(float) if good.any() else None


def written(count: int, seed: int = 5) -> list[tuple[str, list[int]]]:
    """Pages written by rule, with the label of each block."""
    rng = np.random.default_rng(seed)
    parts = np.array("re on ti the and of el la ung en er ist mo ra si ka lo ne pa du for with que de".split())
    pick = lambda *options: options[int(rng.integers(len(options)))]

    def words(low: int, high: int) -> str:
        return " ".join("".join(rng.choice(parts, int(rng.integers(1, 4)))) for _ in range(int(rng.integers(low, high + 1))))

    def sentence(low: int = 3, high: int = 30) -> str:
        return words(low, high).capitalize() + pick(".", ".", ".", "!", "?", "")

    def links(n: int, tag: str = "li") -> str:
        return "".join(f'<{tag}><a href="/{i}">{words(1, 3)}</a></{tag}>' for i in range(n))

    out = []
    for _ in range(count):
        labels: list[int] = []

        def block(markup: str, label: int, n: int = 1, labels: list[int] = labels) -> str:
            labels.extend([label] * n)
            return markup

        def boiler() -> str:
            kind = int(rng.integers(10))
            n = int(rng.integers(1, 7))
            if kind == 0:
                return block(f"<nav><ul>{links(n)}</ul></nav>", 0, n)
            if kind == 1:
                return block(f'<div class="{pick("menu", "nav", "navbar", "breadcrumb", "toc")}"><ul>{links(n)}</ul></div>', 0, n)
            if kind == 2:
                return block(f'<div class="{pick("ad", "ads", "advert", "promo", "sponsored", "banner")}">{sentence()}</div>', 0)
            if kind == 3:
                return block(f'<div class="{pick("cookie notice", "notice", "alert", "cookie-banner", "gdpr", "subscribe")}"><p>{sentence(6, 40)}</p></div>', 0)
            if kind == 4:
                return block(f'<{(t := pick("aside", "div"))} class="{pick("sidebar", "related", "widget", "side")}"><h3>{words(1, 3)}</h3>{block(f"<p>{sentence()}</p>", 0)}</{t}>', 0)
            if kind == 5:
                return block(f'<form action="/s"><label>{words(1, 3)}</label><input name="q"><button>{words(1, 1)}</button></form>', 0, 2)
            if kind == 6:
                return block(f"<script>var a = '</p>{words(2, 5)}';</script><!-- {words(2, 6)} -->", 0, 0)
            if kind == 7:
                return block(f'<div class="{pick("share", "social", "tags", "meta")}"><a href="#">{words(1, 2)}</a> <a href="#">{words(1, 2)}</a></div>', 0)
            if kind == 8:
                return block(f"<header><p>{words(1, 4)}</p></header>", 0)
            return ""

        body = "".join(boiler() for _ in range(int(rng.integers(0, 4))))
        holder = pick("article", "article", "article", "main", "div", "div", "section")
        name = pick("content", "post", "entry", "story", "body", "post-content", "text") if holder in ("div", "section") else pick("", "", "post", "content")
        body += f'<{holder} class="{name}">' if name else f"<{holder}>"
        if rng.random() < 0.9:
            body += block(f"<h1>{words(2, 14)}</h1>", 1)
        for _ in range(int(rng.integers(1, 14))):
            kind = rng.random()
            text = " ".join(sentence() for _ in range(int(rng.choice([1, 1, 2, 4, 8]))))
            if kind < 0.55:
                body += block(f"<p>{text}</p>", 1)
            elif kind < 0.7:
                body += block(f"<p><b>{text}<br>", 1)
            elif kind < 0.76:
                body += block(f"<h2>{words(1, 6)}</h2>", 1)
            elif kind < 0.8:
                n = int(rng.integers(2, 5))
                body += block("<ul>" + "".join(f"<li>{sentence()}</li>" for _ in range(n)) + "</ul>", 1, n)
            elif kind < 0.84:
                body += block(f"<blockquote>{text}</blockquote>", 1)
            elif kind < 0.9:
                body += block(f"<div>{text} <a href='/x'>{words(1, 2)}</a> {words(2, 6)}</div>", 1)
            elif kind < 0.93:
                body += boiler()
            else:
                body += block(f"<p>{words(1, 2)}.</p>", 1)
        body += f"</{holder}>"
        if rng.random() < 0.4:
            body += f'<{(t := pick("div", "section"))} {pick("id", "class")}="{pick("comments", "comment-list", "responses", "discussion")}">'
            for _ in range(int(rng.integers(1, 5))):
                body += block(f'<div class="comment"><p>{" ".join(sentence() for _ in range(3))}</p></div>', 0)
            body += f"</{t}>"
        body += "".join(boiler() for _ in range(int(rng.integers(0, 3))))
        if rng.random() < 0.85:
            body += block(f'<{(t := pick("footer", "footer", "div class=footer"))}>&copy; {words(1, 3)} &middot; {sentence()}</{t.split(" ")[0]}>', 0)
        head = f"<title>{words(2, 10)}</title><style>p{{margin:0}}</style>"
        out.append((f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>", [0, *labels]))
    return out


def fit(pages: DataFrame, html_col: str = "html") -> Net:
    """Train from at most TAUGHT_PAGES of the given pages and WRITTEN_PAGES written ones."""
    examples = []
    for page, labels in written(WRITTEN_PAGES):
        blocks = leaves(page)
        if len(blocks) != len(labels):
            raise AssertionError("a written page has other blocks than labels")
        examples.append((vectors(blocks), np.array(labels, float)))
    short = pages.filter(F.col(html_col).isNotNull() & (F.length(html_col) < TAUGHT_CHARACTERS)).select(html_col)
    sample = bounded_sample(short, [html_col], TAUGHT_PAGES)
    for row in sample:
        blocks = leaves(row[0])
        if (labels := taught(blocks)) is not None:
            examples.append((vectors(blocks), labels))
    return train(examples)


def main_texts(net: Net, pages: list[str]) -> list[str]:
    blocks = [leaves(p) for p in pages]
    out = [""] * len(pages)
    # pages of like length go together, a very long page alone
    order = sorted((k for k, b in enumerate(blocks) if b), key=lambda k: len(blocks[k]))
    at = 0
    while at < len(order):
        to = at + 1
        while to < len(order) and to - at < PAGES_AT_ONCE and (to - at + 1) * len(blocks[order[to]]) < 20_000:
            to += 1
        own = order[at:to]
        x, mask = _padded([vectors(blocks[k]) for k in own])
        logits, _ = _run(net, x, mask)
        for row, k in enumerate(own):
            out[k] = "\n".join(b.text for b, z in zip(blocks[k], logits[row], strict=False) if z > 0)
        at = to
    return out


def _extract(batches: Iterator[pa.RecordBatch], net: Net) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            texts = main_texts(net, [h or "" for h in part.column("html").to_pylist()])
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in part.schema.names if c != "html"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*(c for c in part.schema.names if c != "html"), "text", "n_chars"])


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of every page: (id, url, text, n_chars), one row each.

    Character references are decoded, white space inside a block becomes one space, blocks are joined in page order by
    a line feed. Null and empty pages, and pages without article blocks, give an empty text. Truncated markup is read
    as far as it goes. Repeated rows and null ids are given back as they are. Other columns are ignored.
    """
    source = pages.select(F.col(id_col), F.col(url_col), F.col(html_col).alias("html"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:2])
    return source.mapInArrow(partial(_extract, net=fit(source)), f"{kinds}, text string, n_chars long")
