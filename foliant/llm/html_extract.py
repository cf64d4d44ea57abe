"""Main text of web pages by a recurrent block labeller.

A bidirectional LSTM in numpy reads the page's leaf blocks as a sequence (tag path, class words, hashed text words) and
labels every block with the whole page as context. It is trained here, from a fixed seed, on pages that `invent()` lays
out with known labels: many kinds of navigation, headers, notices, adverts, sidebars, forms, comments and footers
around articles of many shapes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.html_blocks import WIDTH, Features, blocks

HIDDEN = 20
PAGES = 900
EPOCHS = 14
BATCH = 96


# Invented pages


def _prose(rng: np.random.Generator, n: int) -> str:
    letters = "etaoinshrdlucmfwypvbgéèäöüñ"
    words = ["".join(letters[int(k)] for k in rng.integers(0, len(letters), int(rng.integers(1, 10)))) for _ in range(n)]
    for i in range(0, n, int(rng.integers(5, 14))):
        words[i] = words[i].capitalize()
        if i:
            words[i - 1] += "."
    if rng.random() < 0.15:
        words = [w + str(rng.choice(["&amp;&amp;&amp;", "%%%", "$$$", "***", "!!"])) for w in words]
    return " ".join(words) + ("." if rng.random() < 0.8 else "")


def invent(rng: np.random.Generator) -> list[tuple[str, int | None]]:
    """Pieces of a page: markup and what a block of it is (1 main text, 0 not, None no text)."""
    pick = lambda *x: x[int(rng.integers(len(x)))]
    out: list[tuple[str, int | None]] = []
    semantic = rng.random() < 0.6

    def put(markup: str, text: str | None = None, label: int = 0) -> None:
        out.append((markup, None))
        if text is not None:
            out.append((text, label))

    def box(tag: str, names: str, fill, plain: str = "div") -> None:
        use = tag if semantic and rng.random() < 0.8 else plain
        attr = f' {pick("class", "id")}="{names}"' if use == plain or rng.random() < 0.5 else ""
        put(f"<{use}{attr}{hidden(0.05)}>")
        fill()
        put(f"</{use}>")

    def hidden(share: float) -> str:
        return pick(" hidden", " style='display: none'", " aria-hidden=true") if rng.random() < share else ""

    def links(n: int, block: str = "li") -> None:
        listed = block == "li"
        if listed:
            put("<ul>")
        for _ in range(n):
            put(f"<{block}><a href='/x'>", _prose(rng, int(rng.integers(1, 4))))
            put(f"</a></{block}>")
        if listed:
            put("</ul>")

    def some(low: int, high: int) -> str:
        return _prose(rng, int(rng.integers(low, high)))

    def nav() -> None:
        box("nav", pick("nav", "menu", "main-menu", "navbar", "top-nav", "breadcrumb", "site-navigation"), lambda: links(int(rng.integers(2, 9)), pick("li", "li", "div", "span")))

    def header() -> None:
        def fill() -> None:
            put(f"<{(t := pick('h1', 'div', 'p', 'h2'))}>", some(1, 6))
            put(f"</{t}>")
            if rng.random() < 0.5:
                put("<p>", some(3, 12))
                put("</p>")
            if rng.random() < 0.5:
                nav()

        box("header", pick("header", "site-header", "masthead", "top-bar", "page-header"), fill)

    def advert() -> None:
        kind = pick("ad", "ads", "advert", "banner", "promo", "sponsored", "ad-box", "advertisement")
        put(f'<{(t := pick("div", "aside", "section"))} {pick("class", "id")}="{kind}">')
        inner = pick("", "p", "a")
        put(f"<{inner}>" if inner else "", some(3, 45))
        put(f"</{inner}></{t}>" if inner else f"</{t}>")

    def notice() -> None:
        kind = pick("cookie-notice", "cookie", "notice", "consent", "alert", "gdpr-banner", "paywall", "popup", "modal")
        put(f'<div {pick("class", "id")}="{kind}"{hidden(0.3)}>')
        put("<p>", some(5, 40))
        put("</p>")
        if rng.random() < 0.5:
            put("<button>OK</button>")
        put("</div>")

    def side() -> None:
        def fill() -> None:
            for _ in range(int(rng.integers(1, 4))):
                put(f"<{(t := pick('h2', 'h3', 'h4', 'div'))}>", some(1, 5))
                put(f"</{t}>")
                if rng.random() < 0.6:
                    links(int(rng.integers(2, 7)))
                else:
                    put("<p>", some(4, 40))
                    put("</p>")

        box("aside", pick("sidebar", "side", "widget", "widgets", "related", "recommended", "rail", "more-stories"), fill)

    def form() -> None:
        put(f'<form class="{pick("search", "newsletter", "subscribe", "signup", "contact", "login")}">')
        if rng.random() < 0.7:
            put(f"<{(t := pick('p', 'h3', 'div'))}>", some(2, 18))
            put(f"</{t}>")
        put("<label>", some(1, 4))
        put("</label><input name='q'></form>")

    def comments() -> None:
        put(f'<{(t := pick("section", "div"))} {pick("class", "id")}="{pick("comments", "comment-list", "discussion", "replies", "responses", "reader-comments")}">')
        if rng.random() < 0.7:
            put("<h3>", some(1, 4))
            put("</h3>")
        for _ in range(int(rng.integers(1, 7))):
            put(f'<{(c := pick("div", "article", "li", "section"))} class="{pick("comment", "reply", "response", "post-comment", "user-comment")}">')
            if rng.random() < 0.6:
                put(f"<{(u := pick('span', 'h4', 'b', 'div'))}>", some(1, 3))
                put(f"</{u}>")
            put("<p>", some(3, 60))
            put(f"</p></{c}>")
        put(f"</{t}>")

    def share() -> None:
        put(f'<div class="{pick("share", "social", "tags", "author-bio", "byline", "meta", "share-buttons", "pagination", "related-posts")}">')
        links(int(rng.integers(1, 5)), pick("li", "span"))
        put("</div>")

    def footer() -> None:
        def fill() -> None:
            if rng.random() < 0.5:
                links(int(rng.integers(2, 7)), pick("li", "div"))
            put(f"<{(t := pick('p', 'div', 'small'))}>" if (tagged := rng.random() < 0.6) else "", pick("&copy; ", "Copyright ", "", "&copy; 2020 ") + some(2, 18))
            put(f"</{t}>" if tagged else "")

        box("footer", pick("footer", "site-footer", "page-footer", "bottom", "colophon"), fill)

    def article() -> None:
        if rng.random() < 0.75:
            put(f"<{(t := pick('h1', 'h1', 'h2'))}>", some(2, 12), 1)
            put(f"</{t}>")
        for _ in range(int(rng.integers(1, 22))):
            kind = rng.random()
            if kind < 0.66:
                long = rng.random() < 0.06
                text = " ".join([w for w in _prose(rng, 6).split() for _ in range(int(rng.integers(1, 500)))]) if long else some(1, 90)
                put(pick("<p>", "<p>", "<p>", "<p><b>", "<p class='text'>"), text, 1)
                put(pick("</p>", "</p>", "</p>", "<br>", ""))
            elif kind < 0.74:
                put(f"<{(t := pick('h2', 'h3', 'h4'))}>", some(1, 8), 1)
                put(f"</{t}>")
            elif kind < 0.80:
                put(f"<{(t := pick('ul', 'ol'))}>")
                for _ in range(int(rng.integers(1, 6))):
                    put("<li>", some(2, 25), 1)
                    put("</li>")
                put(f"</{t}>")
            elif kind < 0.84:
                put("<blockquote><p>", some(4, 40), 1)
                put("</p></blockquote>")
            elif kind < 0.87:
                put("<table><tr>")
                for _ in range(int(rng.integers(1, 6))):
                    put("<td>", some(1, 6), 1)
                    put("</td>")
                put("</tr></table>")
            elif kind < 0.90:
                put("<figure><figcaption>", some(3, 14), 1)
                put("</figcaption></figure>")
            elif kind < 0.93:
                put("<pre><code>", some(3, 30), 1)
                put("</code></pre>")
            elif kind < 0.95:
                put("<div>", some(5, 60), 1)
                put("</div>")
            elif kind < 0.955:
                put(f"<p{hidden(0.5)}><math><mi>", some(1, 3), 1)
                put("</mi></math></p>")
            elif kind < 0.975:
                advert()
            else:
                pick(share, form, side)()

    put("<html><body>")
    if rng.random() < 0.2:
        notice()
    before = [f for f, p in ((header, 0.45), (nav, 0.75), (advert, 0.45), (notice, 0.15), (form, 0.15), (side, 0.15)) if rng.random() < p]
    rng.shuffle(before)
    after = [f for f, p in ((side, 0.35), (advert, 0.2), (share, 0.25), (comments, 0.4), (form, 0.2), (nav, 0.1), (notice, 0.1)) if rng.random() < p]
    rng.shuffle(after)
    wrap = rng.random() < 0.4
    if wrap:
        put(f'<div {pick("class", "id")}="{pick("wrapper", "page", "container", "site", "layout")}">')
    for f in before:
        f()
    around = rng.random() < 0.35
    if around:
        put(f'<{pick("main", "div id=main", "div class=row")}>')
    if semantic and rng.random() < 0.85:
        put(f'<article{pick("", "", " class=post", " class=entry", " class=\'post hidden md:block\'")}{hidden(0.04)}>')
        end = "</article>"
    else:
        put(f'<{(t := pick("div", "div", "section", "main"))} {pick("class", "id")}="{pick("content", "article", "post", "entry-content", "main", "story", "article-body", "post-content", "text", "main-content", "body")}">')
        end = f"</{t}>"
    inside = comments in after and rng.random() < 0.2
    article()
    if inside:
        comments()
        after.remove(comments)
    put(end)
    if around:
        put("</main></div>")
    for f in after:
        f()
    if wrap:
        put("</div>")
    if rng.random() < 0.9:
        footer()
    if rng.random() < 0.9:
        put("</body></html>")
    return out


def labelled(rng: np.random.Generator) -> tuple[list, np.ndarray]:
    """Blocks of an invented page, and their labels by marks carried in the text."""
    pieces = invent(rng)
    page = "".join(m if label is None else f"\x02{label}{m}" for m, label in pieces)
    found = blocks(page)
    keep, y = [], []
    for b in found:
        marks = [b.text[i + 1] for i, c in enumerate(b.text[:-1]) if c == "\x02"]
        if not marks:
            continue
        y.append(1.0 if marks.count("1") * 2 >= len(marks) else 0.0)
        for d in "01":
            b.text = b.text.replace("\x02" + d, "")
        b.text = b.text.strip() or "x"
        keep.append(b)
    return keep, np.asarray(y, dtype=np.float32)


# The network


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def start(rng: np.random.Generator, hidden: int = HIDDEN) -> dict[str, np.ndarray]:
    p = {}
    for d in "fb":
        p[f"W{d}"] = rng.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, 4 * hidden)).astype(np.float32)
        p[f"U{d}"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden)).astype(np.float32)
        b = np.zeros(4 * hidden, dtype=np.float32)
        b[hidden : 2 * hidden] = 1
        p[f"b{d}"] = b
    p["O"] = rng.normal(0, 0.1, 2 * hidden).astype(np.float32)
    p["S"] = np.zeros(WIDTH, dtype=np.float32)
    p["c"] = np.zeros(1, dtype=np.float32)
    return p


def _run(z: np.ndarray, u: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """One direction over time-major gates z (T, B, 4H); states hold still where mask is 0."""
    t, b, h4 = z.shape
    n = h4 // 4
    h, c = np.zeros((b, n), dtype=np.float32), np.zeros((b, n), dtype=np.float32)
    out, trace = np.empty((t, b, n), dtype=np.float32), []
    for i in range(t):
        g = z[i] + h @ u
        gate = _sigmoid(g[:, : 3 * n])
        new = np.tanh(g[:, 3 * n :])
        m = mask[i][:, None]
        c1 = gate[:, n : 2 * n] * c + gate[:, :n] * new
        tc = np.tanh(c1)
        h1 = gate[:, 2 * n :] * tc
        if keep:
            trace.append((h, c, gate, new, tc, m))
        h, c = m * h1 + (1 - m) * h, m * c1 + (1 - m) * c
        out[i] = h
    return out, trace


def _back(d_out: np.ndarray, u: np.ndarray, trace: list) -> tuple[np.ndarray, np.ndarray]:
    t, b, n = d_out.shape
    dz, du = np.empty((t, b, 4 * n), dtype=np.float32), np.zeros_like(u)
    dh, dc = np.zeros((b, n), dtype=np.float32), np.zeros((b, n), dtype=np.float32)
    for i in range(t - 1, -1, -1):
        h, c, gate, new, tc, m = trace[i]
        dh = dh + d_out[i]
        d1 = dh * m
        e = dc * m + d1 * gate[:, 2 * n :] * (1 - tc**2)
        dg = np.concatenate([e * new, e * c, d1 * tc], axis=1) * gate * (1 - gate)
        g = np.concatenate([dg, e * gate[:, :n] * (1 - new**2)], axis=1)
        dz[i] = g
        du += h.T @ g
        dh = dh * (1 - m) + g @ u.T
        dc = dc * (1 - m) + e * gate[:, n : 2 * n]
    return dz, du


def logits(p: dict[str, np.ndarray], x: np.ndarray, mask: np.ndarray, keep: bool = False):
    """x (T, B, WIDTH), mask (T, B): the logit that a block is main text."""
    f, tf = _run(x @ p["Wf"] + p["bf"], p["Uf"], mask, keep)
    b, tb = _run((x @ p["Wb"] + p["bb"])[::-1], p["Ub"], mask[::-1], keep)
    both = np.concatenate([f, b[::-1]], axis=2)
    out = both @ p["O"] + x @ p["S"] + p["c"]
    return (out, both, tf, tb) if keep else out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    t = max(len(v) for v in pages)
    x, mask = np.zeros((t, len(pages), WIDTH), dtype=np.float32), np.zeros((t, len(pages)), dtype=np.float32)
    for i, v in enumerate(pages):
        x[: len(v), i] = v
        mask[: len(v), i] = 1
    return x, mask


@cache
def train(pages: int = PAGES, epochs: int = EPOCHS, seed: int = 11, hidden: int = HIDDEN) -> dict[str, np.ndarray]:
    """Adam on cross-entropy over invented pages; the same weights for the same arguments, made once per process."""
    rng = np.random.default_rng(seed)
    features = Features()
    data = [(features.rows(b), y) for b, y in (labelled(rng) for _ in range(pages)) if len(b)]
    data.sort(key=lambda d: len(d[1]))
    p = start(rng, hidden)
    m1, m2 = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}
    groups = [data[i : i + 32] for i in range(0, len(data), 32)]
    step = 0
    for epoch in range(epochs):
        rate = 0.012 * (0.82**epoch)
        for g in rng.permutation(len(groups)):
            x, mask = padded([v for v, _ in groups[g]])
            y = np.zeros(mask.shape, dtype=np.float32)
            for i, (_, t) in enumerate(groups[g]):
                y[: len(t), i] = t
            out, both, tf, tb = logits(p, x, mask, keep=True)
            d = (_sigmoid(out) - y) * mask / mask.sum()
            d_both = d[:, :, None] * p["O"]
            zf, uf = _back(d_both[:, :, :hidden], p["Uf"], tf)
            zb, ub = _back(d_both[::-1, :, hidden:], p["Ub"], tb)
            flat = x.reshape(-1, WIDTH)
            grads = {
                "Wf": flat.T @ zf.reshape(-1, 4 * hidden), "Uf": uf, "bf": zf.sum((0, 1)),
                "Wb": flat.T @ zb[::-1].reshape(-1, 4 * hidden), "Ub": ub, "bb": zb.sum((0, 1)),
                "O": both.reshape(-1, 2 * hidden).T @ d.reshape(-1), "S": flat.T @ d.reshape(-1), "c": d.sum().reshape(1),
            }
            step += 1
            for k, v in grads.items():
                v = np.clip(v, -1, 1)
                m1[k] += 0.1 * (v - m1[k])
                m2[k] += 0.002 * (v * v - m2[k])
                p[k] -= (rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.998**step)) + 1e-8)).astype(np.float32)
    return p


# The operator


def main_texts(p: dict[str, np.ndarray], pages: list[str | None], features: Features) -> list[str]:
    """Main text of each page, its blocks joined by newlines; pages of like length share a batch."""
    found = [blocks(h) for h in pages]
    out = [""] * len(pages)
    order = sorted((i for i in range(len(pages)) if found[i]), key=lambda i: len(found[i]))
    while order:
        longest = len(found[order[-1]])
        take = max(1, min(BATCH, 40_000 // longest))
        part, order = order[-take:], order[:-take]
        x, mask = padded([features.rows(found[i]) for i in part])
        keep = logits(p, x, mask) > 0
        for k, i in enumerate(part):
            out[i] = "\n".join(b.text for b, ok in zip(found[i], keep[:, k], strict=False) if ok)
    return out


def extract(pages: DataFrame, weights: dict[str, np.ndarray] | None = None, body: str = "html") -> DataFrame:
    """pages with text and n_chars (code points) of the main text in place of the html; other columns stay.

    Null or empty html gives an empty text; nothing is dropped or cut besides the blocks labelled as not main text.
    """
    own = [c for c in pages.columns if c not in (body, "text", "n_chars")]
    p = weights or train()
    schema = pages.select(*own).schema.add("text", "string").add("n_chars", "long")
    rows = pages.select(*own, pages[body].cast("string").alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            for at in range(0, batch.num_rows, 400):
                part = batch.slice(at, 400)
                texts = main_texts(p, part.column(part.num_columns - 1).to_pylist(), features)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*own, "text", "n_chars"]
                )

    return rows.mapInArrow(run, schema).select(*own, F.col("text"), F.col("n_chars"))
