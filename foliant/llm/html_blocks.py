"""Leaf blocks of a web page: what the block labeller reads."""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np

#: How HTML treats these elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style title template iframe noembed noframes select textarea button head".split())
INLINE = frozenset(
    ("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "math mi mn mo ms mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mtext mspace mstyle mpadded mphantom mfenced menclose semantics annotation "
    "svg g path circle rect line polyline polygon ellipse tspan use defs object canvas audio video map noscript").split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
#: Elements that end an open one of the same group, up to the container named.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

TAG = re.compile(r"<(?:!--|([/!?]?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|[!?/][^>]*>)")
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(r"\s+")
WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*|[0-9]+")


@dataclass(slots=True)
class Block:
    text: str
    path: tuple[str, ...]
    names: tuple[str, ...]
    linked: int
    after: int  # elements closed since the block before


def blocks(page: str | None) -> list[Block]:
    """Text runs between block-level boundaries, in page order. Malformed markup is read the way browsers mend it.

    Character references are decoded, white space becomes one space; scripts, styles, form controls and frames give no
    text. Hidden elements are blocks like others, with `hidden` among their names. Null or empty pages have no blocks.
    """
    out: list[Block] = []
    if not page:
        return out
    stack: list[tuple[str, tuple[str, ...]]] = []
    buffer: list[str] = []
    linked: list[int] = [0]
    state = {"a": 0, "closed": 0}

    def flush() -> None:
        if not buffer:
            return
        text = SPACE.sub(" ", html.unescape("".join(buffer))).strip()
        if text:
            out.append(Block(text, tuple(t for t, _ in stack), tuple(n for _, ns in stack for n in ns), min(linked[0], len(text)), state["closed"]))
            state["closed"] = 0
        buffer.clear()
        linked[0] = 0

    def close(upto: int) -> None:
        state["closed"] += len(stack) - upto
        del stack[upto:]

    def add(piece: str) -> None:
        if piece:
            buffer.append(piece)
            if state["a"]:
                linked[0] += len(piece.strip())

    at, size = 0, len(page)
    while at < size:
        m = TAG.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        if page.startswith("<!--", m.start()):
            end = page.find("-->", m.start() + 4)
            at = size if end < 0 else end + 3
            continue
        if m[2] is None or m[1] in ("!", "?"):
            continue
        tag = m[2].lower()
        if m[1] == "/":
            if tag == "a":
                state["a"] = 0
            elif tag in INLINE:
                continue
            else:
                flush()
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        close(i)
                        break
            continue
        given = m[3]
        if tag in DROPPED:
            flush()
            if not given.endswith("/"):
                at = _end_of(page, tag, at)
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in INLINE:
            if tag == "a":
                state["a"] = 1
            continue
        flush()
        if tag in VOID:
            continue
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    close(i)
                    break
                if stack[i][0] not in ("p",):
                    break
        if tag in SIBLINGS:
            same, within = SIBLINGS[tag]
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in within:
                    break
                if stack[i][0] in same:
                    close(i)
                    break
        if given.endswith("/") and tag not in CLOSES_P:
            continue
        stack.append((tag, _names(given) if given else ()))
        if tag in ("article", "div", "section", "p", "li", "td"):
            state["a"] = 0
    flush()
    return out


def _names(given: str) -> tuple[str, ...]:
    """Words of an element's class, id and role, and `hidden` where an attribute of that meaning says so."""
    out: list[str] = []
    for key, *values in ATTRIBUTE.findall(given):
        key, value = key.lower(), values[0] or values[1] or values[2]
        if key in ("class", "id", "role"):
            out += [w.lower() for w in WORDS.findall(value)]
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and "display:none" in SPACE.sub("", value.lower()):
            out.append("hidden")
    return tuple(out)


def _end_of(page: str, tag: str, at: int) -> int:
    """Where the dropped element ends: nested ones of its kind are counted; without an end, head ends at body, others at the page's end."""
    if tag in ("script", "style", "title", "textarea"):
        m = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
        return m.end() if m else len(page)
    depth = 1
    for m in re.compile(rf"<(/?){re.escape(tag)}\b[^>]*>" + (r"|<(body)\b" if tag == "head" else ""), re.I).finditer(page, at):
        if tag == "head" and m[2]:
            return m.start()
        depth += -1 if m[1] else 1
        if depth == 0:
            return m.end()
    return len(page)


PATH, NAMED, WORDED = 64, 96, 24
NUMBERS = 12
WIDTH = PATH + NAMED + WORDED + NUMBERS
MEMORY = 200_000


def _place(word: str, room: int, salt: int) -> tuple[int, float]:
    """Hashed place and sign of a word, the same in every process."""
    h = zlib.crc32(word.encode("utf-8", "replace"), salt)
    h ^= h >> 15
    return h % room, 1.0 if h >> 16 & 1 else -1.0


def _around(b: Block) -> np.ndarray:
    """Hashed tags and names of a block's elements; nearer tags weigh more, so a deep path stays bounded."""
    row = np.zeros(PATH + NAMED, dtype=np.float32)
    for d, t in enumerate(reversed(b.path)):
        k, s = _place(t, PATH, 1)
        row[k] += s * (1.5 if d == 0 else 0.9**d)
    for w, n in Counter(b.names).items():
        k, s = _place(w, NAMED, 2)
        row[PATH + k] += s * min(n, 3)
    return row


class Features:
    """Feature rows of blocks; places of words and paths are remembered up to MEMORY of each."""

    def __init__(self) -> None:
        self.paths: dict[tuple, np.ndarray] = {}
        self.words: dict[str, int] = {}

    def _words(self, words: list[str]) -> np.ndarray:
        """Hashed words of the whole block, as their mean over the square root of their number."""
        known, places = self.words, []
        for w in words:
            at = known.get(w)
            if at is None:
                k, s = _place(w.strip(".,:;!?"), WORDED, 3)
                at = known[w] = k if s > 0 else k + WORDED
            places.append(at)
        n = np.bincount(places, minlength=2 * WORDED)
        return (n[:WORDED] - n[WORDED:]) / np.sqrt(max(1, len(words)))

    def rows(self, page: list[Block]) -> np.ndarray:
        """One row per block: hashed tag path, hashed class and id words, hashed words of its text, and numbers."""
        if len(self.paths) > MEMORY:
            self.paths.clear()
        if len(self.words) > MEMORY:
            self.words.clear()
        x = np.zeros((len(page), WIDTH), dtype=np.float32)
        n = len(page)
        for i, b in enumerate(page):
            row, key = x[i], (b.path, b.names)
            if (around := self.paths.get(key)) is None:
                around = self.paths[key] = _around(b)
            row[: PATH + NAMED] = around
            words = b.text.lower().split()
            row[PATH + NAMED : -NUMBERS] = self._words(words)
            size = len(b.text)
            row[-NUMBERS:] = (
                min(np.log1p(size) / 6, 2), b.linked / max(1, size), min(size / 400, 2), min(len(b.path), 30) / 10, min(b.after, 6) / 6,
                1.0 if b.path and b.path[-1] in ("h1", "h2", "h3") else 0.0, 1.0 if b.path and b.path[-1] == "p" else 0.0,
                b.text.count(".") / max(1, len(words)), 1.0 if b.text[-1] in ".!?:\"" else 0.0, i / max(1, n), float("©" in b.text or "copyright" in b.text.lower()), float(i == 0),
            )
        return x
