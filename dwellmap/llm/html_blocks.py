"""Main text of web pages: a recurrent labeller of blocks.

A page becomes a sequence of leaf blocks. A bidirectional LSTM, written in NumPy, reads for each block
a hashed vector of its tag path and a hashed vector of its words, and labels every block with the
context of the whole page.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellmap.llm.sampling import hash_sample
from dwellmap.llm.texthash import chunks, words

_PATH, _WORD, _FORM = 192, 32, 8
INPUTS = _PATH + _WORD + _FORM
HIDDEN = 16
_BATCH_BLOCKS = 4096
_SAMPLE_BLOCKS = 2000

# Elements of HTML by how they end a block.
_INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data dfn em font i img ins del kbd mark picture q rp rt "
    "ruby s samp small source span strike strong sub sup time tt u var wbr".split()
)
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_SKIPPED = set("script style noscript template svg math iframe object canvas".split())
_CLOSED_BY_SIBLING = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}
_HOLDS_SIBLINGS = ("ul", "ol", "dl", "table", "select", "div")
_CLOSES_P = set(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main nav ol p pre section table ul".split()
)

_OPENING = re.compile(r"<(?:[!?]|/?[a-zA-Z])")
_NAME_END = re.compile(r"[\s/>]")
_QUOTE_OR_END = re.compile(r"[\"'>]")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"[a-z]+")
_LONG_REFERENCE = re.compile(r"&#0*([0-9]{1,9})[0-9]*")

_slots: dict[str, int] = {}


def _slot(name: str) -> int:
    if name not in _slots:
        if len(_slots) > 50_000:
            _slots.clear()
        _slots[name] = zlib.crc32(name.encode()) % _PATH
    return _slots[name]


class Path:
    """Open block elements from the outside in, each with the words of its class, id and role.

    A path shares all but its last element with the path around it, and so do the hashed names of its
    elements, kept as the bits of a number: a deeply nested page costs no more than a flat one. Compares
    and iterates like the tuple of its labels.
    """

    __slots__ = ("outer", "label", "depth", "bits", "last", "in_main", "in_other")

    def __init__(self, outer: Path | None = None, label: str = ""):
        self.outer, self.label = outer, label
        if outer is None:
            self.depth = self.bits = self.last = 0
            self.in_main = self.in_other = False
            return
        names = label.split(" ")
        self.depth = outer.depth + 1
        self.bits = outer.bits
        for name in names:
            self.bits |= 1 << _slot(name)
        self.last = 1 << _slot("/" + names[0])
        # Inside a main element, and below the outermost one of these in something else.
        self.in_main = outer.in_main or names[0] in _MAIN_ELEMENTS
        self.in_other = outer.in_other or (
            outer.in_main and (names[0] in _OTHER_ELEMENTS or not _OTHER_NAMES.isdisjoint(names[1:]))
        )

    def __len__(self) -> int:
        return self.depth

    def __iter__(self) -> Iterator[str]:
        labels, path = [], self
        while path.outer is not None:
            labels.append(path.label)
            path = path.outer
        return reversed(labels)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Path | tuple) and tuple(self) == tuple(other)

    def __hash__(self) -> int:
        return hash(tuple(self))


Block = tuple[str, Path, float]


class _Marks:
    """Finds comments, declarations and tags of a page from front to back.

    A tag ends at the first ``>`` outside quotes; without one, ``<`` is text. Takes time in proportion to
    the page: where a tag ends is remembered for every quote met on the way, and the next place of each
    kind is looked for again only once it is passed.
    """

    def __init__(self, page: str):
        self.page, self.size = page, len(page)
        self.ends: dict[int, int] = {}
        self.name_end = self.stop = -1

    def _find(self, pattern: re.Pattern, at: int) -> int:
        found = pattern.search(self.page, at)
        return found.start() if found else self.size

    def _tag_end(self, at: int) -> int:
        passed, end = [], -1
        while at < self.size:
            if self.page[at] == ">":
                end = at + 1
                break
            if at in self.ends:
                end = self.ends[at]
                break
            passed.append(at)
            closed = self.page.find(self.page[at], at + 1)
            if closed < 0:
                break
            at = self._find(_QUOTE_OR_END, closed + 1)
        self.ends.update(dict.fromkeys(passed, end))
        return end

    def after(self, look: int) -> tuple[int, int, bool, str, str] | None:
        """Start and end of the first one from ``look`` on, whether it closes an element, its name (empty
        for comments and declarations) and its attributes. ``look`` must not go back."""
        page = self.page
        while mark := _OPENING.search(page, look):
            start = mark.start()
            if page[start + 1] in "!?":
                comment = page.startswith("<!--", start)
                close = page.find("-->", start + 4) if comment else page.find(">", start + 2)
                end = self.size if close < 0 else close + (3 if comment else 1)
                return start, end, False, "", ""
            closes = page[start + 1] == "/"
            name = start + 1 + closes
            if self.name_end < name:
                self.name_end = self._find(_NAME_END, name)
            if self.stop < self.name_end:
                self.stop = self._find(_QUOTE_OR_END, self.name_end)
            end = self._tag_end(self.stop)
            if end > 0:
                return start, end, closes, page[name : self.name_end].lower(), page[self.name_end : end - 1]
            look = start + 1
        return None


def _plain(text: str) -> str:
    """Text with its character references decoded and white space as single spaces."""
    # Digits beyond the ninth can't lead to a character; Python refuses numbers of thousands of digits.
    return " ".join(html.unescape(_LONG_REFERENCE.sub(r"&#\1", text)).split())


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks of a page in order: text, tag path, share of characters in links.

    Character references are decoded and white space becomes single spaces. Scripts, styles, comments
    and other invisible parts give no block. Unclosed and misnested elements are repaired the way
    browsers do in the common cases. A path names the open block elements with the words of their
    class, id and role, from the outside in. Time and memory grow in proportion to the page, whatever
    its markup.
    """
    page = page or ""
    found: list[Block] = []
    # Open elements, None where an inline one was closed below others; their places by tag; the paths of
    # the block elements among them with their places.
    stack: list[str | None] = []
    places: dict[str, list[int]] = {}
    paths: list[tuple[int, Path]] = [(-1, Path())]
    text: list[str] = []
    linked = 0
    links_open = 0

    def flush() -> None:
        nonlocal linked
        if text:
            whole = _plain("".join(text))
            if whole:
                found.append((whole, paths[-1][1], min(1.0, linked / max(1, len(whole)))))
            text.clear()
        linked = 0

    def pop_to(depth: int) -> None:
        nonlocal links_open
        while len(stack) > depth:
            tag = stack.pop()
            if tag is None:
                continue
            places[tag].pop()
            links_open -= tag == "a"
            if paths[-1][0] == len(stack):
                paths.pop()

    def innermost(tag: str) -> int:
        return places[tag][-1] if places.get(tag) else -1

    at, end = 0, len(page)
    marks = _Marks(page)
    while mark := marks.after(at):
        start, after, closes, tag, attributes = mark
        if start > at:
            piece = page[at:start]
            text.append(piece)
            if links_open:
                linked += len(piece.strip())
        at = after
        if not tag:
            continue
        if closes:
            depth = innermost(tag)
            if depth < 0:
                if tag not in _INLINE:
                    flush()
                continue
            # A stray inline end tag must not close blocks.
            if tag in _INLINE and paths[-1][0] > depth:
                links_open -= tag == "a"
                stack[depth] = None
                places[tag].pop()
                continue
            if tag not in _INLINE:
                flush()
            pop_to(depth)
            continue
        if tag in _SKIPPED:
            if not attributes.rstrip().endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = close.end() if close else end
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag not in _INLINE:
            flush()
            if tag in _CLOSES_P and innermost("p") >= 0:
                pop_to(innermost("p"))
            if tag in _CLOSED_BY_SIBLING and innermost(tag) > max(map(innermost, _HOLDS_SIBLINGS)):
                pop_to(innermost(tag))
        if tag in _VOID:
            continue
        links_open += tag == "a"
        if tag not in _INLINE:
            hints = [next(filter(None, x.groups()[1:]), "") for x in _ATTRIBUTE.finditer(attributes)]
            label = " ".join([tag, *_NAME.findall(" ".join(hints).lower())])
            paths.append((len(stack), Path(paths[-1][1], label)))
        places.setdefault(tag, []).append(len(stack))
        stack.append(tag)
    if at < end:
        text.append(page[at:])
        if links_open:
            linked += len(page[at:].strip())
    flush()
    return found


def vectors(page: list[Block], start: int = 0, stop: int | None = None) -> np.ndarray:
    """One row of inputs per block from ``start`` to ``stop``: hashed tag path, hashed words, and a few
    shapes."""
    last_row = max(1, len(page) - 1)
    page = page[start:stop]
    out = np.zeros((len(page), INPUTS), np.float32)
    bits = b"".join((path.bits | path.last).to_bytes(_PATH // 8, "little") for _, path, _ in page)
    names = np.frombuffer(bits, np.uint8).reshape(len(page), _PATH // 8)
    out[:, :_PATH] = np.unpackbits(names, axis=1, bitorder="little")
    texts = pa.array([t for t, _, _ in page], pa.string())
    for first, last, data, bounds in chunks(texts):
        with np.errstate(over="ignore"):
            hashes, at = words(data, bounds)
        row = np.repeat(np.arange(first, last), np.diff(at))
        np.add.at(out, (row, _PATH + (hashes % np.uint64(_WORD)).astype(np.int64)), 1)
        count = np.maximum(np.diff(at), 1)[:, None]
        out[first:last, _PATH : _PATH + _WORD] = np.sqrt(out[first:last, _PATH : _PATH + _WORD] / count)
        length = np.diff(bounds)
        out[first:last, -8] = np.log1p(length) / 8
        out[first:last, -7] = np.log1p(count[:, 0]) / 6
    for row, (text, path, share) in enumerate(page):
        out[row, -6:] = (
            share,
            text[-1] in ".!?\"'”»…",
            min(len(path), 12) / 12,
            (start + row) / last_row,
            text[:1].isupper(),
            len(text) < 40,
        )
    return out


@dataclass
class Labeller:
    """Weights of a bidirectional LSTM with a logistic output per block."""

    w: np.ndarray  # (2, inputs, 4 * hidden)
    u: np.ndarray  # (2, hidden, 4 * hidden)
    b: np.ndarray  # (2, 4 * hidden)
    v: np.ndarray  # (2 * hidden)
    c: np.ndarray  # (1,)

    @classmethod
    def start(cls, seed: int = 0) -> Labeller:
        rng = np.random.default_rng(seed)
        bias = np.zeros((2, 4 * HIDDEN), np.float32)
        bias[:, HIDDEN : 2 * HIDDEN] = 1
        return cls(
            (rng.normal(size=(2, INPUTS, 4 * HIDDEN)) * 0.1).astype(np.float32),
            (rng.normal(size=(2, HIDDEN, 4 * HIDDEN)) * 0.2).astype(np.float32),
            bias,
            (rng.normal(size=2 * HIDDEN) * 0.2).astype(np.float32),
            np.zeros(1, np.float32),
        )

    def parts(self) -> list[np.ndarray]:
        return [self.w, self.u, self.b, self.v, self.c]

    def _run(
        self, x: np.ndarray, mask: np.ndarray, side: int, tape: list | None, carried: list | None = None
    ) -> np.ndarray:
        """Hidden states in one direction for pages x (page, block, input), padded at the end. ``carried``
        holds the state to go on from, and then the one reached."""
        pages, steps, _ = x.shape
        gates = x @ self.w[side] + self.b[side]
        h, s = carried or [np.zeros((pages, HIDDEN), np.float32) for _ in range(2)]
        out = np.zeros((pages, steps, HIDDEN), np.float32)
        for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
            z = gates[:, t] + h @ self.u[side]
            ifo = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
            i, f, o = ifo[:, :HIDDEN], ifo[:, HIDDEN : 2 * HIDDEN], ifo[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            keep = mask[:, t : t + 1]
            new = (f * s + i * g) * keep
            squashed = np.tanh(new)
            if tape is not None:
                tape.append((t, h, s, i, f, o, g, squashed, keep))
            h, s = o * squashed * keep, new
            out[:, t] = h
        if carried is not None:
            carried[:] = [h, s]
        return out

    def probabilities(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        states = np.concatenate([self._run(x, mask, side, None) for side in (0, 1)], axis=2)
        return 1 / (1 + np.exp(-(states @ self.v + self.c)))

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy per block, by back-propagation through the page."""
        tapes: list[list] = [[], []]
        states = np.concatenate([self._run(x, mask, side, tapes[side]) for side in (0, 1)], axis=2)
        p = 1 / (1 + np.exp(-(states @ self.v + self.c)))
        pull = (p - y) * mask / mask.sum()
        grads = [np.zeros_like(part) for part in self.parts()]
        grads[3] = np.einsum("pt,pth->h", pull, states).astype(np.float32)
        grads[4] = np.array([pull.sum()], np.float32)
        for side in (0, 1):
            down = pull[:, :, None] * self.v[side * HIDDEN : (side + 1) * HIDDEN]
            dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            dh = np.zeros((len(x), HIDDEN), np.float32)
            ds = np.zeros((len(x), HIDDEN), np.float32)
            for t, h, s, i, f, o, g, squashed, keep in reversed(tapes[side]):
                dh = (dh + down[:, t]) * keep
                ds = (ds + dh * o * (1 - squashed**2)) * keep
                dz = np.concatenate(
                    [ds * g * i * (1 - i), ds * s * f * (1 - f), dh * squashed * o * (1 - o), ds * i * (1 - g**2)],
                    axis=1,
                )
                grads[1][side] += h.T @ dz
                dz_all[:, t] = dz
                dh, ds = dz @ self.u[side].T, ds * f
            flat = dz_all.reshape(-1, 4 * HIDDEN)
            grads[0][side] = x.reshape(-1, INPUTS).T @ flat
            grads[2][side] = flat.sum(axis=0)
        return grads


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x = np.zeros((len(pages), steps, INPUTS), np.float32)
    mask = np.zeros((len(pages), steps), np.float32)
    for row, page in enumerate(pages):
        x[row, : len(page)] = page
        mask[row, : len(page)] = 1
    return x, mask


def fit(pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 12, seed: int = 0) -> Labeller:
    """Adam over batches of pages of like length; pages are (inputs, labels)."""
    model, rng = Labeller.start(seed), np.random.default_rng(seed)
    pages = sorted((p for p in pages if len(p[0])), key=lambda p: len(p[0]))
    batches = [pages[i : i + 48] for i in range(0, len(pages), 48)]
    m = [np.zeros_like(p) for p in model.parts()]
    v = [np.zeros_like(p) for p in model.parts()]
    step = 0
    for _ in range(epochs):
        for at in rng.permutation(len(batches)):
            x, mask = _padded([p[0] for p in batches[at]])
            y = np.zeros(mask.shape, np.float32)
            for row, (_, labels) in enumerate(batches[at]):
                y[row, : len(labels)] = labels
            step += 1
            for part, grad, m_, v_ in zip(model.parts(), model.gradients(x, mask, y), m, v, strict=True):
                m_ += 0.1 * (grad - m_)
                v_ += 0.01 * (grad * grad - v_)
                part -= 0.02 * (m_ / (1 - 0.9**step)) / (np.sqrt(v_ / (1 - 0.99**step)) + 1e-8)
    return model


def label(model: Labeller, pages: list[np.ndarray]) -> list[np.ndarray]:
    """Probability of being main text for every block of every page."""
    out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
    order = sorted((i for i, p in enumerate(pages) if len(p)), key=lambda i: len(pages[i]))
    while order:
        longest = len(pages[order[-1]])
        some = order[-max(1, _BATCH_BLOCKS // longest) :]
        del order[-len(some) :]
        p = model.probabilities(*_padded([pages[i] for i in some]))
        for row, i in enumerate(some):
            out[i] = p[row, : len(pages[i])]
    return out


def label_long(model: Labeller, page: list[Block]) -> np.ndarray:
    """The same for one page of any length, read in slices with the state carried on, so that only a slice
    is held as inputs."""
    score = np.full(len(page), model.c[0], np.float32)
    starts = range(0, len(page), _BATCH_BLOCKS)
    for side in (0, 1):
        carried = [np.zeros((1, HIDDEN), np.float32) for _ in range(2)]
        for start in starts if side == 0 else reversed(starts):
            x = vectors(page, start, start + _BATCH_BLOCKS)[None]
            states = model._run(x, np.ones(x.shape[:2], np.float32), side, None, carried)
            score[start : start + x.shape[1]] += states[0] @ model.v[side * HIDDEN : (side + 1) * HIDDEN]
    return 1 / (1 + np.exp(-score))


# How pages name the parts that are not the article, by kind, for the training layouts.
_PARTS = {
    "menu": (["nav", "ul", "div", "header"], ["menu", "nav", "navbar", "navigation", "breadcrumb", "topbar"]),
    "banner": (["header", "div"], ["header", "masthead", "banner", "branding", "site"]),
    "footer": (["footer", "div"], ["footer", "copyright", "legal", "bottom", "colophon"]),
    "sidebar": (["aside", "div", "section"], ["sidebar", "aside", "related", "widget", "recommended", "popular", "tags"]),
    "notice": (["div", "section", "aside", "p"], ["cookie", "notice", "consent", "alert", "gdpr", "popup", "modal", "newsletter"]),
    "advert": (["div", "aside", "ins"], ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo"]),
    "form": (["form", "div"], ["form", "search", "login", "subscribe", "signup", "contact"]),
    "comments": (["section", "div", "ol", "ul"], ["comments", "comment", "replies", "respond", "discussion", "reply"]),
}
_ARTICLE = (["article", "main", "div", "section"], ["content", "article", "post", "entry", "main", "story", "body", "text"])


def training_page(rng: np.random.Generator, vocabulary: list[str]) -> tuple[str, list[bool]]:
    """A page of random layout, and for each of its blocks whether it is main text."""
    chance = rng.random

    def phrase(low: int, high: int, stop: str = ".") -> str:
        chosen = [vocabulary[i] for i in rng.integers(0, len(vocabulary), rng.integers(low, high))]
        return html.escape(" ".join(chosen).capitalize() + stop)

    def named(kind: str, tags: list[str], names: list[str], always: bool = False) -> tuple[str, str]:
        tag = tags[rng.integers(len(tags))]
        bare = tag in ("nav", "header", "footer", "aside", "form", "article", "main")
        if bare and chance() < 0.5 and not always:
            return tag, ""
        name = names[rng.integers(len(names))]
        if chance() < 0.25:
            name += rng.choice(["-box", "-area", " wide", "-1", "_inner", " block"])
        return tag, f' {"id" if chance() < 0.25 else "class"}="{name}"'

    pieces: list[tuple[str, list[bool]]] = []

    def part(kind: str) -> tuple[str, list[bool]]:
        tag, hint = named(kind, *_PARTS[kind])
        many = kind in ("menu", "sidebar", "comments") or chance() < 0.3
        count = int(rng.integers(2, 8)) if many else 1
        rows = []
        for _ in range(count):
            words_ = phrase(3, 40) if kind == "comments" or chance() < 0.3 else phrase(1, 7, "" if chance() < 0.6 else ".")
            if kind in ("menu", "sidebar", "footer") and chance() < 0.7:
                words_ = f'<a href="/{rng.integers(99)}">{words_}</a>'
            rows.append(words_)
        if kind == "form":
            inside = "".join(f"<label>{r}</label><input name=x>" for r in rows) + "<button>" + phrase(1, 3, "") + "</button>"
            return f"<{tag}{hint}>{inside}</{tag}>", [False] * (len(rows) + 1)
        if tag in ("ul", "ol") or (many and chance() < 0.6):
            inside = "".join(f"<li>{r}</li>" for r in rows)
            inside = inside if tag in ("ul", "ol") else f"<ul>{inside}</ul>"
            return f"<{tag}{hint}>{inside}</{tag}>", [False] * count
        if many:
            return f"<{tag}{hint}>" + "".join(f"<p>{r}</p>" for r in rows) + f"</{tag}>", [False] * count
        return f"<{tag}{hint}>{rows[0]}</{tag}>", [False]

    def article() -> tuple[str, list[bool]]:
        tag, hint = named("article", *_ARTICLE, always=chance() < 0.3)
        out, labels = [], []
        if chance() < 0.8:
            out.append(f"<h1>{phrase(3, 12, '')}</h1>")
            labels.append(True)
        for n in range(int(rng.integers(1, 14))):
            draw = chance()
            if draw < 0.08:
                out.append(f"<h2>{phrase(1, 8, '')}</h2>")
            elif draw < 0.14:
                out.append(f"<ul><li>{phrase(2, 20)}</li></ul>")
            elif draw < 0.18:
                out.append(f"<blockquote>{phrase(5, 40)}</blockquote>")
            elif draw < 0.3:
                out.append(f"<p><b>{phrase(1, 60)}<br>")
            else:
                size = (1, 5) if chance() < 0.3 else (5, 150)
                out.append(f"<p>{phrase(*size)} <i>{phrase(1, 4)}</i></p>")
            labels.append(True)
            if chance() < 0.05:
                extra = part(str(rng.choice(["advert", "notice", "form", "sidebar"])))
                out.append(extra[0])
                labels += extra[1]
        if chance() < 0.15:
            extra = part("comments")
            out.append(extra[0])
            labels += extra[1]
        return f"<{tag}{hint}>" + "".join(out) + f"</{tag}>", labels

    for kind in ("banner", "menu", "notice", "advert", "sidebar"):
        if chance() < (0.7 if kind == "menu" else 0.4):
            pieces.append(part(kind))
    rng.shuffle(pieces)
    pieces.append(article())
    for kind in ("advert", "sidebar", "form", "comments", "notice", "footer"):
        if chance() < (0.8 if kind == "footer" else 0.35):
            pieces.append(part(kind))
    body = "".join(p[0] for p in pieces)
    if chance() < 0.4:
        body = f'<div{rng.choice(["", " id=wrap", " class=page", " class=container"])}>{body}</div>'
    title = phrase(3, 12, "")
    page = f"<html><head><title>{title}</title><style>p{{}}</style></head><body>{body}</body></html>"
    return page, [False, *(flag for p in pieces for flag in p[1])]


# Elements whose meaning HTML defines, as evidence for training.
_MAIN_ELEMENTS = {"article", "main"}
_OTHER_ELEMENTS = {"nav", "aside", "footer", "form", "header", "title", "button", "select"}
_OTHER_NAMES = {name for _, names in _PARTS.values() for name in names}


def evident_labels(page: list[Block]) -> np.ndarray | None:
    """Labels of a page's blocks where its own elements tell them; None for other pages.

    A block is evident main text inside an article or main element, unless an element inside of that
    is named as something else.
    """
    labels = [path.in_main and not path.in_other for _, path, _ in page]
    return np.array(labels, np.float32) if any(labels) else None


def train(
    pages: DataFrame, html_column: str = "html", sample_pages: int = 300, layouts: int = 450, seed: int = 0
) -> Labeller:
    """Learn from a bounded sample of pages and from generated layouts filled with their words.

    The sample is at most ``sample_pages`` distinct pages of at most 200,000 characters, by the order
    of a hash. Those with article or main elements and at most 2,000 blocks are examples themselves. ``layouts`` pages of
    random structure, whose labels are known, teach the parts that these pages don't show.
    """
    usable = pages.select(F.col(html_column).cast("string").alias("page")).where(
        F.length("page").between(1, 200_000)
    )
    sample = hash_sample(usable, ["page"], sample_pages).collect()
    rng = np.random.default_rng(seed)
    examples, known = [], set()
    for row in sample:
        found = blocks(row["page"])
        for text, _, _ in found:
            known.update(text.split(" ")[:300])
        labels = evident_labels(found)
        if labels is not None and len(found) <= _SAMPLE_BLOCKS:
            examples.append((vectors(found), labels))
    words_ = sorted(known)[: 50_000] or ["word", "text", "page"]
    for _ in range(layouts):
        few = rng.integers(0, len(words_), rng.integers(20, 2000))
        page, flags = training_page(rng, [words_[i] for i in few])
        found = blocks(page)
        if len(found) == len(flags):
            examples.append((vectors(found), np.array(flags, np.float32)))
    for inputs, _ in examples:
        # Half of the pages are read without their words, so that structure must suffice.
        if rng.random() < 0.5:
            inputs[:, _PATH : _PATH + _WORD] = 0
    return fit(examples, seed=seed)


def main_text(model: Labeller, pages: list[str | None]) -> list[str]:
    """Main text of each page: the blocks labelled so, in page order, joined by single spaces."""
    out: list[str] = []
    some: list[list[Block]] = []

    def finish() -> None:
        for page, chosen in zip(some, label(model, [vectors(p) for p in some]), strict=True):
            out.append(" ".join(text for (text, _, _), p in zip(page, chosen, strict=True) if p >= 0.5))
        some.clear()

    held = 0
    for page in pages:
        found = blocks(page)
        held += len(found)
        if held > 4 * _BATCH_BLOCKS:
            finish()
            held = len(found)
        if len(found) > _BATCH_BLOCKS:
            chosen = label_long(model, found)
            finish()
            out.append(" ".join(text for (text, _, _), p in zip(found, chosen, strict=True) if p >= 0.5))
            held = 0
        else:
            some.append(found)
    finish()
    return out


def extract(pages: DataFrame, model: Labeller, html_column: str = "html") -> DataFrame:
    """Add ``text``, the main text of the whole page, and ``n_chars``, its code points.

    Pages without main text, empty pages and null give an empty text. Existing columns of these names
    are replaced; rows are neither added nor lost.
    """

    @F.arrow_udf("string")
    def texts(column: pa.Array) -> pa.Array:
        out: list[str] = []
        some: list[str | None] = []
        held = 0
        for page in column:
            some.append(page.as_py())
            held += len(some[-1] or "")
            if held > 1 << 20:
                out += main_text(model, some)
                some, held = [], 0
        return pa.array(out + main_text(model, some), pa.string())

    kept = [c for c in pages.columns if c not in ("text", "n_chars")]
    done = pages.select(*kept, texts(F.col(html_column).cast("string")).alias("text"))
    return done.select(*kept, "text", F.length("text").cast("long").alias("n_chars"))
