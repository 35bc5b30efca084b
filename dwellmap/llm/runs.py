"""Periodic runs of words: stretches in which the same few words repeat.

A suffix automaton is built over the words, and its suffix links are taken as a link-cut tree. Words are
then appended one by one: the access to the state of a prefix makes the path from there to the root one
preferred path, coloured with the word's place. The path meets older preferred paths on its way, and each
of them tells, by its colour, where its strings ended last and, by its deepest state met, how long the
longest of them is. If two ends are no further apart than that length, the string stands twice in a row: a
square. The length also says how far the repetition reaches back, so a square with the same start and
period at the next word prolongs the same run.

Stretches that cannot hold a run are left out before: in a run, every string of m words (m at most the
period, and over half of it) stands again within a period, for many places in a row.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellmap.session import prepare

#: Texts looked at together; a longer text is looked at alone.
_TEXT_BYTES = 1 << 22
#: Periods up to this are searched by comparing words directly when stretches are chosen.
_DIRECT = 8

RESULT = (
    "n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, n_dropped long, collapsed string, collapsed_sha256 string, "
    "runs array<struct<start:long,length:long,period:long>>"
)


class SuffixAutomaton:
    """States of the substrings of a sequence; state 0 is the empty string.

    ``size`` is the length of a state's longest string, ``link`` the state of its longest proper suffix that
    ends elsewhere as well, ``ends[i]`` the state of the prefix that ends with word i. Most states have one
    transition, which is kept in two lists; only the others have a dictionary.
    """

    def __init__(self, words: list[int]):
        size, link, symbol, target = [0], [-1], [-1], [0]
        more: dict[int, dict[int, int]] = {}
        ends = []
        last = 0
        for word in words:
            state = len(size)
            size.append(size[last] + 1)
            link.append(0)
            symbol.append(-1)
            target.append(0)
            ends.append(state)
            at, found = last, -1
            while at >= 0:
                known = symbol[at]
                if known == word:
                    found = target[at]
                    break
                if known == -1:
                    symbol[at], target[at] = word, state
                else:
                    others = more.get(at)
                    if others is None:
                        more[at] = {word: state}
                    elif word in others:
                        found = others[word]
                        break
                    else:
                        others[word] = state
                at = link[at]
            if found >= 0:
                if size[found] == size[at] + 1:
                    link[state] = found
                else:
                    clone = len(size)
                    size.append(size[at] + 1)
                    link.append(link[found])
                    symbol.append(symbol[found])
                    target.append(target[found])
                    if found in more:
                        more[clone] = dict(more[found])
                    while at >= 0:
                        if symbol[at] == word:
                            if target[at] != found:
                                break
                            target[at] = clone
                        else:
                            others = more[at]
                            if others[word] != found:
                                break
                            others[word] = clone
                        at = link[at]
                    link[found] = link[state] = clone
            last = state
        self.size, self.link, self.ends = size, link, ends


class LinkCutTree:
    """Preferred paths of a rooted forest, each held as a splay tree ordered by depth.

    ``parent`` of a path's topmost splay node is the node above the path. The colour of a path is kept at the
    root of its splay tree.
    """

    def __init__(self, parents: list[int]):
        # Node numbers are shifted by one, so that 0 means none.
        self.parent = [p + 1 for p in itertools.chain((-1,), parents)]
        self.left = [0] * len(self.parent)
        self.right = [0] * len(self.parent)
        self.colour = [-1] * len(self.parent)

    def _splay(self, x: int) -> None:
        """Bring x to the root of its splay tree, and the path's colour to x."""
        parent, left, right = self.parent, self.left, self.right
        top = x
        while True:
            y = parent[x]
            if not y:
                break
            if left[y] == x:
                on_left = True
            elif right[y] == x:
                on_left = False
            else:
                break
            z = parent[y]
            inner_left = z and left[z] == y
            inner = inner_left or (z and right[z] == y)
            if inner:
                top = z
                above = parent[z]
                if inner_left == on_left:  # y over z first, then x over y
                    if on_left:
                        b, c = right[y], right[x]
                        left[z], right[y], left[y], right[x] = b, z, c, y
                    else:
                        b, c = left[y], left[x]
                        right[z], left[y], right[y], left[x] = b, z, c, y
                    if b:
                        parent[b] = z
                    if c:
                        parent[c] = y
                    parent[z], parent[y] = y, x
                else:  # x over y, then x over z
                    if on_left:
                        b, c = left[x], right[x]
                        right[z], left[y], left[x], right[x] = b, c, z, y
                    else:
                        c, b = left[x], right[x]
                        left[z], right[y], right[x], left[x] = b, c, z, y
                    if b:
                        parent[b] = z
                    if c:
                        parent[c] = y
                    parent[z] = parent[y] = x
                parent[x] = above
                if above:
                    if left[above] == z:
                        left[above] = x
                    elif right[above] == z:
                        right[above] = x
            else:
                top = y
                if on_left:
                    c = right[x]
                    left[y], right[x] = c, y
                else:
                    c = left[x]
                    right[y], left[x] = c, y
                if c:
                    parent[c] = y
                parent[y], parent[x] = x, z
                break
        if top != x:
            self.colour[x] = self.colour[top]

    def access(self, node: int, colour: int) -> Iterator[tuple[int, int]]:
        """Make the path from the root to ``node`` preferred, with ``colour``. Yields, from below, the
        deepest node met of each older preferred path that had a colour, and that colour."""
        met = []
        below, x = 0, node + 1
        while x:
            self._splay(x)
            old = self.colour[x]
            cut = self.right[x]
            if cut:
                self.colour[cut] = old
            self.right[x] = below
            if old >= 0:
                met.append((x - 1, old))
            below, x = x, self.parent[x]
        self.colour[below] = colour
        return met


def runs_of(words: list[int], min_length: int = 6, min_exponent: int = 4) -> list[tuple[int, int, int]]:
    """All maximal runs (start, length, smallest period) of a sequence with at least ``min_length`` words and
    ``min_exponent`` (2 or more) periods, by start and period."""
    automaton = SuffixAutomaton(words)
    tree, size = LinkCutTree(automaton.link), automaton.size
    ends: dict[tuple[int, int], int] = {}
    for i, state in enumerate(automaton.ends):
        for deepest, before in tree.access(state, i):
            period = i - before
            length = size[deepest] + period
            if length >= min_exponent * period and length >= min_length:
                ends[i - length + 1, period] = i
    return sorted((start, end - start + 1, period) for (start, period), end in ends.items())


def _stretches(places: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last of at least ``least`` consecutive numbers among sorted distinct ones."""
    if not len(places):
        return places, places
    breaks = np.flatnonzero(np.diff(places) != 1)
    first = places[np.append(0, breaks + 1)]
    last = places[np.append(breaks, len(places) - 1)]
    enough = last - first + 1 >= least
    return first[enough], last[enough]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def candidate_spans(
    words: np.ndarray, docs: np.ndarray, min_length: int = 6, min_exponent: int = 4
) -> list[tuple[int, int]]:
    """Stretches [begin, end) that hold every run of the documents laid end to end, in order.

    ``docs`` is the number of each word's document. Nothing is missed: a run of period q and length n has a
    word's equal q places before it n-q times in a row, and, for m in q/2 < m <= q, n-q-m+1 places in a row
    where a string of m words starts that also starts within 2m-1 places before. Strings of m words are
    compared by 64-bit hashes, doubled from level to level; equal strings have equal hashes.
    """
    n = len(words)
    starts, stops = [], []
    for q in range(1, min(_DIRECT, n)):
        same = np.flatnonzero(words[q:] == words[:-q])
        first, last = _stretches(same, max(min_length, min_exponent * q) - q)
        starts.append(first)
        stops.append(last + q + 1)
    key = _mixed(words.astype(np.uint64) + (docs.astype(np.uint64) << np.uint64(32)))
    m, alive, member = 1, np.arange(n), np.ones(n, bool)
    while m < _DIRECT and n:
        key[: n - m] = _mixed(key[: n - m] * np.uint64(3) + key[m:]) if n > m else key[: n - m]
        m *= 2
        alive = alive[: max(0, n - m + 1)]
        key = key[:n]
    member[:] = False
    member[: len(alive)] = True
    longest = int(np.bincount(docs).max()) if n else 0
    # Strings that stand once are sorted out by a table of counts, before anything is sorted.
    if len(alive):
        bits = max(10, int(n).bit_length() + 1)
        slot = (_mixed(key[: len(alive)]) >> np.uint64(64 - bits)).astype(np.int64)
        alive = np.flatnonzero(np.bincount(slot, minlength=1 << bits)[slot] > 1)
    while len(alive) and m * min_exponent <= longest:
        keys = key[alive]
        order = np.argsort(keys, kind="stable")
        ranked, at = keys[order], alive[order]
        same = ranked[1:] == ranked[:-1]
        near = same & (at[1:] - at[:-1] < 2 * m)
        least = min(max(min_length, min_exponent * q) - q - m + 1 for q in (m, 2 * m - 1))
        first, last = _stretches(np.sort(at[1:][near]), max(1, least))
        starts.append(first - (2 * m - 1))
        stops.append(last + m)
        again = np.zeros(len(at), bool)
        again[1:] |= same
        again[:-1] |= same
        alive = np.sort(at[again])
        member[:] = False
        member[alive] = True
        alive = alive[alive + m < n]
        alive = alive[member[alive + m]]
        key[alive] = _mixed(key[alive] * np.uint64(3) + key[alive + m])
        m *= 2
    begin = np.maximum(np.concatenate(starts), 0) if starts else np.zeros(0, np.int64)
    end = np.concatenate(stops) if stops else begin
    spans: list[tuple[int, int]] = []
    for k in np.argsort(begin, kind="stable").tolist():
        lo, hi = int(begin[k]), int(end[k])
        if spans and lo < spans[-1][1]:
            spans[-1] = (spans[-1][0], max(hi, spans[-1][1]))
        else:
            spans.append((lo, hi))
    return spans


def split_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def runs_of_all(
    texts: list[list[bytes]], min_length: int = 6, min_exponent: int = 4
) -> list[list[tuple[int, int, int]]]:
    """The runs of each sequence of words."""
    number: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
    sizes = np.array([len(t) for t in texts], np.int64)
    words = np.fromiter(
        map(number.__getitem__, itertools.chain.from_iterable(texts)), np.int64, int(sizes.sum())
    )
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    docs = np.repeat(np.arange(len(texts)), sizes)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for begin, end in candidate_spans(words, docs, min_length, min_exponent):
        # A stretch may reach over a border of two texts, a run does not.
        while begin < end:
            doc = int(docs[begin])
            until = min(end, int(bounds[doc + 1]))
            offset = begin - int(bounds[doc])
            for start, length, period in runs_of(words[begin:until].tolist(), min_length, min_exponent):
                found[doc].append((start + offset, length, period))
            begin = until
    return [sorted(runs) for runs in found]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run repeats: what it holds after its first period goes."""
    if not runs:
        return words
    stays = np.ones(len(words), bool)
    for start, length, period in runs:
        stays[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(stays).tolist()]


def continued(doc_id: object, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents, by the CRC-32 of their id, with a periodic end: from some place on, the
    words repeat with a period of at most a third of the rest."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    begin = g % n
    period = 1 + (n - begin) // (3 + g % 8)
    repeats = -(-(n - begin) // period)
    return words[:begin] + (words[begin : begin + period] * repeats)[: n - begin]


def _batches(ids: list, texts: Iterator) -> Iterator[tuple[list, list]]:
    """Rows in parts of at most _TEXT_BYTES characters, or one row."""
    first, part, held = 0, [], 0
    for row, text in enumerate(texts):
        value = text.as_py()
        if part and held + len(value or "") > _TEXT_BYTES:
            yield ids[first:row], part
            first, part, held = row, [], 0
        part.append(value)
        held += len(value or "")
    if part:
        yield ids[first:], part


def periodic_runs(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    min_length: int = 6,
    min_exponent: int = 4,
    rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None,
    with_text: bool = False,
) -> DataFrame:
    """Per document, its periodic runs and what is left when each run is collapsed to its first period.

    Words are stretches without ASCII white space of the whole text (null: none), numbered from 0. A run has
    at least ``min_length`` words and ``min_exponent`` (2 or more) times its smallest period, and cannot be
    prolonged. Returns the id, ``n_words``, ``n_runs``; ``start``, ``length``, ``period`` and
    ``exponent_milli`` of the longest run (ties: smallest start, then period; null if there is none);
    ``runs``, a list of all by start and period; ``runs_sha256`` of its lines ``start,length,period``;
    ``n_dropped`` words, and ``collapsed_sha256`` of the kept words joined by one space, with that text
    itself as ``collapsed`` if ``with_text`` (else null). ``rewrite`` may change a document's words first.
    Rows with equal or null ids are treated each on their own; other columns are not returned.

    A task holds at most some 4 MB of texts, or one text, at a time; nothing is shuffled.
    """
    prepare(docs.sparkSession)
    name = docs.schema[id_column].dataType.simpleString()

    def described(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        kept = collapse(words, runs)
        joined = b" ".join(kept)
        return (
            len(words),
            len(runs),
            *best,
            1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            len(words) - len(kept),
            joined.decode("utf-8", "surrogatepass") if with_text else None,
            hashlib.sha256(joined).hexdigest(),
            [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _batches(batch.column(0).to_pylist(), batch.column(1)):
                words = [split_words(t) for t in texts]
                if rewrite:
                    words = [rewrite(i, w) for i, w in zip(ids, words, strict=True)]
                rows = [
                    described(w, r)
                    for w, r in zip(words, runs_of_all(words, min_length, min_exponent), strict=True)
                ]
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, batch.schema.field(0).type),
                        *(pa.array(c, t) for c, t in zip(columns, types, strict=True)),
                    ],
                    names,
                )

    numbers, string = pa.int64(), pa.string()
    one = pa.struct([("start", numbers), ("length", numbers), ("period", numbers)])
    types = [numbers] * 6 + [string, numbers, string, string, pa.list_(one)]
    names = ["id", *(c.strip().split(" ")[0] for c in RESULT.split(", "))]
    source = docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, f"id {name}, {RESULT}").withColumnRenamed("id", id_column)
