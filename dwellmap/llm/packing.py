"""Packing of tokenised documents into sequences of a fixed length.

Whole sequences are cut off long documents at once. The rests are packed by first-fit decreasing,
with a tournament tree over the free room of the open sequences, in randomised groups of documents
that are independent of each other and of bounded size.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellmap.session import materialise, prepare

#: Documents in a group, on average.
GROUP_DOCS = 2048
#: A sequence with less room than this is padded; one with more is cut into powers of two instead.
MAX_PADDING = 32
#: Words whose ids a task keeps, the first it meets: frequent words are among them.
_CACHED_WORDS = 300_000
_CACHED_LENGTH = 48
_TEXT_BYTES = 1 << 22
_SPACE_IN_SPACE = re.compile(r"[^\S ] [^\S ]")

PIECES = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class _Words(dict):
    """Ids of words after a space, encoded when first asked for."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        found = self.encode(" " + word)
        if len(self) < _CACHED_WORDS and len(word) <= _CACHED_LENGTH:
            self[word] = found
        return found


class WordTokenizer:
    """Token ids of whole texts, with the ids of words kept for reuse.

    The byte-level pre-tokenizer always splits before a single space, unless white space stands on both
    sides of it, so pieces between such spaces can be encoded alone. New pieces are encoded with
    ``ranks``, a file of the same vocabulary as ranks with its split pattern, which gives the same
    ids several times faster, or else by the tokenizer itself. Texts with empty pieces (repeated or
    outer spaces), with other white space on both sides of a space, or with the name of a special token
    are given to the tokenizer whole.
    """

    def __init__(self, path: str, ranks: tuple[str, str] | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._piece = self._whole
        if ranks:
            import tiktoken

            with open(ranks[0], "rb") as lines:
                pairs = [line.split() for line in lines]
            known = {base64.b64decode(token): int(rank) for token, rank in pairs}
            encode = tiktoken.Encoding(
                "ranks", pat_str=ranks[1], mergeable_ranks=known, special_tokens={}
            ).encode_ordinary
            self._piece = lambda text: array("I", encode(text)).tobytes()
        self._known = _Words(self._piece)

    def _whole(self, text: str) -> bytes:
        return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str) -> np.ndarray:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        pieces = text.split(" ")
        if "" in pieces or _SPACE_IN_SPACE.search(text) or any(t in text for t in self._special):
            return np.frombuffer(self._whole(text), "<u4")
        first = self._piece(pieces[0])
        del pieces[0]
        known = self._known
        rest = [known[p] for p in pieces]
        return np.frombuffer(first + b"".join(rest), "<u4")


def _tokenised(path: str, ranks: tuple[str, str] | None, end_id: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(path, ranks)
        for batch in batches:
            column = batch.column(1)
            rows, held, first = [], 0, 0
            for row in range(len(batch)):
                text = column[row].as_py() or ""
                ids = np.append(tokenizer.ids(text), np.uint32(end_id)).astype("<u4")
                whole = len(ids) // length
                checks = [
                    zlib.crc32(ids[i * length : (i + 1) * length].tobytes()) for i in range(whole)
                ]
                tail = ids[whole * length :]
                # 16 bits are enough for most vocabularies; the width is told by the length.
                narrow = not len(tail) or int(tail.max()) < 1 << 16
                packed = tail.astype("<u2").tobytes() if narrow else tail.tobytes()
                rows.append((len(ids), np.array(checks, "<u4").tobytes(), packed))
                held += len(packed)
                if held > _TEXT_BYTES or row + 1 == len(batch):
                    tokens, full, tails = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(first, len(rows)),
                            pa.array(tokens, pa.int64()),
                            pa.array(full, pa.binary()),
                            pa.array(tails, pa.binary()),
                            batch.column(2).slice(first, len(rows)),
                        ],
                        ["id", "tokens", "full", "tail", "bin"],
                    )
                    rows, held, first = [], 0, row + 1

    return run


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each item: items by falling size, each into the first bin with room for it.

    The bins are the leaves of a tournament tree whose inner nodes hold the most room below them, so
    finding the first bin takes a step per level.
    """
    n = len(sizes)
    leaves = 1 << max(0, (n - 1).bit_length())
    room = [capacity] * (2 * leaves)
    bins = np.zeros(n, np.int64)
    for item in np.argsort(-sizes, kind="stable").tolist():
        size, node = int(sizes[item]), 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bins[item] = node - leaves
        room[node] -= size
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
    return bins


def _powers(total: int) -> list[int]:
    """Lengths of the sequences a bin's content becomes: powers of two, largest first."""
    return [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]


def pack_group(docs: list[tuple], length: int) -> list[tuple]:
    """Pieces of a group's documents, given as (tokens, checksums of full pieces, rest of the ids).

    Returns (document's place, start, length, crc, sequence, offset), sequences numbered from 0.
    """
    pieces, sequence = [], 0
    for place, (_, full, _) in enumerate(docs):
        for i, crc in enumerate(np.frombuffer(full, "<u4").tolist()):
            pieces.append((place, i * length, length, crc, sequence, 0))
            sequence += 1
    rests, places = [], []
    for place, (tokens, full, tail) in enumerate(docs):
        size = tokens - length * (len(full) // 4)
        if size:
            kind = "<u2" if len(tail) == 2 * size else "<u4"
            rests.append(np.frombuffer(tail, kind).astype("<u4"))
            places.append(place)
    sizes = np.array([len(r) for r in rests], np.int64)
    bins = first_fit_decreasing(sizes, length) if len(sizes) else sizes
    filled = np.bincount(bins, weights=sizes).astype(np.int64) if len(sizes) else sizes
    order = np.lexsort((np.arange(len(bins)), bins))
    content: dict[int, list[int]] = {}
    for item in order.tolist():
        content.setdefault(int(bins[item]), []).append(item)
    for number, items in content.items():
        total = int(filled[number])
        ends = [total] if total >= length - MAX_PADDING else list(np.cumsum(_powers(total)))
        at = begin = current = 0
        for item in items:
            ids, done = rests[item], 0
            base = docs[places[item]][0] - len(ids)
            while done < len(ids):
                take = min(len(ids) - done, int(ends[current]) - at)
                crc = zlib.crc32(ids[done : done + take].tobytes())
                pieces.append((places[item], base + done, take, crc, sequence, at - begin))
                done, at = done + take, at + take
                if at == ends[current]:
                    begin, current, sequence = at, current + 1, sequence + 1
    return pieces


def _pack(length: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        group = table["bin"][0].as_py()
        docs = list(zip(*(table[c].to_pylist() for c in ("tokens", "full", "tail")), strict=True))
        pieces = pack_group(docs, length)
        place, start, size, crc, sequence, offset = (
            np.array(c, np.int64) for c in zip(*pieces, strict=True)
        )
        return pa.table(
            {
                "id": table["id"].take(pa.array(place)),
                "start": start,
                "length": size,
                "ids_crc32": crc,
                "doc_tokens": table["tokens"].take(pa.array(place)),
                "sequence_id": sequence + (group << 32),
                "offset": offset,
            }
        )

    return run


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    length: int = 1024,
    end_id: int = 0,
    group_docs: int = GROUP_DOCS,
    id_column: str = "doc_id",
    text: str = "text",
    ranks: tuple[str, str] | None = None,
) -> DataFrame:
    """Cut every document's ids into pieces and place each piece in a sequence.

    A document's ids are those of its whole text (null: none) and ``end_id``. Returns per piece: the
    id, ``start`` (ids of the document before it), ``length``, ``ids_crc32`` (of the ids as
    little-endian unsigned 32-bit integers), ``doc_tokens``, ``sequence_id`` and ``offset``. Every id
    lies in exactly one piece, and the pieces of a sequence follow each other without gaps. A bin of
    ``length`` that first-fit leaves with more room than 32 is cut into sequences whose lengths are
    powers of two, which need no padding.

    Documents are dealt to groups by a hash of id and text, and rows that repeat more than an eighth of
    ``group_docs`` times by their place too, so a group holds about ``group_docs`` rows at any size of
    the table. A group gets checksums of whole sequences and less than one sequence
    of ids per document. Rows that repeat a document are packed each. ``ranks``: see
    ``WordTokenizer``; both files must be at the same path on every executor.
    """
    prepare(docs.sparkSession)
    groups = max(1, -(-docs.count() // group_docs))
    keyed = docs.select(
        F.col(id_column).alias("id"),
        F.col(text).cast("string").alias("text"),
        F.xxhash64(id_column, text).alias("h"),
    )
    # Rows that repeat very often are dealt to several groups by their place in the input.
    often = materialise(
        keyed.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > max(1, group_docs // 8))
    )
    apart = F.when(F.col("n").isNotNull(), F.xxhash64("h", F.monotonically_increasing_id())).otherwise(F.col("h"))
    source = keyed.join(often, "h", "left").select(
        "id", "text", F.pmod(apart, F.lit(groups)).alias("bin")
    )
    name = docs.schema[id_column].dataType.simpleString()
    tokenised = source.mapInArrow(
        _tokenised(tokenizer_path, ranks, end_id, length),
        f"id {name}, tokens long, full binary, tail binary, bin long",
    )
    packed = tokenised.groupBy("bin").applyInArrow(_pack(length), f"id {name}, {PIECES}")
    return packed.withColumnRenamed("id", id_column)
