"""Token ids in flat binary files that can be memory-mapped.

A folder of token files holds one long sequence of ids, that of all documents in the order of their ids, cut
into shards. A shard has three files without headers of their own making:

* ``.ids``: the token ids, unsigned little-endian integers of 16 bits, or of 32 for vocabularies beyond 65536,
* ``.offsets``: unsigned little-endian 64-bit integers, the place of each document's first id in the shard, and
  the shard's number of ids at the end,
* ``.docs``: the documents' ids, as an Arrow file of one column.

The table ``manifest`` (Parquet) names the shards' files and has ``base``, the number of ids in all shards
before. It is the sum of the counts that the writing tasks report, so no text is read for it. A shard's files
are named by the attempt that wrote them; only those that the manifest names count, so tasks may be repeated.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.ipc
from pyarrow.fs import FileSelector, FileSystem, LocalFileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dwellmap.session import prepare

#: Bytes of text in a shard, about.
SHARD_BYTES = 64 << 20
#: Words whose ids a task keeps, the first it meets: frequent words are among them.
_CACHED_WORDS = 400_000
_CACHED_LENGTH = 48
_ROWS = 8192

MANIFEST = "shard long, name string, n_docs long, n_tokens long, width int"


class WordwiseTokenizer:
    """Ids of whole texts, for tokenizers that drop white space, never join what stands on two sides of it,
    and part letters from marks behind them (``is_wordwise``).

    Such a tokenizer gives a text the ids of its words one after the other, so words met before need not be
    encoded again. ``width`` is the number of bytes of an id. Texts with the name of a special token are
    encoded whole.
    """

    def __init__(self, path: str, width: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._special = [t.content.encode().lower() for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._kind = "H" if width == 2 else "I"
        self._width = width
        self._known: dict[bytes, bytes] = {}
        self._ends = _last_tokens(self._tokenizer)

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self._kind, e.ids).tobytes() for e in found]

    def _plain_ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of Latin letters: encoded as one text, which is cut behind the last token of each word."""
        if not words or self._ends is None:
            return self._ids([w.decode() for w in words])
        text = b" ".join(words).decode()
        ids = np.array(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)
        cuts = (np.flatnonzero(self._ends[ids]) + 1) * self._width
        if len(cuts) != len(words):
            # The tokenizer parts one of the words.
            return self._ids([w.decode() for w in words])
        data = array(self._kind, ids.tolist()).tobytes()
        cuts = cuts.tolist()
        return [data[a:b] for a, b in zip([0, *cuts], cuts)]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian integers."""
        data = text.encode()
        # Small and capital letters are alike, but not below combining marks: some letters have a composed
        # form in one case only, and forms are composed before the tokenizer changes the case.
        low = data if b"\xcc" in data or b"\xcd" in data else data.lower()
        if any(s in low for s in self._special) or not low:
            return self._ids([text])[0]
        words = low.split()
        known = self._known
        found = list(map(known.get, words))
        if None not in found:
            return b"".join(found)
        parts = {w: _parted(w) for w in {w for w, v in zip(words, found) if v is None}}
        pieces = [p for p in {p for both in parts.values() for p in both} if p not in known]
        plain, other = [], []
        for p in pieces:
            (plain if _is_plain(p) else other).append(p)
        ids = dict(zip(plain, self._plain_ids(plain), strict=True))
        ids.update(zip(other, self._ids([p.decode() for p in other]), strict=True))
        room = _CACHED_WORDS - len(known)
        if room > 0:
            known.update((p, v) for p, v in ids.items() if len(p) <= _CACHED_LENGTH)
        for word, both in parts.items():
            if len(both) == 2:
                ids[word] = b"".join([ids[p] if p in ids else known[p] for p in both])
                if room > _CACHED_WORDS // 2:
                    known[word] = ids[word]
        return b"".join([ids[w] if v is None else v for w, v in zip(words, found)])


def _last_tokens(tokenizer) -> np.ndarray | None:
    """Which ids end a word, for tokenizers that mark these and can end a word in any byte; None for others."""
    suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
    if not suffix:
        return None
    vocab = tokenizer.get_vocab()
    single = {t for t in vocab if len(t) == 1}
    if len(single) < 256 or any(t + suffix not in vocab for t in single):
        return None
    ends = np.zeros(max(vocab.values()) + 1, bool)
    ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
    return ends


def _is_plain(word: bytes) -> bool:
    """Whether a word consists of Latin letters."""
    letters = word.decode()
    return letters.isalpha() and max(letters) < "\u0250"


def _parted(word: bytes) -> tuple[bytes, ...]:
    """A word of Latin letters and the punctuation behind it, or the word as it is."""
    body = word.rstrip(b".,;:!?")
    if body and len(body) < len(word):
        if _is_plain(body):
            return body, word[len(body) :]
    return (word,)


def is_wordwise(tokenizer) -> bool:
    """Whether a tokenizer treats samples as ``WordwiseTokenizer`` does: white space is dropped and parts, so
    do marks behind letters, and case doesn't matter."""
    sample = ["some words' l'eau, 12.5%", "été?! مرحبا 你好", "a", "i'm -- x_y..."]
    whole = tokenizer.encode("  " + " \n\t ".join(sample).upper() + " ", add_special_tokens=False).ids
    parts = [p.decode() for w in " ".join(sample).encode().split() for p in _parted(w)]
    return whole == [i for p in parts for i in tokenizer.encode(p, add_special_tokens=False).ids]


def _store(uri: str) -> tuple[FileSystem, str]:
    return FileSystem.from_uri(uri)


def _write_shards(path: str, tokenizer_path: str, end_id: int, width: int, wordwise: bool):
    kind = "<u2" if width == 2 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        shard = TaskContext.get().partitionId()
        store, root = _store(path)
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}"
        if wordwise:
            encode = WordwiseTokenizer(tokenizer_path, width).encode
        else:
            whole = Tokenizer.from_file(tokenizer_path)

            def encode(text: str) -> bytes:
                return np.array(whole.encode(text, add_special_tokens=False).ids, kind).tobytes()

        end = np.array([end_id], kind).tobytes()
        offsets, place, ids, docs = array("Q", [0]), 0, None, None
        for batch in batches:
            if not len(batch):
                continue
            if ids is None:
                ids = store.open_output_stream(f"{root}/{name}.ids")
                docs_file = store.open_output_stream(f"{root}/{name}.docs")
                docs = pa.ipc.new_file(docs_file, pa.schema([("id", batch.schema.field(0).type)]))
            for text in batch.column(1):
                data = encode(text.as_py() or "") + end
                ids.write(data)
                place += len(data) // width
                offsets.append(place)
            docs.write_batch(pa.RecordBatch.from_arrays([batch.column(0)], ["id"]))
        if ids is None:
            return
        ids.close()
        docs.close()
        docs_file.close()
        with store.open_output_stream(f"{root}/{name}.offsets") as out:
            out.write(np.frombuffer(offsets, np.uint64).astype("<u8").tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([v], t)
                for v, t in (
                    (shard, pa.int64()),
                    (name, pa.string()),
                    (len(offsets) - 1, pa.int64()),
                    (place, pa.int64()),
                    (width, pa.int32()),
                )
            ],
            ["shard", "name", "n_docs", "n_tokens", "width"],
        )

    return run


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int,
    id_column: str = "doc_id",
    text: str = "text",
    shard_bytes: int = SHARD_BYTES,
) -> TokenFiles:
    """Encode every whole text (null: empty), append ``end_id`` to each, and write the files to a new folder
    ``path`` that driver and executors reach under the same name, in ascending order of the documents' ids.

    A null id comes first. Rows with the same id follow each other by a hash of their text; a repeated row is
    written as often as it comes. Ids may be of any type that Arrow holds. An empty table gives a manifest
    without rows. Other columns are not written.

    Rows are dealt to shards by ranges of id, hash and place in the input, so also rows with one id are split.
    A task streams its rows to the store and holds places and ids of its documents only.
    """
    from tokenizers import Tokenizer

    spark = prepare(docs.sparkSession)
    tokenizer = Tokenizer.from_file(tokenizer_path)
    width = 2 if max(tokenizer.get_vocab_size() - 1, end_id) < 1 << 16 else 4
    store, root = _store(path)
    if any(True for _ in store.get_file_info(FileSelector(root, allow_not_found=True))):
        raise ValueError(f"{path} is not empty")
    store.create_dir(root)
    source = docs.select(
        F.col(id_column).alias("id"),
        F.col(text).cast("string").alias("text"),
    )
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    ordered = (
        source.withColumns({"h": F.xxhash64("text"), "at": F.monotonically_increasing_id()})
        .repartitionByRange(shards, "id", "h", "at")
        .sortWithinPartitions("id", "h", "at")
        .select("id", "text")
    )
    written = ordered.mapInArrow(
        _write_shards(path, tokenizer_path, end_id, width, is_wordwise(tokenizer)), MANIFEST
    )
    written.write.parquet(f"{path}/counts")
    # One row a shard; the sum over those before is all that needs an order.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = spark.read.schema(MANIFEST).parquet(f"{path}/counts")
    counts.withColumns(
        {
            "base": F.coalesce(F.sum("n_tokens").over(before), F.lit(0)),
            "first_doc": F.coalesce(F.sum("n_docs").over(before), F.lit(0)),
            "id_type": F.lit(docs.schema[id_column].dataType.simpleString()),
        }
    ).write.parquet(f"{path}/manifest")
    return TokenFiles.open(spark, path)


def _mapped(store: FileSystem, file: str, kind: str) -> np.ndarray:
    """A flat file as an array: mapped into memory where it is a local or mounted one, read otherwise."""
    if isinstance(store, LocalFileSystem):
        return np.memmap(file, kind, "r") if os.path.getsize(file) else np.zeros(0, kind)
    with store.open_input_file(file) as source:
        return np.frombuffer(source.read_buffer(), kind)


@dataclass
class Shard:
    """One shard, opened."""

    ids: np.ndarray
    offsets: np.ndarray
    docs: pa.ChunkedArray

    @staticmethod
    def open(path: str, name: str, n_docs: int, n_tokens: int, width: int) -> Shard:
        store, root = _store(path)
        ids = _mapped(store, f"{root}/{name}.ids", "<u2" if width == 2 else "<u4")
        offsets = _mapped(store, f"{root}/{name}.offsets", "<u8")
        if len(ids) != n_tokens or len(offsets) != n_docs + 1 or int(offsets[-1]) != n_tokens:
            raise ValueError(f"{path}/{name}: the files are not as long as the manifest says")
        local = isinstance(store, LocalFileSystem)
        file = f"{root}/{name}.docs"
        source = pa.memory_map(file) if local else store.open_input_file(file)
        return Shard(ids, offsets, pa.ipc.open_file(source).read_all().column(0))


@dataclass
class TokenFiles:
    """Token files that stand in a folder."""

    path: str
    manifest: DataFrame

    @staticmethod
    def open(spark: SparkSession, path: str) -> TokenFiles:
        return TokenFiles(path, spark.read.parquet(f"{path}/manifest"))

    def documents(self, with_ids: bool = False) -> DataFrame:
        """A row per document, read from the files: ``id``, ``start`` (ids of all documents before),
        ``n_tokens`` (with the end id) and ``ids_crc32`` of the ids as little-endian unsigned 32-bit
        integers; with ``ids``, a list of long, on demand. A task reads whole shards, piece by piece."""
        path = self.path
        found = self.manifest.agg(F.count("*"), F.first("id_type")).first()
        names = ["id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    shard = Shard.open(path, row["name"], row["n_docs"], row["n_tokens"], row["width"])
                    # Lists of ids can be long, so such batches hold fewer documents.
                    step = 256 if with_ids else _ROWS
                    for first in range(0, row["n_docs"], step):
                        bounds = shard.offsets[first : first + step + 1].astype(np.int64)
                        low = int(bounds[0])
                        ids = shard.ids[low : int(bounds[-1])].astype("<u4")
                        data, cuts = memoryview(ids.tobytes()), ((bounds - low) * 4).tolist()
                        checks = [zlib.crc32(data[a:b]) for a, b in zip(cuts, cuts[1:])]
                        columns = [
                            shard.docs.slice(first, len(checks)).combine_chunks(),
                            pa.array(bounds[:-1] + row["base"]),
                            pa.array(np.diff(bounds)),
                            pa.array(checks, pa.int64()),
                        ]
                        if with_ids:
                            columns.append(pa.LargeListArray.from_arrays(bounds - low, ids.astype(np.int64)).cast(pa.list_(pa.int64())))
                        yield pa.RecordBatch.from_arrays(columns, names)

        shards = self.manifest.select("shard", "name", "n_docs", "n_tokens", "width", "base")
        schema = f"id {found[1] or 'long'}, start long, n_tokens long, ids_crc32 long"
        return shards.repartitionByRange(max(1, found[0]), "shard").mapInArrow(
            read, schema + (", ids array<bigint>" if with_ids else "")
        )

    def tokens(self, start: int, length: int) -> np.ndarray:
        """The ids from ``start`` on in the long sequence, on the calling machine: only the shards that hold
        them are opened, and only the pages that hold them read."""
        wanted = self.manifest.where(
            (F.col("base") < start + length) & (F.col("base") + F.col("n_tokens") > start)
        )
        parts = []
        for row in wanted.orderBy("shard").collect():
            shard = Shard.open(self.path, row["name"], row["n_docs"], row["n_tokens"], row["width"])
            parts.append(shard.ids[max(0, start - row["base"]) : max(0, start + length - row["base"])])
        return np.concatenate(parts).astype(np.uint32) if parts else np.zeros(0, np.uint32)
