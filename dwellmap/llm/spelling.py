"""Spelling variants: words that differ by one inserted, deleted or replaced character.

The vocabulary's words are put into two tries, one of the words and one of the reversed words, whose nodes are
numbered. A pair of numbers (node of a prefix, node of a suffix) then stands for a word with a gap. A word
gives such a pair for every character it skips, and for every place between two characters where one could
be inserted. Two words of equal length are near if they share a pair of skipped places; a longer and a shorter
one if a skipped place of the first is an inserted place of the second. Equal numbers are equal strings, so
every meeting is a neighbour and none is missed.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellmap.session import discard, materialise, prepare

#: Bytes of Latin-1 that are letters (A-Z, a-z, U+00C0 to U+00FF), with A-Z in lower case; others are spaces.
_LETTERS = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256)
)
#: Distinct words a task counts before it passes the counts on.
_COUNTED = 200_000
_NODES = "part int, no long, word string, own long, nodes array<bigint>"


def letter_runs(text: str | None) -> list[bytes]:
    """Maximal runs of letters in Latin-1, A-Z lower-cased. All other characters separate."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split() if text else []


def misspelt(doc_id: object, run: bytes) -> bytes:
    """The run without one of its characters for one pair of document and run in 97, by a CRC-32 of both."""
    name = "" if doc_id is None else str(doc_id)
    h = zlib.crc32(run.decode("latin-1").encode(), zlib.crc32(f"{name}:".encode()))
    return run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]


def word_counts(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    min_length: int = 5,
    min_count: int = 3,
    rewrite: Callable[[object, bytes], bytes] | None = None,
) -> DataFrame:
    """Words of at least ``min_length`` characters that stand at least ``min_count`` times in all whole texts:
    ``word`` and ``n``. ``rewrite`` may change a run, given its document's id."""
    prepare(docs.sparkSession)

    def flush(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([w.decode("latin-1") for w in counts], pa.string()),
                pa.array(list(counts.values()), pa.int64()),
            ],
            ["word", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for word, n in Counter(letter_runs(text.as_py())).items():
                    if rewrite:
                        word = rewrite(doc_id, word)
                    if len(word) >= min_length:
                        counts[word] += n
                if len(counts) > _COUNTED:
                    yield flush(counts)
                    counts.clear()
        if counts:
            yield flush(counts)

    found = docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, "word string, n long"
    )
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the nodes of the trie of a partition's sorted words, from 0 in the order of first use. The
    nodes of the first word get 0 to its length."""
    part = TaskContext.get().partitionId()
    before, path, used, own = None, [0], 1, 0
    for batch in batches:
        words = batch.column(1).to_pylist()
        flat: list[int] = []
        ends = [0]
        for word in words:
            shared, most = 0, min(len(word), len(before or ""))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del path[shared + 1 :]
            path.extend(range(used, used + len(word) - shared))
            used += len(word) - shared
            flat.extend(path)
            ends.append(len(flat))
            before = word
        n = len(words)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, part, np.int32)),
                batch.column(0),
                batch.column(1),
                pa.array(np.arange(own, own + n)),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64())),
            ],
            ["part", "no", "word", "own", "nodes"],
        )
        own += n


def trie_nodes(words: DataFrame, partitions: int) -> DataFrame:
    """Number the nodes of the trie of all ``word`` (distinct, with a number ``no`` that is passed on).

    Adds ``rank``, the word's place in code-point order from 0, and ``nodes``, the numbers of its prefixes of
    0, 1, ... characters; equal prefixes have one number, different ones two.

    Words are sorted into ranges, and every range numbers its own trie. Two neighbouring ranges share the
    nodes of what the last word of one and the first of the next have in common; a row per range, with these
    words, tells which numbers are meant, and how many nodes stand before.
    """
    spark = words.sparkSession
    local = materialise(
        words.select("no", "word")
        .repartitionByRange(partitions, "word")
        .sortWithinPartitions("word")
        .mapInArrow(_numbered, _NODES)
    )
    ranges = (
        local.groupBy("part")
        .agg(
            F.count("*").alias("n"),
            F.max(F.array_max("nodes")).alias("top"),
            F.min("word").alias("first"),
            F.max(F.struct("word", "nodes")).alias("last"),
        )
        .orderBy("part")
        .collect()
    )
    moves, rank, total, before, path = [], 0, 0, None, []
    for row in ranges:
        shared = 0
        if before is not None:  # the root, and what both words begin with
            shared = 1
            while shared <= min(len(before), len(row["first"])) and before[shared - 1] == row["first"][shared - 1]:
                shared += 1
        known = path[:shared]
        moves.append((row["part"], known, total - shared, rank))
        before, rank = row["last"]["word"], rank + row["n"]
        path = [known[v] if v < shared else v + total - shared for v in row["last"]["nodes"]]
        total += row["top"] + 1 - shared
    table = spark.createDataFrame(moves, "part int, known array<bigint>, move long, before long")
    moved = F.transform(
        "nodes",
        lambda v: F.when(v < F.size("known"), F.get("known", v.cast("int"))).otherwise(v + F.col("move")),
    )
    return local.join(table, "part").select(
        "no", "word", (F.col("before") + F.col("own")).alias("rank"), moved.alias("nodes")
    )


def _gaps() -> Column:
    """All pairs (prefix node, suffix node) of a word: those of skipped characters and those of inserted ones.

    ``once`` marks, of several characters in a row that are equal, the first: skipping any of them leaves the
    same word, so only one may meet that word.
    """
    length = F.char_length("word")
    places = F.sequence(F.lit(0), length)

    def skipped(i: Column) -> Column:
        here = F.substring(F.col("word"), i + 1, F.lit(1))
        previous = F.substring(F.col("word"), i, F.lit(1))
        return F.struct(
            F.get("nodes", i).alias("f"),
            F.get("back", length - 1 - i).alias("r"),
            F.lit(True).alias("skip"),
            ((i == 0) | (here != previous)).alias("once"),
        )

    def inserted(i: Column) -> Column:
        return F.struct(
            F.get("nodes", i).alias("f"),
            F.get("back", length - i).alias("r"),
            F.lit(False).alias("skip"),
            F.lit(False).alias("once"),
        )

    return F.concat(
        F.transform(F.slice(places, F.lit(1), length), skipped),
        F.transform(places, inserted),
    )


def _meetings(gaps: DataFrame) -> DataFrame:
    """Per word and pair at which it meets others: how many, and the most frequent of them.

    A pair has one inserting word at most, and as many skipping ones as there are letters, so its list is
    short whatever the vocabulary. Neighbours are counted and compared, not listed.
    """
    member = F.struct((-F.col("n")).alias("less"), "no", "skip", "once")
    lists = gaps.groupBy("f", "r").agg(F.collect_list(member).alias("all")).where(F.size("all") > 1)
    split = lists.select(
        "all",
        F.array_sort(F.filter("all", lambda x: x["skip"])).alias("skips"),
        F.get(F.filter("all", lambda x: ~x["skip"]), F.lit(0)).alias("short"),
        F.get(F.array_sort(F.filter("all", lambda x: x["once"])), F.lit(0)).alias("longer"),
        F.size(F.filter("all", lambda x: x["once"])).alias("n_longer"),
    )

    def key(x: Column) -> Column:
        return F.when(x["no"].isNotNull(), F.struct(x["less"].alias("less"), x["no"].alias("no")))

    def met(x: Column) -> Column:
        first = F.get("skips", F.lit(0))
        other = F.when(first["no"] != x["no"], key(first)).otherwise(key(F.get("skips", F.lit(1))))
        shorter = F.when(x["once"], key(F.col("short")))
        return F.struct(
            x["no"].alias("no"),
            F.when(x["skip"], F.size("skips") - 1 + F.when(shorter.isNotNull(), 1).otherwise(0))
            .otherwise(F.col("n_longer"))
            .alias("n_near"),
            F.when(x["skip"], F.least(other, shorter)).otherwise(key(F.col("longer"))).alias("best"),
        )

    return split.select(F.inline(F.transform("all", met))).where("n_near > 0")


def _roots(forms: DataFrame) -> DataFrame:
    """Follow ``no`` to ``to`` until a word has no form: every round replaces an aim by the aim's aim. A form
    is at least twice as frequent, so paths are no longer than the logarithm of the largest count."""
    aims = materialise(forms.select("no", "to"))
    while True:
        further = aims.select(F.col("no").alias("at"), F.col("to").alias("beyond"))
        step = materialise(
            aims.join(further, F.col("to") == F.col("at"), "left").select(
                "no", F.coalesce("beyond", "to").alias("to"), F.col("beyond").isNotNull().alias("moved")
            )
        )
        discard(aims)
        if step.where("moved").isEmpty():
            return step.select("no", "to")
        aims = step.select("no", "to")


def variant_groups(counts: DataFrame) -> DataFrame:
    """Per word of ``counts`` (``word``, distinct and not null, and ``n``): its near words and its form.

    Two words are near if they differ by exactly one inserted, deleted or replaced character. Returns ``word``,
    ``n``, ``n_near`` (number of near words), ``form`` (the near word of largest n, of several the first in
    code-point order, if that n is at least twice the word's own; else null), ``form_n`` and ``root`` (where
    forms lead in the end; the word itself if it has none).

    The work is a row per character of the vocabulary, and one per place between two.
    """
    spark = prepare(counts.sparkSession)
    counts = materialise(counts.select("word", "n"))
    # A range holds a few thousand words at least, and a task's share of a large vocabulary.
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(1, min(width, counts.count() // 4096))
    forward = trie_nodes(counts.select(F.lit(0).cast("long").alias("no"), "word"), partitions)
    words = materialise(
        forward.join(counts, "word").select(F.col("rank").alias("no"), "word", "n", "nodes")
    )
    discard(counts)
    backward = trie_nodes(words.select("no", F.reverse("word").alias("word")), partitions)
    paired = words.join(backward.select("no", F.col("nodes").alias("back")), "no")
    gaps = paired.select("no", "n", F.inline(_gaps()))
    near = materialise(
        _meetings(gaps).groupBy("no").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    )
    judged = words.select("no", "word", "n").join(near, "no", "left")
    has_form = -F.col("best.less") >= 2 * F.col("n")
    judged = materialise(
        judged.select(
            "no",
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(has_form, F.col("best.no")).alias("to"),
            F.when(has_form, -F.col("best.less")).alias("form_n"),
        )
    )
    discard(near)
    roots = _roots(judged.where("to IS NOT NULL"))
    named = words.select("no", "word")
    form = named.select(F.col("no").alias("to"), F.col("word").alias("form"))
    root = roots.join(named.withColumnRenamed("no", "to"), "to").select("no", F.col("word").alias("root"))
    return (
        judged.join(form, "to", "left")
        .join(root, "no", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    )
