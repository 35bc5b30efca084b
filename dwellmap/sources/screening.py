"""Files that cannot be read are found before a job meets them.

Deliveries come as many files, of which some are empty, cut off in transfer or not what their name says. One
such file ends a scan, or worse, a cut text file is read up to where it ends. The screen looks at every file
on the executors: at its length, at the marks a format begins and ends with, and through the whole of a
compressed text, whose end only shows that way. Nothing is read into the driver.
"""

from __future__ import annotations

import fnmatch
import struct
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What files of these formats begin with.
_GZIP_MARK = b"\x1f\x8b"
_PARQUET_MARK = b"PAR1"
_CHUNK = 1 << 20

SOUND, EMPTY, CUT, FOREIGN = "sound", "empty", "cut", "foreign"


def _parquet(source: pa.NativeFile, length: int) -> str:
    if source.read(4) != _PARQUET_MARK:
        return FOREIGN
    if length < 12:
        return CUT
    source.seek(length - 8)
    footer, mark = struct.unpack("<I4s", source.read(8))
    return SOUND if mark == _PARQUET_MARK and footer + 12 <= length else CUT


def _gzip(source: pa.NativeFile, length: int) -> str:
    """A gzip file is one or more members; each ends with a checksum that is checked on the way."""
    if source.read(2) != _GZIP_MARK:
        return FOREIGN
    source.seek(0)
    stream, data = zlib.decompressobj(31), b""
    try:
        while True:
            data = data or source.read(_CHUNK)
            if not data:
                return SOUND if stream.eof else CUT
            if stream.eof:
                stream = zlib.decompressobj(31)
            # Bounded output, so that a small file of long runs doesn't fill the memory.
            stream.decompress(data, _CHUNK)
            while stream.unconsumed_tail:
                stream.decompress(stream.unconsumed_tail, _CHUNK)
            data = stream.unused_data
    except zlib.error:
        return CUT


_KINDS: dict[str, Callable[[pa.NativeFile, int], str]] = {".parquet": _parquet, ".gz": _gzip}


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """A row per file below ``path`` whose name matches ``pattern``: ``path`` and ``length``.

    The folders directly below are listed by tasks, everything in them included. Files and folders whose
    names begin with an underscore or a dot are left out, as Spark does; empty files are not.
    """
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path.replace("file:/", "file:///", 1)
    store, root = FileSystem.from_uri(path)
    scheme = path[: len(path) - len(root)] if path.endswith(root) else path.partition("://")[0] + "://"

    def hidden(name: str) -> bool:
        return name.startswith(("_", "."))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there, _ = FileSystem.from_uri(path)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                info = there.get_file_info(folder)
                deeper = there.get_file_info(FileSelector(folder, recursive=True)) if info.type == FileType.Directory else [info]
                found = [
                    f for f in deeper
                    if f.type == FileType.File and fnmatch.fnmatch(f.base_name, pattern)
                    and not any(map(hidden, f.path[len(root) :].strip("/").split("/")))
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([scheme + f.path for f in found], pa.string()), pa.array([f.size for f in found], pa.int64())],
                    ["path", "length"],
                )

    top = [(f.path,) for f in store.get_file_info(FileSelector(root)) if not hidden(f.base_name)]
    folders = spark.createDataFrame(top, "folder string").repartition(max(1, min(len(top), 1000)))
    return folders.mapInArrow(walk, "path string, length long")


def screen_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """The files of ``list_files`` with a ``verdict`` each.

    ``empty`` files have no byte, ``foreign`` ones don't begin as their ending says, ``cut`` ones end too
    early; the rest is ``sound``. Files ending in ``.parquet`` and ``.gz`` are looked into; others are sound
    if not empty. The store must be one that pyarrow reaches as well.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verdicts = []
            for name, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                kind = next((k for end, k in _KINDS.items() if name.endswith(end)), None)
                if not length or not kind:
                    verdicts.append(SOUND if length else EMPTY)
                    continue
                store, inner = FileSystem.from_uri(name)
                with store.open_input_file(inner) as source:
                    verdicts.append(kind(source, length))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(verdicts, pa.string())],
                ["path", "length", "verdict"],
            )

    listed = list_files(spark, path, pattern).repartition("path")
    return listed.mapInArrow(look, "path string, length long, verdict string")


def sound_paths(screened: DataFrame) -> list[str]:
    """Paths of the files that can be read, in order: as many names as Spark lists to plan a scan of them."""
    return [r["path"] for r in screened.where(F.col("verdict") == SOUND).orderBy("path").select("path").collect()]
