"""Files on whatever file system the session reaches: listings, small texts, and checks that stream."""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

#: Files a task reads one after the other when files are checked.
FILES_PER_TASK = 8
PIECE = 1 << 20


@dataclass(frozen=True)
class Listed:
    path: str
    n_bytes: int


def _fs(path: str) -> tuple[object, object]:
    context = SparkSession.active().sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(context._jsc.hadoopConfiguration()), where


def _name(where: object) -> str:
    """The path as it was given: local files without their scheme."""
    uri = where.toUri()
    return uri.getPath() if uri.getScheme() in (None, "file") else where.toString()


def exists(path: str) -> bool:
    fs, where = _fs(path)
    return fs.exists(where)


def children(path: str) -> list[tuple[str, bool]]:
    """(name, whether it is a folder) of what lies directly in a folder, in order; nothing if there is no such folder."""
    fs, where = _fs(path)
    return sorted((s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(where)) if fs.exists(where) else []


def walk(path: str, suffix: str = "") -> list[Listed]:
    """All files below a folder whose names end in ``suffix``, in order; nothing if there is no such folder."""
    fs, where = _fs(path)
    out, found = [], fs.listFiles(where, True) if fs.exists(where) else None
    while found is not None and found.hasNext():
        s = found.next()
        if s.getPath().getName().endswith(suffix):
            out.append(Listed(_name(s.getPath()), s.getLen()))
    return sorted(out, key=lambda f: f.path)


def delete(path: str) -> None:
    fs, where = _fs(path)
    fs.delete(where, True)


def read_text(path: str) -> str | None:
    """The text of a small file; None if there is none."""
    fs, where = _fs(path)
    if not fs.exists(where):
        return None
    if fs.getUri().getScheme() == "file":  # without Hadoop's checksums, so that the file may be edited
        with open(where.toUri().getPath(), encoding="utf-8") as f:
            return f.read()
    stream = fs.open(where)
    try:
        return SparkSession.active().sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(path: str, text: str) -> None:
    """Write a small file under another name first, so that a reader sees the old file or the new one."""
    fs, where = _fs(path)
    if fs.getUri().getScheme() == "file":
        local = where.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(f"{local}.tmp-{os.getpid()}", "w", encoding="utf-8") as f:
            f.write(text)
        os.replace(f"{local}.tmp-{os.getpid()}", local)
        return
    _, other = _fs(f"{path}.tmp-{os.getpid()}")
    stream = fs.create(other, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    fs.delete(where, False)
    if not fs.rename(other, where):
        raise OSError(f"cannot rename to {path}")


def open_stream(path: str) -> object:
    """A file as a stream of bytes, on the machine that runs this."""
    from pyarrow import fs

    system, where = (fs.LocalFileSystem(), path.removeprefix("file://")) if "://" not in path or path.startswith("file:") else fs.FileSystem.from_uri(path)
    return system.open_input_stream(where, compression=None)


def checked(spark: SparkSession, paths: list[str], check: Callable[[str], tuple], columns: str) -> DataFrame:
    """A row ``path`` and ``columns`` for each file, from a function that reads it on an executor."""
    names = ["path", *(c.split()[0] for c in columns.split(", "))]

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                yield pd.DataFrame([(path, *check(path))], columns=names)

    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    return listed.repartition(max(1, -(-len(paths) // FILES_PER_TASK))).mapInPandas(run, f"path string, {columns}")


def gunzipped(path: str) -> tuple[bool, int]:
    """(whether a compressed file can be read to its end, its bytes up to there), in pieces of 1 MiB."""
    size = 0
    try:
        with open_stream(path) as f:
            unzip = zlib.decompressobj(31)
            while piece := f.read(PIECE):
                while piece:
                    size += len(unzip.decompress(piece))
                    piece = unzip.unused_data
                    if unzip.eof and piece:  # several members behind each other
                        unzip = zlib.decompressobj(31)
            return unzip.eof, size
    except (OSError, zlib.error):
        return False, size


def hashed(path: str) -> tuple[int, str]:
    """(bytes, first 16 digits of the SHA-256) of a file, in pieces of 1 MiB."""
    h, size = hashlib.sha256(), 0
    with open_stream(path) as f:
        while piece := f.read(PIECE):
            h.update(piece)
            size += len(piece)
    return size, h.hexdigest()[:16]


def footer(path: str) -> tuple[bool, int]:
    """(whether a Parquet file's footer can be read, its rows)."""
    import pyarrow as pa
    from pyarrow import fs, parquet

    try:
        system, where = (fs.LocalFileSystem(), path.removeprefix("file://")) if "://" not in path or path.startswith("file:") else fs.FileSystem.from_uri(path)
        with system.open_input_file(where) as f:
            return True, parquet.ParquetFile(f).metadata.num_rows
    except (OSError, pa.ArrowInvalid):
        return False, 0
