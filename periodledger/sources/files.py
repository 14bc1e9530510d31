"""Many small files of a folder, found and read by tasks.

Spark's own file reader lists every folder of a pattern on the driver, one call after another, keeps an entry for each file there
and gives a task few files only, which takes minutes for a million files. Here one task lists the level of the first wildcard, the
rest is looked up and opened by all tasks, and only names are shuffled. That takes a folder which tasks can open as a local one
(also a shared mount); for others the caller keeps Spark's reader.
"""

from __future__ import annotations

import errno
import fnmatch
import os
import re
import stat
import zlib
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20
# What Java quotes in the path of a URI.
QUOTED = re.compile("[\\x00- \"#%<>?\\[\\\\\\]^`{|}\\x7f-\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")


def local_folder(spark: SparkSession, folder: str, *patterns: str) -> str | None:
    """The path of a ``file:`` folder; None for one of another file system, or if a pattern has more than the wildcards ``*`` and ``?``."""
    found = re.fullmatch(r"(file:(?://(?=/))?)?(/[^*?\[\]{}\\]*)", folder)
    if not found or any(re.search(r"[\[\]{}\\]|(^|/)\.\.(/|$)", pattern) for pattern in patterns):
        return None
    if not found[1] and not spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:"):
        return None
    return re.sub("/+", "/", found[2]).rstrip("/")


def _matcher() -> tuple[Callable, Callable]:
    """``matches(folder, names)`` gives the paths below a folder that fit the names of each level, ``stat_of(path)`` what is there.
    What cannot be listed or looked up raises, so that no file is lost unseen. Both are local functions, which travel with a task."""
    gone = (errno.ENOENT, errno.ENOTDIR, errno.ELOOP)

    def tried(call: Callable, path: str):
        try:
            return call(path)
        except OSError as x:
            if x.errno in gone:
                return None
            raise

    def stat_of(path: str) -> os.stat_result | None:
        return tried(os.stat, path)

    def matches(folder: str, names: list[str]) -> Iterator[str]:
        if not names:
            yield folder
            return
        name, *rest = names
        if "*" in name or "?" in name:
            held = fnmatch.filter(tried(os.listdir, folder) or [], name)
        else:
            held = [name] if rest or stat_of(f"{folder}/{name}") else []
        for x in held:
            yield from matches(f"{folder}/{x}", rest)

    return matches, stat_of


def _names(pattern: str) -> list[str]:
    return [x for x in pattern.split("/") if x not in ("", ".")]


def any_match(folder: str, pattern: str) -> bool:
    return next(_matcher()[0](folder, _names(pattern)), None) is not None


def _map_rows(df: DataFrame, rows_of: Callable[[Iterator[tuple]], Iterable[tuple]], **columns: str) -> DataFrame:
    """``rows_of`` over the rows of a task as plain tuples, ``columns`` (string or binary) are the new ones; batches are bounded in bytes.
    It must be a local function: those travel with the task, which then needs no module of this package."""
    ddl = ", ".join(f"{name} {kind}" for name, kind in columns.items())
    types = [{"string": pa.string(), "binary": pa.binary()}[kind] for kind in columns.values()]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], [*columns])
        held, size = [], 0
        for row in rows_of(row for given in batches for row in zip(*(c.to_pylist() for c in given.columns))):
            held.append(row)
            size += sum(len(x) for x in row if x is not None)
            if len(held) == BATCH_ROWS or size >= BATCH_BYTES:
                yield batch()
                held, size = [], 0
        if held:
            yield batch()

    return df.mapInArrow(work, ddl)


def find_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """The files of a local folder that match: ``path`` and ``uri``, as Spark's ``_metadata.file_path`` writes it. As Spark's reader
    does, it leaves out hidden and empty files and unfinished copies, and takes the files of a folder that matches, not its subfolders."""
    names, (matches, stat_of) = _names(pattern), _matcher()
    wild = next((i for i, x in enumerate(names, 1) if "*" in x or "?" in x), len(names))

    def taken(path: str) -> bool:
        name, here = os.path.basename(path), stat_of(path)
        hidden = name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")
        return here is not None and not hidden and stat.S_ISREG(here.st_mode) and here.st_size > 0

    def files(rows: Iterator[tuple]) -> Iterator[tuple]:
        for (place,) in rows:
            for at in matches(place, names[wild:]):
                here = stat_of(at)
                inner = [f"{at}/{x}" for x in os.listdir(at)] if here and stat.S_ISDIR(here.st_mode) else [at]
                yield from ((x, "file:" + QUOTED.sub(lambda c: quote(c[0]), x)) for x in inner if taken(x))

    tasks = 4 * spark.sparkContext.defaultParallelism
    places = _map_rows(spark.range(0, 1, 1, 1), lambda _: ((x,) for x in matches(folder, names[:wild])), place="string")
    return _map_rows(places.repartition(tasks, "place"), files, path="string", uri="string")


def read_paired(left: DataFrame, right: DataFrame, key: str, names: tuple[str, str]) -> DataFrame:
    """``key`` and the contents of the files of both sides, named by ``names``; each side has ``key`` and ``path``. Names are joined
    before any file is opened, so contents are never shuffled. A key on one side only stays; several files of a key are all paired."""
    tasks = 4 * left.sparkSession.sparkContext.defaultParallelism
    one, other = (side.select(key, F.col("path").alias(name)).repartition(tasks, key) for side, name in zip((left, right), names))

    def content(path: str | None) -> bytes | None:
        if path is None:
            return None
        with open(path, "rb") as file:
            held = file.read()
        at, name = os.path.split(path)
        try:
            with open(f"{at}/.{name}.crc", "rb") as file:  # the checksums that Hadoop's writer leaves beside a file, and its reader checks
                known = file.read()
        except FileNotFoundError:
            return held
        step = int.from_bytes(known[4:8], "big")
        if known[:4] == b"crc\0" and step and known[8:] != b"".join(zlib.crc32(held[i:i + step]).to_bytes(4, "big") for i in range(0, len(held), step)):
            raise OSError(f"checksum error: {path}")
        return held

    def read(rows: Iterator[tuple]) -> Iterator[tuple]:
        return ((k, content(a), content(b)) for k, a, b in rows)

    return _map_rows(one.join(other, key, "full").select(key, *names), read, **{key: "string", names[0]: "binary", names[1]: "binary"})
