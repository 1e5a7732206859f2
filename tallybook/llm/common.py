"""What several corpus operators share: byte files in shared folders, text helpers, batches of Arrow rows."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space that separates words, and the letters lower-cased, as the contracts state them.
BLANKS = b" \t\n\x0b\x0c\r"
LOWER = bytes(byte + 32 if 0x41 <= byte <= 0x5A else byte for byte in range(256))

Batches = Iterator[pa.RecordBatch]

# Text that a task works on at once.
BATCH_BYTES = 8 << 20


def give_back() -> None:
    """Return freed memory to the system, where the allocators can: a Python worker waits for its next task beside an
    executor that may need it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def released(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """A function over the batches of a task that gives its memory back when the task ends."""

    def wrapped(batches: Batches) -> Batches:
        yield from run(batches)
        give_back()

    return wrapped


def released_group(run: Callable[[pa.Table], pa.Table], least_bytes: int = 4 << 20) -> Callable[[pa.Table], pa.Table]:
    """The same for a function over groups, after large ones."""

    def wrapped(table: pa.Table) -> pa.Table:
        size = table.nbytes
        found = run(table)
        if size >= least_bytes:
            give_back()
        return found

    return wrapped


def with_columns(df: DataFrame, **defaults: str) -> DataFrame:
    """Only the named columns, cast to the given types; a column that is missing is null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{name}`") if name in present else F.lit(None)).cast(kind).alias(name)
            for name, kind in defaults.items()
        ]
    )


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id has the remainder of the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit(modulus))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8 bytes, null as empty, without a copy to Python strings."""
    column = batch.column(name)
    if not pa.types.is_binary(column.type):
        column = column.cast(pa.binary()) if pa.types.is_string(column.type) else column.cast(pa.large_binary())
    return [value or b"" for value in column.to_pylist()]


def slices(batches: Batches, most_bytes: int, name: str = "text") -> Batches:
    """The batches cut so that none holds much more than ``most_bytes`` in a column, unless one value does."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        first = 0
        while first < len(ends):
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
            yield batch.slice(first, last - first)
            first = last


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it of a folder given as a path or a URI (``file:/x`` included)."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


# Keys of rows to drop are broadcast up to this number, at most 32 MB; more are joined by shuffle, with equal results.
BROADCAST_KEYS = 2_000_000


def text_key() -> Column:
    """With doc_id the key of a row in a list of rows to drop, as ids may repeat."""
    return F.xxhash64(F.col("text").cast("string"))


def without_rows(documents: DataFrame, dropped: DataFrame) -> DataFrame:
    """The documents whose (doc_id, text_key) are not in ``dropped``, with all their columns.

    Rows without doc_id are never dropped: nothing names them.
    """
    keys = dropped.select(F.col("doc_id").alias("_dropped_id"), F.col("text_key").alias("_dropped_key"))
    keys = keys.where("_dropped_id is not null").distinct()
    if keys.count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    same = (documents["doc_id"] == F.col("_dropped_id")) & (text_key() == F.col("_dropped_key"))
    return documents.join(keys, same, "left_anti")
