"""Token ids in binary files, stored as compressed byte or bit planes.

A file holds the ids of a range of documents, in ascending order of doc_id. Ids are cut into blocks of ``block`` ids.
Each block is transposed: plane i has byte i (or bit i) of all its ids, so that the planes of high bytes are nearly
constant. Each plane is one zstandard frame. Layout:

    magic | planes of block 0 | planes of block 1 | ... | document table | chunk index | trailer | magic

The document table (one zstandard frame) has for each document a null flag byte, the id and the number of tokens. The
chunk index has for each block its position, its number of ids and the length of each plane; a reader that wants the
ids from n to m reads only the blocks that hold them. The trailer has the lengths and settings needed to read both.

Tasks write under names of their own and report what they wrote; the reports are stored in the shared folder, and only
files named there belong to the data set. So a task that runs twice leaves a file that no reader opens.

Defined results: a null or empty text is the end id alone. A null doc_id sorts first. Repeated ids are all written, in
the order of their texts' checksums. An empty table gives an empty result.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.common import BATCH_BYTES, Batches, open_folder, slices, with_columns
from tallybook.llm.tokens import encoder
from tallybook.operators.sinks import settle
from tallybook.session import shared_folder

MAGIC = b"IDPLANE1"
TRAILER = struct.Struct("<4Q2I")  # place and length of the document table and of the index; block size, unit
END_ID = 2
BLOCK = 65_536
FILE_BYTES = 16 << 20
LEVEL = 3
UNITS = {"byte": 8, "bit": 1}

MANIFEST = "part int, path string, documents long, tokens long, bytes long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def planes(ids: np.ndarray, unit: str) -> list[bytes]:
    """The planes of a block of unsigned 32-bit ids, from the lowest byte or bit on."""
    if unit == "byte":
        table = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
        return [column.tobytes() for column in table.T]
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return [row.tobytes() for row in np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")]


def from_planes(parts: list[bytes], count: int, unit: str) -> np.ndarray:
    """Inverse of ``planes``."""
    if unit == "byte":
        table = np.empty((count, 4), np.uint8)
        for at, part in enumerate(parts):
            table[:, at] = np.frombuffer(part, np.uint8)
        return table.reshape(-1).view("<u4")
    rows = np.stack([np.frombuffer(part, np.uint8) for part in parts])
    bits = np.unpackbits(rows, axis=1, count=count, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").reshape(-1).view("<u4")


class PlaneWriter:
    """Writes one file; memory holds one block and the document table."""

    def __init__(self, stream, unit: str = "byte", block: int = BLOCK, level: int = LEVEL):
        self.stream, self.unit, self.block = stream, unit, block
        self.packer = zstandard.ZstdCompressor(level=level)
        self.waiting, self.held = [], 0
        self.doc_ids, self.counts, self.index = [], [], []
        self.at = stream.write(MAGIC) or len(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids))
        self.waiting.append(ids)
        self.held += len(ids)
        while self.held >= self.block:
            self._write_block(self.block)

    def _write_block(self, count: int) -> None:
        whole = np.concatenate(self.waiting) if len(self.waiting) > 1 else self.waiting[0]
        self.waiting, self.held = [whole[count:]], len(whole) - count
        parts = [self.packer.compress(part) for part in planes(whole[:count], self.unit)]
        self.index.append((self.at, count, *map(len, parts)))
        self._put(b"".join(parts))

    def _put(self, data: bytes) -> int:
        at = self.at
        self.stream.write(data)
        self.at += len(data)
        return at

    def close(self) -> int:
        """Write what is left; returns the length of the file."""
        if self.held:
            self._write_block(self.held)
        nulls = np.array([doc_id is None for doc_id in self.doc_ids], np.uint8)
        table = nulls.tobytes() + np.array([doc_id or 0 for doc_id in self.doc_ids], "<i8").tobytes()
        table = self.packer.compress(table + np.array(self.counts, "<i8").tobytes())
        index = self.packer.compress(np.array(self.index, "<u8").tobytes())
        spots = (self._put(table), len(table), self._put(index), len(index))
        self._put(TRAILER.pack(*spots, self.block, UNITS[self.unit]) + MAGIC)
        return self.at


class PlaneReader:
    """Reads a file written by ``PlaneWriter`` from a seekable stream."""

    def __init__(self, stream, size: int):
        self.stream = stream
        tail = TRAILER.size + len(MAGIC)
        end = self._get(size - tail, tail)
        if self._get(0, len(MAGIC)) != MAGIC or end[-len(MAGIC) :] != MAGIC:
            raise ValueError("not a file of token planes")
        table_at, table_size, index_at, index_size, self.block, unit = TRAILER.unpack(end[: TRAILER.size])
        self.unit = "byte" if unit == UNITS["byte"] else "bit"
        self.opener = zstandard.ZstdDecompressor()
        table = self.opener.decompress(self._get(table_at, table_size))
        number = len(table) // 17
        nulls = np.frombuffer(table, np.uint8, number).astype(bool)
        self.doc_ids = np.ma.array(np.frombuffer(table, "<i8", number, number), mask=nulls).tolist()
        self.counts = np.frombuffer(table, "<i8", number, 9 * number)
        width = 2 + 4 * 8 // unit
        self.index = np.frombuffer(self.opener.decompress(self._get(index_at, index_size)), "<u8").reshape(-1, width)

    def _get(self, at: int, size: int) -> bytes:
        self.stream.seek(at)
        return self.stream.read(size)

    def read_block(self, number: int) -> np.ndarray:
        at, count, *sizes = (int(value) for value in self.index[number])
        data, parts, place = self._get(at, sum(sizes)), [], 0
        for size in sizes:
            parts.append(self.opener.decompress(data[place : place + size]))
            place += size
        return from_planes(parts, count, self.unit)

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """Every document with its ids, a block at a time."""
        held, number = np.empty(0, "<u4"), 0
        for doc_id, count in zip(self.doc_ids, self.counts.tolist()):
            if count > len(held):
                parts, have = [held], len(held)
                while have < count:
                    parts.append(self.read_block(number))
                    have += len(parts[-1])
                    number += 1
                held = np.concatenate(parts)
            yield doc_id, held[:count]
            held = held[count:]

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` to ``stop`` of the file, from the blocks that hold them."""
        first = start // self.block
        blocks = [self.read_block(n) for n in range(first, min(len(self.index), -(-stop // self.block)))]
        return np.concatenate(blocks or [np.empty(0, "<u4")])[start - first * self.block : stop - first * self.block]


def write_planes(
    documents: DataFrame,
    tokenizer: str,
    folder: str,
    end_id: int = END_ID,
    unit: str = "byte",
    block: int = BLOCK,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Encode all texts and write them below ``folder`` in ascending order of doc_id; returns the stored manifest.

    Ranges of doc_id are dealt so that a file gets about ``file_bytes`` of text if texts are spread evenly.
    """
    docs = with_columns(documents, doc_id="long", text="string")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // file_bytes))
    shares = [at / parts for at in range(1, parts)]
    bounds = np.unique(docs.approxQuantile("doc_id", shares, 0.1 / parts)) if shares else np.empty(0)

    def encode(batches: Batches) -> Iterator[pa.RecordBatch]:
        encoded = encoder(tokenizer)
        end = end_id.to_bytes(4, "little")
        for batch in slices(batches, BATCH_BYTES):
            ids = [encoded.encode(text or "") + end for text in batch.column("text").to_pylist()]
            if encoded.vocabulary <= 1 << 16:  # half the bytes to shuffle
                ids = [np.frombuffer(value, "<u4").astype("<u2").tobytes() for value in ids]
            doc_ids = batch.column("doc_id")
            part = np.searchsorted(bounds, doc_ids.fill_null(-(1 << 63)).to_numpy(), side="right")
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), doc_ids, pa.array(ids, pa.binary())], ["part", "doc_id", "ids"]
            )

    def write(batches: Batches) -> Iterator[pa.RecordBatch]:
        width = "<u2" if encoder(tokenizer).vocabulary <= 1 << 16 else "<u4"
        system, root = open_folder(folder)
        out = None
        for batch in batches:
            for part, doc_id, ids in zip(*(batch.column(name).to_pylist() for name in ("part", "doc_id", "ids"))):
                if out is None:
                    name = f"part-{part:06d}-{uuid.uuid4().hex}.planes"
                    system.create_dir(root, recursive=True)
                    stream = system.open_output_stream(f"{root}/{name}")
                    out = PlaneWriter(stream, unit, block)
                out.add(doc_id, np.frombuffer(ids, width).astype("<u4"))
        if out is not None:
            size = out.close()
            stream.close()
            row = [[part], [f"{folder}/{name}"], [len(out.counts)], [sum(out.counts)], [size]]
            kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            names = ["part", "path", "documents", "tokens", "bytes"]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names)

    ranged = docs.mapInArrow(encode, "part int, doc_id long, ids binary")
    ranged = ranged.repartitionById(len(bounds) + 1, F.col("part"))
    ranged = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.crc32("ids"))
    return settle(ranged.mapInArrow(write, MANIFEST), "manifest")


def read_planes(manifest: DataFrame) -> DataFrame:
    """Every document of the files named in a manifest, with its place in the whole sequence of ids.

    The running start sees one row per file.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    files = files.select("path", "bytes", "start")

    def read(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start in zip(*(batch.column(name).to_pylist() for name in ("path", "bytes", "start"))):
                system, place = open_folder(path)
                with system.open_input_file(place) as stream:
                    rows = []
                    for doc_id, ids in PlaneReader(stream, size).documents():
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
                        start += len(ids)
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    return files.repartition(max(1, manifest.count()), "path").mapInArrow(read, DOCUMENTS)


def round_trip(documents: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write all documents to a fresh shared folder and read them back."""
    folder = shared_folder(documents.sparkSession, "planes")
    return read_planes(write_planes(documents, tokenizer, folder, **options))
