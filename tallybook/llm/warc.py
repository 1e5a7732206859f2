"""WARC archives: monolithic gzip files, the normaliser that gives every record a member of its own, and readers.

``write_archives`` writes one gzip stream per file, the form in which such archives often arrive. ``normalise`` inflates
each of them once, front to back, rewrites every record as its own gzip member and writes a sidecar index of offsets.
On the way a record whose payload another record has already becomes a ``revisit`` that refers to it; only the list of
digests is compared and shuffled for that, never the payloads. ``read_records`` opens records through the index.

Files are written under names of their own by the tasks, and reported; the reports are stored in the shared folder and
name the files that count, so a task that runs twice does no harm. The sidecar index has a line of JSON per record.

Defined results: null html is an empty payload. Payloads under ``LEAST_BYTES`` bytes are always responses. Of equal
payloads the smallest page_id is the response; rows without page_id come last, and of rows that repeat an id the first
written. Repeated rows are records of their own. An empty table gives no files and an empty result.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import Batches, open_folder, texts_of, with_columns
from tallybook.operators.sinks import settle
from tallybook.session import shared_folder

LEAST_BYTES = 100
FILE_BYTES = 32 << 20
CHUNK = 1 << 20
GZIP = 31  # window bits of a gzip stream
DATE = "2024-01-01T00:00:00Z"
SALTS = 64
END = b"\r\n\r\n"

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + END

WRITTEN = "file string, record long, page_id long, digest string, payload_bytes long"
FILES = "warc string, sidecar string, records long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def record(kind: str, page_id: int | None, url: str, digest: str, size: int, block: bytes, refers: int | None = None) -> bytes:
    """A WARC record; ``size`` is that of the full payload, which a revisit does not hold."""
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Target-URI": url.replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Payload-Length": size,
    }
    if kind == "revisit":
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:page:{'' if refers is None else refers}>"}
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": len(block)}
    lines = [VERSION, *(f"{name}: {value}" for name, value in head.items())]
    return "\r\n".join(lines).encode() + END + block + END


def page_of(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def headers(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])


def inflated(stream) -> Iterator[bytes]:
    """The contents of a gzip file of one or more members, a chunk at a time."""
    opener = zlib.decompressobj(GZIP)
    while data := stream.read(CHUNK):
        while data:
            if opener.eof:
                opener = zlib.decompressobj(GZIP)
            yield opener.decompress(data, CHUNK)  # a megabyte may hold a gigabyte of zeros
            data = opener.unused_data if opener.eof else opener.unconsumed_tail


def records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an inflated archive."""
    held = bytearray()

    def fill(wanted: int) -> bool:
        while len(held) < wanted:
            chunk = next(chunks, None)
            if chunk is None:
                return False
            held.extend(chunk)
        return True

    while True:
        at, searched = -1, 0
        while at < 0:
            at = held.find(END, max(0, searched - 3))
            searched = len(held)
            if at < 0 and not fill(searched + 1):
                if held:
                    raise ValueError("the archive ends within a record")
                return
        head = headers(bytes(held[:at]))
        start, size = at + len(END), int(head["Content-Length"])
        if not fill(start + size + len(END)) or held[start + size : start + size + len(END)] != END:
            raise ValueError("the archive ends within a record")
        yield head, bytes(held[start : start + size])
        del held[: start + size + len(END)]


def payload_of(block: bytes) -> bytes:
    return block.split(END, 1)[1]


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """One response record per page, in monolithic gzip files of about ``file_bytes`` inflated; returns ``WRITTEN``."""

    def write(batches: Batches) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        stream = None
        for batch in batches:
            rows = []
            for page_id, url, html in zip(
                batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), texts_of(batch, "html")
            ):
                if stream is None:
                    name = f"{uuid.uuid4().hex}.mono.warc.gz"
                    system.create_dir(root, recursive=True)
                    stream = system.open_output_stream(f"{root}/{name}", compression=None)
                    packer, size, number = zlib.compressobj(1, zlib.DEFLATED, GZIP), 0, 0
                digest = hashlib.sha256(html).hexdigest()
                data = record("response", page_id, url or "", digest, len(html), HTTP + html)
                stream.write(packer.compress(data))
                rows.append((f"{folder}/{name}", number, page_id, digest, len(html)))
                size, number = size + len(data), number + 1
                if size >= file_bytes:
                    stream.write(packer.flush())
                    stream.close()
                    stream = None
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64())
            columns = list(zip(*rows)) or [()] * 5
            names = ["file", "record", "page_id", "digest", "payload_bytes"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
        if stream is not None:
            stream.write(packer.flush())
            stream.close()

    rows = with_columns(pages, page_id="long", url="string", html="string")
    return settle(rows.mapInArrow(write, WRITTEN), "written")


def repeats(written: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``WRITTEN`` rows with ``revisit``, and ``refers_to`` where an earlier page has the payload.

    Copies are merged per digest and salt, then per digest, and take the same way back; no group meets in one task.
    """
    place = F.struct(F.col("page_id").isNull().alias("without"), "page_id", "file", "record")
    salt = F.pmod(F.xxhash64("file", "record"), F.lit(SALTS)).cast("int")
    rows = written.withColumn("place", place).withColumn("salt", salt)
    large = rows.where(F.col("payload_bytes") >= least_bytes)
    salted = large.groupBy("digest", "salt").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("copies"))
    first = salted.groupBy("digest").agg(
        F.min("first").alias("first"), F.sum("copies").alias("copies"), F.collect_set("salt").alias("salts")
    )
    first = first.where("copies > 1").select("digest", "first", F.explode("salts").alias("salt"))
    found = large.join(first, ["digest", "salt"], "left")
    again = F.col("first").isNotNull() & (F.col("place") != F.col("first"))
    names = ["file", "record", "page_id", "digest", "payload_bytes"]
    found = found.select(*names, F.coalesce(again, F.lit(False)).alias("revisit"), F.when(again, F.col("first.page_id")).alias("refers_to"))
    small = rows.where(F.col("payload_bytes") < least_bytes)
    return found.unionByName(small.select(*names, F.lit(False).alias("revisit"), F.lit(None).cast("long").alias("refers_to")))


def normalise(marked: DataFrame, folder: str) -> DataFrame:
    """Rewrite each monolithic file record by record; returns the stored list of archives and sidecar indexes."""

    def rewrite(table: pa.Table) -> pa.Table:
        file = table.column("file")[0].as_py()
        rows = zip(*(table.column(name).to_pylist() for name in ("record", "revisit", "refers_to")))
        revisits = {number: refers for number, again, refers in rows if again}
        system, place = open_folder(file)
        target, root = open_folder(folder)
        name = uuid.uuid4().hex
        target.create_dir(root, recursive=True)
        lines, at = [], 0
        with system.open_input_stream(place, compression=None) as source:
            with target.open_output_stream(f"{root}/{name}.warc.gz", compression=None) as out:
                for number, (head, block) in enumerate(records(inflated(source))):
                    page_id, kind, refers = page_of(head["WARC-Record-ID"]), "response", None
                    if number in revisits:
                        kind, refers, block = "revisit", revisits[number], HTTP
                    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                    size = int(head["WARC-Payload-Length"])
                    data = record(kind, page_id, head["WARC-Target-URI"], digest, size, block, refers)
                    packer = zlib.compressobj(6, zlib.DEFLATED, GZIP)
                    member = packer.compress(data) + packer.flush()
                    out.write(member)
                    lines.append(json.dumps({"page_id": page_id, "type": kind, "offset": at, "length": len(member)}))
                    at += len(member)
        with target.open_output_stream(f"{root}/{name}.index.jsonl", compression=None) as out:
            out.write(("\n".join(lines) + "\n").encode())
        return pa.table(
            {"warc": [f"{folder}/{name}.warc.gz"], "sidecar": [f"{folder}/{name}.index.jsonl"], "records": [len(lines)]}
        )

    # as many tasks as files: by their size alone, the short lists of records would all go to one
    files = max(1, marked.select("file").distinct().count())
    chosen = marked.select("file", "record", "revisit", "refers_to").repartition(files, "file")
    return settle(chosen.groupBy("file").applyInArrow(rewrite, FILES), "archives")


def open_record(stream, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """The record at a place that the sidecar index names."""
    stream.seek(offset)
    return next(records(iter([zlib.decompress(stream.read(length), GZIP)])))


def read_records(archives: DataFrame) -> DataFrame:
    """``RECORDS`` of all archives, read member by member through the indexes; payloads are checked by their digests."""

    def read(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for warc, sidecar in zip(batch.column("warc").to_pylist(), batch.column("sidecar").to_pylist()):
                system, place = open_folder(warc)
                with system.open_input_stream(open_folder(sidecar)[1], compression=None) as stream:
                    entries = [json.loads(line) for line in stream.read().decode().splitlines()]
                rows = []
                with system.open_input_file(place) as stream:
                    for entry in entries:
                        head, block = open_record(stream, entry["offset"], entry["length"])
                        digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                        size, refers = int(head["WARC-Payload-Length"]), None
                        if head["WARC-Type"] == "revisit":
                            refers = page_of(head["WARC-Refers-To"])
                        else:
                            payload = payload_of(block)
                            if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
                                raise ValueError(f"damaged record at {entry['offset']} of {warc}")
                        rows.append((page_of(head["WARC-Record-ID"]), size, digest, head["WARC-Type"], refers))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return archives.repartition(max(1, archives.count()), "warc").mapInArrow(read, RECORDS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write, normalise and read back all pages in a fresh shared folder."""
    spark = pages.sparkSession
    written = write_archives(pages, shared_folder(spark, "monolithic"))
    return read_records(normalise(repeats(written), shared_folder(spark, "warc")))
