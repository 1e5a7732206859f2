from __future__ import annotations

import gzip
import hashlib
import io
import json
import zlib

import pytest

from tallybook.llm.common import open_folder
from tallybook.llm.warc import normalise, open_record, payload_of, records, repeats, round_trip, write_archives
from tallybook.session import shared_folder

PAGES = "page_id long, url string, html string, digest string"


def brute(rows):
    out = []
    for page_id, _, html, _ in rows:
        data = (html or "").encode()
        same = [i for i, _, other, _ in rows if (other or "").encode() == data and i is not None]
        first = min(same) if same else None
        again = len(data) >= 100 and first is not None and page_id != first
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


@pytest.fixture
def pages(spark):
    return lambda rows: spark.createDataFrame(rows, PAGES).repartition(3)


ROWS = [
    (at * 5 % 97, f"http://x/{at}\r\nEvil: 1", ("é" * 60 if at % 3 else f"<p>{at}</p>" * (at % 30)), "x") for at in range(97)
] + [(200, None, None, "x"), (201, "u", "", "x"), (202, "u", "a" * 99, "x"), (203, "u", "a" * 99, "x"), (None, "u", "é" * 60, "x")]


def found(table):
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(row[name] for name in names) for row in table.collect()), key=str)


def test_round_trip(pages):
    assert found(round_trip(pages(ROWS))) == brute(ROWS)


def test_empty_and_repeated_rows(pages):
    assert round_trip(pages(ROWS[:0])).count() == 0
    rows = [(1, "u", "b" * 200, "x")] * 4 + [(None, None, None, None)] * 2
    kinds = [(row[0], row[3], row[4]) for row in found(round_trip(pages(rows)))]
    assert sorted(kinds, key=str) == [(1, "response", None)] + [(1, "revisit", 1)] * 3 + [(None, "response", None)] * 2


def test_members_and_sidecar_index(spark, pages):
    written = write_archives(pages(ROWS), shared_folder(spark, "mono"), file_bytes=2000)
    assert written.select("file").distinct().count() > 3
    for row in written.select("file").distinct().collect():
        system, place = open_folder(row.file)
        raw = system.open_input_file(place).read()
        opener = zlib.decompressobj(31)
        opener.decompress(raw)
        assert opener.eof and not opener.unused_data  # one stream for the whole file
    archives = normalise(repeats(written), shared_folder(spark, "warc")).collect()
    assert sum(row.records for row in archives) == len(ROWS)
    payloads = {page_id: (html or "").encode() for page_id, _, html, _ in ROWS}
    for row in archives:
        system, place = open_folder(row.warc)
        raw = system.open_input_file(place).read()
        lines = system.open_input_file(open_folder(row.sidecar)[1]).read().decode().splitlines()
        end = 0
        for entry in map(json.loads, lines):
            assert entry["offset"] == end
            end += entry["length"]
            member = gzip.decompress(raw[entry["offset"] : end])
            assert member.startswith(b"WARC/1.1\r\n") and member.endswith(b"\r\n\r\n")
            head, block = open_record(io.BytesIO(raw), entry["offset"], entry["length"])
            assert "Evil" not in head and head["WARC-Type"] == entry["type"]
            if entry["type"] == "response":
                assert payload_of(block) == payloads[entry["page_id"]]
        assert end == len(raw)


def test_records_in_chunks_of_any_size():
    from tallybook.llm.warc import HTTP, record

    data = b"".join(record("response", at, "u", "0", 3, HTTP + b"\r\n\r\n"[:at] + b"abc") for at in range(4))
    for size in (1, 7, len(data)):
        parts = [data[at : at + size] for at in range(0, len(data), size)]
        assert [payload_of(block) for _, block in records(iter(parts))] == [b"\r\n\r\n"[:at] + b"abc" for at in range(4)]
    with pytest.raises(ValueError):
        list(records(iter([data[:-3]])))


def test_inflated_chunks_stay_small():
    from tallybook.llm.warc import CHUNK, inflated

    parts = [b"\x00" * (40 << 20), b"abc" * 1000, b""]
    stream = io.BytesIO(b"".join(gzip.compress(part) for part in parts))
    size, most, tail = 0, 0, b""
    for piece in inflated(stream):
        size, most, tail = size + len(piece), max(most, len(piece)), (tail + piece)[-3000:]
    assert (size, most <= CHUNK, tail) == (sum(map(len, parts)), True, parts[1])


def test_long_payloads(pages):
    rows = [(1, "u", "<p>long</p>" * 900_000, "x"), (2, "u", "short", "x"), (3, "u", "<p>long</p>" * 900_000, "x")]
    assert found(round_trip(pages(rows))) == brute(rows)


def test_every_file_is_rewritten_by_a_task_of_its_own(spark, pages):
    written = write_archives(pages(ROWS), shared_folder(spark, "mono"), file_bytes=2000)
    files = written.select("file").distinct().count()
    archives = normalise(repeats(written), shared_folder(spark, "warc"))
    assert archives.count() == files and len(archives.inputFiles()) > 1
