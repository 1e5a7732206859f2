"""Passages of benchmark items in documents, found by one Aho-Corasick automaton over all item windows.

Texts are compared as words in lower case, joined by single blanks and with one at either end; a window is ``words``
consecutive words of an item written the same way, so an occurrence always starts and ends at words. The automaton
holds every distinct window with the items it belongs to, and each text goes through it once. Where a word of the
normalised text began in the original is known from the same pass, so hits come back as spans of the original text.

The automaton is built on each worker from a broadcast list of items. Its size is bounded: items are dealt to shards of
at most ``SHARD_BYTES`` of text, and each shard is one pass; passes follow each other in one stage without a shuffle,
adding to the hits found so far. One shard suffices for thousands of test questions.

Defined results: null or wordless texts have no words and no hits; null or wordless items have no window. Repeated rows
are each reported. Repeated item ids count once per id; an item without id takes part in hits but not in the
list of ids. Empty tables give empty results, or no hits. Columns other than id and text are kept by ``spans`` and
``clean``, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import BATCH_BYTES, Batches, slices, texts_of, with_columns

WINDOW = 10
SHARD_BYTES = 4 << 20

# Words are ASCII letters and digits and all bytes of letters beyond ASCII; A-Z are lower-cased, the rest is blank.
WORDS = bytes(
    byte if byte >= 0x80 or 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A else byte + 32 if 0x41 <= byte <= 0x5A else 0x20
    for byte in range(256)
)

HITS = "struct<n_words:bigint,first:array<int>,last:array<int>,items:array<bigint>>"
HITS_TYPE = pa.struct(
    [("n_words", pa.int64()), ("first", pa.list_(pa.int32())), ("last", pa.list_(pa.int32())), ("items", pa.list_(pa.int64()))]
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


def windows(text: bytes, size: int = WINDOW) -> set[str]:
    """The windows of an item, as the automaton holds them."""
    words = words_of(text)
    if not words:
        return set()
    return {
        f" {b' '.join(words[at : at + size]).decode('latin-1')} " for at in range(max(1, len(words) - size + 1))
    }


@lru_cache(maxsize=4)
def _automaton(items: tuple[tuple[int | None, bytes], ...], size: int) -> ahocorasick.Automaton:
    owners: dict[str, tuple[int, set]] = {}
    for item_id, text in items:
        for window in windows(text, size):
            owners.setdefault(window, (window.count(" ") - 1, set()))[1].add(item_id)
    automaton = ahocorasick.Automaton()
    for window, (length, ids) in owners.items():
        automaton.add_word(window, (length, frozenset(ids - {None})))
    if owners:
        automaton.make_automaton()
    return automaton


def find(text: bytes, automaton: ahocorasick.Automaton) -> tuple[int, list[int], list[int], set[int]]:
    """Number of words, first and last word of each run of hit words, items that occur."""
    words = words_of(text)
    if not words or not len(automaton):
        return len(words), [], [], set()
    found = list(automaton.iter(f" {b' '.join(words).decode('latin-1')} "))
    if not found:
        return len(words), [], [], set()
    # the blank after word i stands at the summed lengths of the words up to i, and one blank for each before
    after = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    last = np.searchsorted(after, [end for end, _ in found])
    first = last - [length - 1 for _, (length, _) in found]
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, first, 1)
    np.add.at(edges, last + 1, -1)
    hit = np.flatnonzero(np.diff(np.concatenate(([0], np.cumsum(edges)[:-1] > 0, [0]))))
    items: set[int] = set().union(*{ids for _, (_, ids) in found})
    return len(words), hit[::2].tolist(), (hit[1::2] - 1).tolist(), items


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or adjacent runs of words as one."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def scanned(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The documents with a column ``_hits``; no shuffle."""
    items = with_columns(benchmark, item_id="long", text="string").where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    out = documents.withColumn("_hits", F.lit(None).cast(HITS))
    for shard in range(shards):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == shard) if shards > 1 else items
        # at most about a shard's bytes reach the driver at once
        held = tuple((row.item_id, row.text.encode()) for row in part.toLocalIterator())
        shared = documents.sparkSession.sparkContext.broadcast(held)
        out = out.mapInArrow(_scan(shared, size), out.schema)
    return out


def _scan(shared, size: int):
    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(shared.value, size)
        for batch in slices(batches, BATCH_BYTES):
            rows = []
            for text, old in zip(texts_of(batch), batch.column("_hits").to_pylist()):
                n_words, first, last, found = find(text, automaton)
                if old:
                    runs = merged([*zip(first, last), *zip(old["first"], old["last"])])
                    first, last = [run[0] for run in runs], [run[1] for run in runs]
                    found = found.union(old["items"])
                rows.append({"n_words": n_words, "first": first, "last": last, "items": sorted(found)})
            at = batch.schema.get_field_index("_hits")
            yield batch.set_column(at, "_hits", pa.array(rows, HITS_TYPE))

    return run


def contamination(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    rows = scanned(with_columns(documents, doc_id="long", text="string"), benchmark, size)
    hit = F.aggregate(
        F.arrays_zip("_hits.first", "_hits.last"),
        F.lit(0).cast("long"),
        lambda total, run: total + run["last"] - run["first"] + 1,
    )
    listed = F.array_join(F.array_sort(F.col("_hits.items").cast("array<string>")), ",")
    return rows.select(
        "doc_id",
        F.col("_hits.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("_hits.items").cast("long").alias("n_items"),
        F.sha2(listed.cast("binary"), 256).alias("items_sha256"),
        (F.size("_hits.first") > 0).alias("contaminated"),
    )


def original_spans(text: str, first: list[int], last: list[int]) -> list[tuple[int, int]]:
    """Runs of words as character spans of the original text; the end is exclusive."""
    data = text.encode()
    blank = np.frombuffer(data.translate(WORDS), np.uint8) == 0x20
    edges = np.flatnonzero(np.diff(np.concatenate(([1], blank, [1]))))
    starts, ends = edges[::2], edges[1::2]
    places = np.cumsum(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)  # characters begun up to each byte
    return [(int(places[starts[a]]) - 1, int(places[ends[b] - 1])) for a, b in zip(first, last)]


def spans(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents that hold a window, with a column ``contaminated_spans`` of (start, end) in characters."""
    hits = scanned(documents, benchmark, size).where(F.size("_hits.first") > 0)
    out = F.lit(None).cast("array<struct<start:int,end:int>>")
    wanted = hits.withColumn("contaminated_spans", out)

    def place(batches: Batches) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            rows = []
            for text, found in zip(texts_of(batch), batch.column("_hits").to_pylist()):
                found_spans = original_spans(text.decode(), found["first"], found["last"])
                rows.append([{"start": start, "end": end} for start, end in found_spans])
            yield batch.set_column(batch.num_columns - 1, "contaminated_spans", pa.array(rows, kind))

    return wanted.mapInArrow(place, wanted.schema).drop("_hits")


def clean(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents without any window of an item, all columns."""
    return scanned(documents, benchmark, size).where(F.size("_hits.first") == 0).drop("_hits")
