"""Links between documents whose sets of word n-grams have a Jaccard similarity of at least num / den, as components.

The join is a sparse matrix product of documents by n-grams, done in blocks that hold all pairs that can link:

1. Sets. Each text becomes a sorted set of 64-bit n-gram hashes; equal sets are one class from here on.
2. Blocks. Two linked sets differ in few n-grams, a number bounded by their sizes. The hash range is cut into more
   parts than that number, so a third of the parts, empty ones included, are equal in both sets. Sizes decide the number of
   parts: a set takes part with the bound of its own size class and with that of the next one, so that it meets every set
   it may link to, and no other sizes. Every part is counted over all documents. A set whose parts occur elsewhere in too
   few cases links to nothing and ends here. Of the others only the rarest parts count, as many as must hold a shared one
   whichever parts are shared: passages that many documents have are left out so. Documents that share such a part are
   candidates. Counts are combined in the task that reads the texts and then per range of part keys, and shared parts are
   reduced to a spanning forest in the same two steps, so a part that a third of all documents share costs one row per
   batch. Components of this graph are the blocks.
3. Product. Within a block, the overlaps of one document with all documents not yet reached are one sparse
   matrix-vector product, over the documents whose sizes allow a link; those with enough overlap are reached, and are
   multiplied next. So every link that matters for the components is tested on the full sets, and a group of n copies
   takes n links, not n^2 pairs.
4. A block of more than ``BLOCK_SETS`` sets (or ``BLOCK_ENTRIES`` n-grams) is dealt to several tasks with some sets in
   common. Most sets end in one component. Each set outside it is then compared with all sets of other components, in
   pairs of blocks; this is exact whatever the sizes.

N-grams are compared by 64-bit hashes of their words; two different ones of a pair of documents would have to collide
to change a count by one.

Defined results: null, empty and blank texts have no n-grams and link to nothing; a text of fewer words is one n-gram.
Repeated rows link to each other. Rows without doc_id take part, and the smallest doc_id of a component ignores them; a
component of such rows alone has a null id. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import (
    BATCH_BYTES,
    BLANKS,
    LOWER,
    Batches,
    released,
    released_group,
    slices,
    text_key,
    texts_of,
    with_columns,
    without_rows,
)
from tallybook.llm.components import connected, forest
from tallybook.operators.sinks import settle

RANGE_BYTES = 4 << 20
KEYS_BYTES = 8 << 20  # of text whose keys a task combines
SALTS = 64
BLOCK_SETS = 2000
BLOCK_ENTRIES = 1 << 20
SHARED_SETS = 32

U64 = np.uint64
IS_BLANK = np.isin(np.arange(256), list(BLANKS))
STEP = U64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (constants of the public splitmix64 generator)."""
    values = (values ^ (values >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> U64(27))) * U64(0x94D049BB133111EB)
    return values ^ (values >> U64(31))


BYTE_VALUES = mixed(STEP * np.arange(1, 257, dtype=U64))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of lower-cased text starts, and its hash: a polynomial of its bytes in a power of ``STEP``."""
    codes = np.frombuffer(data, np.uint8)
    blank = IS_BLANK[codes]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True]))))
    starts, ends = edges[::2], edges[1::2]
    length = int((ends - starts).max(initial=0))
    hashes = np.zeros(len(starts), U64)
    sizes = ends - starts
    order = np.argsort(sizes, kind="stable")  # the words of at least a length are a tail of this order
    begins = np.searchsorted(sizes[order], np.arange(1, min(length, 64) + 1))
    tail = starts[order]
    held = np.zeros(len(starts), U64)
    for at, first in enumerate(begins.tolist()):
        held[first:] = held[first:] * STEP + BYTE_VALUES[codes[tail[first:] + at]]
    hashes[order] = held
    for word in np.flatnonzero(sizes > 64).tolist():
        digest = hashlib.blake2b(data[starts[word] : ends[word]], digest_size=8).digest()
        hashes[word] = np.frombuffer(digest, U64)[0]
    return starts, mixed(hashes ^ (sizes.astype(U64) * BYTE_VALUES[7]))


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    sets: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        size, upto = 0, at
        while upto < len(texts) and (upto == at or size + len(texts[upto]) < 1 << 20):
            size += len(texts[upto]) + 1
            upto += 1
        sets.extend(_sets_of(texts[at:upto], words))
        at = upto
    return sets


def _sets_of(texts: list[bytes], words: int) -> list[np.ndarray]:
    data = b"\n".join(texts).translate(LOWER) + b"\n"
    places = np.cumsum([0] + [len(text) + 1 for text in texts])
    starts, hashes = word_hashes(data)
    bounds = np.searchsorted(starts, places)
    grams = np.zeros(max(len(hashes) - words + 1, 0), U64)
    for at in range(words):
        grams = mixed(grams + STEP) + hashes[at : at + len(grams)]
    grams = mixed(grams)
    sets = []
    for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if last - first >= words:
            sets.append(np.unique(grams[first : last - words + 1]))
        elif last > first:
            whole = np.array([last - first], U64)
            for at in range(first, last):
                whole = mixed(whole + STEP) + hashes[at : at + 1]
            sets.append(mixed(whole ^ STEP))
        else:
            sets.append(np.empty(0, U64))
    return sets


@dataclass(frozen=True)
class Similarity:
    """Jaccard of at least num / den, over n-grams of ``words`` words, and the bounds that follow from it."""

    words: int = 4
    num: int = 85
    den: int = 100

    def links(self, overlap: np.ndarray, size: int, sizes: np.ndarray) -> np.ndarray:
        return self.den * overlap >= self.num * (size + sizes - overlap)

    def size_classes(self, largest: int) -> list[int]:
        """The first size of each class; sizes that may link are in one class or in two that follow each other."""
        firsts = [1]
        while firsts[-1] <= largest:
            firsts.append(firsts[-1] * self.den // self.num + 1)
        return firsts

    def bounds(self, largest: int) -> np.ndarray:
        """The first size of each class up to that of ``largest`` and of two more."""
        firsts = self.size_classes(largest)
        firsts.append(firsts[-1] * self.den // self.num + 1)
        return np.array(firsts, np.int64)

    def parts(self, first_above: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        """Of a size class whose sizes are below ``first_above``: the number of parts, and how many may differ."""
        different = 2 * (first_above - 1) * (self.den - self.num) // (self.den + self.num)
        return different + 1 + different // 2, different

    def part_keys(self, grams: np.ndarray, number: int, first_above: int) -> np.ndarray:
        """Keys of all parts of a set under size class ``number``, whose sizes are below ``first_above``, empty ones too.

        With ``parts`` parts and at most ``different`` differing n-grams, ``parts - different`` parts are equal in a
        linked set.
        """
        parts, _ = self.parts(first_above)
        part = (((grams >> U64(32)) * U64(parts)) >> U64(32)).astype(np.int64)  # ascending, as the grams are
        begins = np.flatnonzero(np.diff(part, prepend=-1))
        sums = np.zeros(parts, U64)
        sums[part[begins]] = np.add.reduceat(mixed(grams), begins)
        salt = mixed(np.arange(parts, dtype=U64) * STEP + U64(number))
        return mixed(sums + salt * U64(2))


# Rows of documents, and of batches of documents on their way to ranges of keys (slots) and back. ``keys`` are the upper
# ``KEY_BYTES`` bytes of part keys; two different ones that agree in these cost a comparison, no more.
KEY_BYTES = 6
ROWS = pa.schema(
    [
        ("kind", pa.string()),
        ("slot", pa.int64()),
        ("batch", pa.int64()),
        ("keys", pa.binary()),
        ("counts", pa.binary()),
        ("owners", pa.binary()),
        ("nodes", pa.binary()),
        ("sizes", pa.binary()),
        ("doc_id", pa.int64()),
        ("n_shingles", pa.int64()),
        ("digest", pa.binary()),
        ("text_key", pa.int64()),
        ("node", pa.int64()),
    ]
)
ROWS_DDL = (
    "kind string, slot long, batch long, keys binary, counts binary, owners binary, nodes binary, sizes binary, "
    "doc_id long, n_shingles long, digest binary, text_key long, node long"
)
EDGES = pa.schema([("slot", pa.int64()), ("keys", pa.binary()), ("nodes", pa.binary()), ("node", pa.int64()), ("other", pa.int64())])
EDGES_DDL = "slot long, keys binary, nodes binary, node long, other long"


def packed_keys(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes()


def unpacked_keys(data: bytes) -> np.ndarray:
    keys = np.zeros((len(data) // KEY_BYTES, 8), np.uint8)
    keys[:, :KEY_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, KEY_BYTES)
    return keys.view("<u8").ravel()


def _batch(schema: pa.Schema, length: int, **columns) -> pa.RecordBatch:
    arrays = []
    for field in schema:
        values = columns.get(field.name)
        if values is None:
            arrays.append(pa.nulls(length, field.type))
        else:
            arrays.append(values.cast(field.type) if isinstance(values, pa.Array) else pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def digest_of(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def _shared_keys(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, ...]:
    """One node per key, and forest edges between the nodes of each key."""
    order = np.argsort(keys, kind="stable")
    keys, nodes = keys[order], nodes[order]
    first = np.append(True, keys[1:] != keys[:-1]) if len(keys) else np.empty(0, bool)
    lead = nodes[np.flatnonzero(first)[np.cumsum(first) - 1]] if len(keys) else nodes
    apart = lead != nodes
    return keys[first], nodes[first], *forest(nodes[apart], lead[apart])


def _slots_of(keys: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The slots that ascending keys fall into, with where each begins and ends."""
    slots = (keys >> U64(8 * KEY_BYTES - 32)) * U64(ranges) >> U64(32)
    begins = np.flatnonzero(np.diff(slots.astype(np.int64), prepend=-1))
    return slots[begins].astype(np.int64), begins, np.append(begins[1:], len(keys))


def _read(like: Similarity, ranges: int):
    """Rows of kind doc; of kind own, what a batch keeps of its sets; of kind ask, its distinct part keys by slot."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for at, batch in enumerate(slices(batches, KEYS_BYTES)):
            number = (task << 32) + at  # the same when the task runs again
            sets = shingle_sets(texts_of(batch), like.words)
            sizes = np.array([len(grams) for grams in sets], np.int64)
            digests = [digest_of(grams) if len(grams) else None for grams in sets]
            lane = ranges + (task * 1009 + at) % ranges
            docs = {"doc_id": batch.column("doc_id"), "text_key": batch.column("text_key")}
            own = {"kind": ["doc"] * len(sets), "slot": np.full(len(sets), lane)}
            nodes = pa.array([int.from_bytes(d[:8], "little", signed=True) if d else None for d in digests], pa.int64())
            yield _batch(ROWS, len(sets), n_shingles=sizes, digest=digests, node=nodes, **own, **docs)
            places = np.array(list({digest: place for place, digest in enumerate(digests) if digest}.values()), np.int64)
            if not len(places):
                continue
            sizes = sizes[places]
            nodes = nodes.take(pa.array(places)).to_numpy()
            firsts = like.bounds(int(sizes.max()))
            classes = np.searchsorted(firsts, sizes, side="right") - 1
            keys, owners = [], []
            for owner, (place, first) in enumerate(zip(places.tolist(), classes.tolist())):
                for step in (0, 1):
                    keys.append(like.part_keys(sets[place], first + step, int(firsts[first + step + 1])))
                    owners.append(np.full(len(keys[-1]), 2 * owner + step, np.uint32))
            keys, owners = np.concatenate(keys) >> U64(64 - 8 * KEY_BYTES), np.concatenate(owners)
            order = np.argsort(keys, kind="stable")
            keys, owners = keys[order], owners[order]
            starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            counts = np.minimum(np.diff(np.append(starts, len(keys))), 255).astype(np.uint8)
            kept = {"owners": [owners.tobytes()], "counts": [np.diff(np.append(starts, len(keys))).astype(np.uint32).tobytes()]}
            kept |= {"nodes": [nodes.tobytes()], "sizes": [sizes.tobytes()]}
            yield _batch(ROWS, 1, kind=["own"], slot=[lane], batch=[number], **kept)
            keys = keys[starts]
            slots, begins, ends = _slots_of(keys, ranges)
            cuts = list(zip(begins.tolist(), ends.tolist()))
            asked = {"keys": [packed_keys(keys[a:b]) for a, b in cuts], "counts": [counts[a:b].tobytes() for a, b in cuts]}
            yield _batch(ROWS, len(slots), kind=["ask"] * len(slots), slot=slots, batch=[number] * len(slots), **asked)

    return run


def _count(ranges: int):
    """Per slot: for every batch, the order of magnitude of each of its keys' counts, 0 for keys of one set, and the others' keys."""

    def run(table: pa.Table) -> pa.Table:
        if table.column("slot")[0].as_py() >= ranges:
            return table
        asked = [unpacked_keys(data) for data in table.column("keys").to_pylist()]
        own = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint8)
        keys, back = np.unique(np.concatenate(asked), return_inverse=True)
        totals = np.bincount(back, weights=own, minlength=len(keys)).astype(np.int64)
        grades = np.frexp(totals - 1)[1].astype(np.uint8)  # 0 for 1, then 1 for 2, 2 for 3 and 4, ...
        grades = grades[back]
        ends = np.cumsum([len(part) for part in asked]).tolist()
        begins = [0, *ends[:-1]]
        return pa.Table.from_batches(
            [
                _batch(
                    ROWS,
                    len(asked),
                    kind=["reply"] * len(asked),
                    slot=table.column("slot").combine_chunks(),
                    batch=table.column("batch").combine_chunks(),
                    counts=[grades[a:b].tobytes() for a, b in zip(begins, ends)],
                    keys=[packed_keys(part[grades[a:b] > 0]) for part, a, b in zip(asked, begins, ends)],
                )
            ]
        )

    return run


def rarest_shared(like: Similarity, sizes: np.ndarray, owners: np.ndarray, keys: np.ndarray, grades: np.ndarray) -> np.ndarray:
    """Places of the keys that make candidates. ``owners`` are 2 * set, plus 1 for the next size class; grade 0 is not shared.

    Of its parts, in the order of (grade, key), a set needs the first ``different + 1``: a linked set, which has at least
    ``parts - different`` parts equal, shares one of those that are the first in the same order in both.
    """
    firsts = like.bounds(int(sizes.max(initial=1)))
    classes = np.searchsorted(firsts, sizes, side="right") - 1
    above = np.stack((firsts[classes + 1], firsts[classes + 2]), axis=1).ravel()
    parts, different = like.parts(above)
    shared = np.flatnonzero(grades > 0)
    shared = shared[np.lexsort((keys[shared], grades[shared], owners[shared]))]
    held = np.bincount(owners[shared], minlength=len(above))
    wanted = different + 1 - (parts - held)
    rank = np.arange(len(shared)) - (np.cumsum(held) - held)[owners[shared]]
    return shared[rank < wanted[owners[shared]]]


def _choose(like: Similarity, ranges: int):
    """Per batch: the keys that make candidates, one node each, by slot, and edges between the nodes of one key."""

    def run(table: pa.Table) -> pa.Table:
        kept = table.filter(pc.equal(table.column("kind"), "own"))
        replies = table.filter(pc.equal(table.column("kind"), "reply")).sort_by("slot")
        times = np.frombuffer(kept.column("counts")[0].as_py(), np.uint32)
        owners = np.frombuffer(kept.column("owners")[0].as_py(), np.uint32).astype(np.int64)
        nodes = np.frombuffer(kept.column("nodes")[0].as_py(), np.int64)
        sizes = np.frombuffer(kept.column("sizes")[0].as_py(), np.int64)
        grades = np.frombuffer(b"".join(replies.column("counts").to_pylist()), np.uint8)
        keys = np.zeros(len(grades), U64)
        keys[grades > 0] = unpacked_keys(b"".join(replies.column("keys").to_pylist()))
        keys, grades = np.repeat(keys, times), np.repeat(grades, times)
        chosen = rarest_shared(like, sizes, owners, keys, grades)
        keys, holders, node, other = _shared_keys(keys[chosen], nodes[owners[chosen] // 2])
        slots, begins, ends = _slots_of(keys, ranges)
        cuts = list(zip(begins.tolist(), ends.tolist()))
        asked = {"keys": [packed_keys(keys[a:b]) for a, b in cuts], "nodes": [holders[a:b].tobytes() for a, b in cuts]}
        edges = _batch(EDGES, len(node), slot=ranges + np.arange(len(node)) % ranges, node=node, other=other)
        return pa.Table.from_batches([_batch(EDGES, len(slots), slot=slots, **asked), edges])

    return run


def _join_slot(ranges: int):
    """Edges between the nodes of each key over all batches; edges found before pass through."""

    def run(table: pa.Table) -> pa.Table:
        if table.column("slot")[0].as_py() >= ranges:
            return table.select(["node", "other"])
        keys = unpacked_keys(b"".join(table.column("keys").to_pylist()))
        nodes = np.frombuffer(b"".join(table.column("nodes").to_pylist()), np.int64)
        _, _, node, other = _shared_keys(keys, nodes)
        return pa.table({"node": pa.array(node, pa.int64()), "other": pa.array(other, pa.int64())})

    return run


def _candidates(documents: DataFrame, like: Similarity, ranges: int) -> tuple[DataFrame, DataFrame]:
    """Rows of the documents with their digests, and edges between the nodes of candidates."""
    rows = documents.select("doc_id", "text", text_key().alias("text_key")).mapInArrow(released(_read(like, ranges)), ROWS_DDL)
    found = settle(rows.groupBy("slot").applyInArrow(released_group(_count(ranges)), ROWS_DDL), "candidates", "kind")
    docs = found.where("kind = 'doc'").select("doc_id", "n_shingles", "digest", "text_key", "node")
    batches = found.where("kind in ('own', 'reply')")
    batches = batches.select("kind", "slot", "batch", "keys", "counts", "owners", "nodes", "sizes")
    chosen = batches.groupBy("batch").applyInArrow(released_group(_choose(like, ranges)), EDGES_DDL)
    edges = chosen.groupBy("slot").applyInArrow(released_group(_join_slot(ranges)), "node long, other long")
    return docs, edges


class Incidence:
    """Documents by n-grams of one block, in order of set size, without n-grams that one document has alone."""

    def __init__(self, sets: list[np.ndarray], like: Similarity):
        self.like = like
        self.sizes = np.array([len(grams) for grams in sets], np.int64)
        _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = count > 1
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), self.sizes)
        kept = shared[column]
        self.columns = (np.cumsum(shared) - 1)[column[kept]].astype(np.int32)
        self.bounds = np.searchsorted(owner[kept], np.arange(len(sets) + 1))
        self.mark = np.zeros(int(shared.sum()) + 1, bool)

    def row(self, at: int) -> np.ndarray:
        return self.columns[self.bounds[at] : self.bounds[at + 1]]

    def linked(self, pivot: int, rest: np.ndarray) -> np.ndarray:
        """Which of ``rest``, ascending, link to ``pivot``: a matrix-vector product over the sizes that may."""
        size, like = int(self.sizes[pivot]), self.like
        low = np.searchsorted(self.sizes[rest], -(-size * like.num // like.den))
        high = np.searchsorted(self.sizes[rest], size * like.den // like.num, side="right")
        rest = rest[low:high]
        if not len(rest):
            return rest
        counts = self.bounds[rest + 1] - self.bounds[rest]
        within = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        columns = self.columns[within + np.repeat(self.bounds[rest], counts)]
        self.mark[self.row(pivot)] = True
        sums = np.concatenate(([0], np.cumsum(self.mark[columns])))
        self.mark[self.row(pivot)] = False
        ends = np.cumsum(counts)
        overlap = sums[ends] - sums[ends - counts]
        return rest[like.links(overlap, size, self.sizes[rest])]


def block_components(sets: list[np.ndarray], like: Similarity, known: np.ndarray | None = None) -> np.ndarray:
    """A component number for each set, by links among the sets; sets of one ``known`` label are connected already."""
    order = np.argsort([len(grams) for grams in sets], kind="stable")
    matrix = Incidence([sets[at] for at in order], like)
    labels = np.arange(len(sets)) if known is None else np.unique(known, return_inverse=True)[1][order]
    members: dict[int, list[int]] = {}
    for at, label in enumerate(labels.tolist()):
        members.setdefault(label, []).append(at)
    out = np.full(len(sets), -1)
    rest = np.arange(len(sets))
    for seed in range(len(sets)):
        if out[seed] >= 0:
            continue
        queue = list(members[int(labels[seed])])
        out[queue] = seed
        rest = rest[out[rest] < 0]
        while queue and len(rest):
            reached = matrix.linked(queue.pop(), rest)
            if len(reached):
                for label in np.unique(labels[reached]).tolist():
                    out[members[label]] = seed
                    queue.extend(members[label])
                rest = rest[out[rest] < 0]
    result = np.empty(len(sets), np.int64)
    result[order] = out
    return result


SETS = "block long, rep long, digest binary, grams binary, label long"


def _link_blocks(like: Similarity):
    """Per block: each set's smallest ``rep`` among the sets it is connected to."""

    def run(table: pa.Table) -> pa.Table:
        rows = dict(zip(table.column("digest").to_pylist(), range(len(table))))  # repeated ids may repeat a set
        table = table.take(list(rows.values()))
        sets = [np.frombuffer(grams, U64) for grams in table.column("grams").to_pylist()]
        label = table.column("label")
        known = None if label.null_count else label.to_numpy()
        return _smallest_reps(table, block_components(sets, like, known))

    return run


def _smallest_reps(table: pa.Table, found: np.ndarray) -> pa.Table:
    reps = table.column("rep").to_numpy()
    low = np.full(len(reps), np.iinfo(np.int64).max)
    np.minimum.at(low, found, reps)
    schema = pa.schema([("digest", pa.binary()), ("node", pa.int64()), ("other", pa.int64())])
    return pa.table([table.column("digest"), pa.array(reps), pa.array(low[found])], schema=schema)


LINKED_DDL = "digest binary, node long, other long"


def components(documents: DataFrame, like: Similarity = Similarity(), block_sets: int = BLOCK_SETS) -> DataFrame:
    """Per document: ``doc_id, n_shingles, component_id``, and ``text_key`` of its text."""
    docs = with_columns(documents, doc_id="long", text="string")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, -(-total // RANGE_BYTES))
    rows, edges = _candidates(docs, like, ranges)
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))

    # one row per distinct set; rep is the smallest doc_id, and stands for the set
    salted = rows.where("digest is not null").groupBy("digest", "node", "n_shingles", "salt").agg(F.min("doc_id").alias("rep"))
    classes = salted.groupBy("digest", "node", "n_shingles").agg(
        F.min("rep").alias("rep"), F.bit_or(F.expr("shiftleft(1L, salt)")).alias("salts")
    )
    classes = settle(classes, "classes")
    blocks = connected(edges)
    members = settle(classes.join(blocks, "node").select("rep", "node", "digest", "n_shingles", "label"), "members")
    linked = _linked(docs, members, like, block_sets)
    # the smallest doc_id of each component, which its sets look up by salt; a set without any doc_id has no part in it
    tied = settle(classes.select("digest", "rep").join(linked, "digest"), "tied")
    # lists that grow with the input are joined by shuffle: their size after exploding is no estimate of Spark's
    tied = tied.withColumn("salt", F.pmod(F.xxhash64("digest"), F.lit(SALTS)).cast("int"))
    used = F.bit_or(F.expr("shiftleft(1L, salt)")).alias("salts")
    least = tied.groupBy("component").agg(F.min("rep").alias("least"), used)
    least = least.select("component", "least", _in_use("salts")).hint("merge")
    tied = tied.join(least, ["component", "salt"]).select("digest", "least")
    ids = classes.join(tied, "digest", "left").select("digest", "salts", F.coalesce("least", "rep").alias("component_id"))

    # back to the documents by (digest, salt): the copies of one set are spread over the salts
    spread = ids.select("digest", "component_id", _in_use("salts")).hint("merge")
    of_sets = rows.where("digest is not null").join(spread, ["digest", "salt"])
    without = rows.where("digest is null").withColumn("component_id", F.col("doc_id"))
    wanted = ("doc_id", "n_shingles", "component_id", "text_key")
    return of_sets.select(*wanted).unionByName(without.select(*wanted))


def _in_use(bits: str):
    """A row for each salt whose bit is set."""
    return F.explode(F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda salt: F.getbit(F.col(bits), salt) == 1)).alias("salt")


def _linked(docs: DataFrame, members: DataFrame, like: Similarity, block_sets: int) -> DataFrame:
    """``(digest, component)`` of the sets in blocks; a set's node is its ``rep`` here, as many may have no doc_id."""

    def read(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BATCH_BYTES):
            sets = shingle_sets(texts_of(batch), like.words)
            fits = pa.array([digest_of(s) == d for s, d in zip(sets, batch.column("digest").to_pylist())], pa.bool_())
            grams = pa.array([s.tobytes() for s in sets], pa.binary())
            kept = batch.drop_columns(["text"]).append_column("grams", grams).filter(fits)
            yield kept

    sizes = members.groupBy("label").agg(F.count(F.lit(1)).alias("sets"), F.sum("n_shingles").alias("entries"))
    tasks = F.greatest(F.ceil(F.col("sets") / block_sets), F.ceil(F.col("entries") / BLOCK_ENTRIES)).cast("long")
    sizes = sizes.where("sets > 1").select("label", "sets", tasks.alias("tasks"))
    wanted = members.join(sizes, "label").select("rep", "node", "digest", F.col("label").alias("block"), "sets", "tasks")
    # always by shuffle: the members grow with the input
    texts = docs.join(wanted.hint("merge"), docs["doc_id"].eqNullSafe(wanted["rep"])).select(
        "text", "digest", F.col("node").alias("rep"), "block", "sets", "tasks"
    )
    sets = texts.mapInArrow(released(read), "digest binary, rep long, block long, sets long, tasks long, grams binary")
    sets = settle(sets, "sets")

    whole = sets.where("tasks = 1").select("block", "rep", "digest", "grams", F.lit(None).cast("long").alias("label"))
    out = settle(whole.groupBy("block").applyInArrow(released_group(_link_blocks(like)), LINKED_DDL), "linked").select("digest", F.col("other").alias("component"))
    large = sets.where("tasks > 1")
    if not large.isEmpty():
        out = out.unionByName(_large_blocks(large, like))
    return out.dropDuplicates(["digest"])


def _large_blocks(sets: DataFrame, like: Similarity) -> DataFrame:
    """Blocks that one task must not hold: first parts with some sets in common, then what is left between parts.

    The shared sets of a block are the same in each of its parts. Whatever is connected in some part to the largest
    component that they form by themselves is connected; what is not, a few sets as a rule, is compared with all.
    """
    deal = F.pmod(F.xxhash64("digest"), F.col("tasks"))
    shared = F.pmod(F.xxhash64("digest", F.lit(1)), F.greatest(F.lit(1), F.floor(F.col("sets") / SHARED_SETS))) == 0
    parts = F.when(shared, F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)).otherwise(F.array(deal))
    dealt = sets.withColumn("label", F.when(shared, F.lit(1).cast("long"))).withColumn("part", F.explode(parts))
    first = dealt.groupBy("block", "part").applyInArrow(_link_parts(like), f"{LINKED_DDL}, stray long")
    first = settle(first, "linked")

    strays = first.groupBy("digest").agg(F.min("stray").alias("stray"))
    placed = sets.join(strays, "digest")
    counts = placed.groupBy("block").agg(F.sum("stray").alias("strays")).where("strays > 0")
    placed = placed.join(counts, "block").withColumn("part", deal)
    lanes = F.ceil(F.col("strays") * F.col("tasks") / F.col("sets")).cast("long")
    placed = placed.withColumn("lanes", F.greatest(F.lit(1).cast("long"), lanes))
    stray = F.col("stray") == 1
    # the connected sets share one label, every stray has one of its own
    placed = placed.withColumn("label", F.when(stray, F.xxhash64("digest")).otherwise(F.lit(0).cast("long")))
    every_lane = F.sequence(F.lit(0).cast("long"), F.col("lanes") - 1)
    every_part = F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)
    lane = F.pmod(F.xxhash64("digest", F.lit(2)), F.col("lanes"))
    across = F.transform(every_lane, lambda at: F.struct(F.col("part").alias("part"), at.alias("lane")))
    along = F.transform(every_part, lambda at: F.struct(at.alias("part"), lane.alias("lane")))
    places = F.when(stray, F.array_distinct(F.concat(across, along))).otherwise(across)
    pairs = placed.withColumn("at", F.explode(places)).select("block", "rep", "digest", "grams", "label", "at.part", "at.lane")
    second = pairs.groupBy("block", "part", "lane").applyInArrow(_regrouped(_link_blocks(like)), LINKED_DDL)
    second = settle(second, "linked")
    edges = first.select("node", "other").unionByName(second.select("node", "other"))
    nodes = sets.select("digest", F.col("rep").alias("node"))
    labels = nodes.join(connected(edges), "node", "left")
    return labels.select("digest", F.coalesce("label", "node").alias("component"))


def _regrouped(link):
    return lambda table: link(table.select(["block", "rep", "digest", "grams", "label"]))


def _link_parts(like: Similarity):
    """The links of a part, and which sets it does not connect to the largest component of the shared sets."""

    def run(table: pa.Table) -> pa.Table:
        rows = dict(zip(table.column("digest").to_pylist(), range(len(table))))
        table = table.take(list(rows.values())).sort_by("digest")
        shared = np.flatnonzero(table.column("label").is_valid().to_numpy())
        sets = [np.frombuffer(grams, U64) for grams in table.column("grams").to_pylist()]
        found = block_components(sets, like)
        stray = np.ones(len(sets), np.int64)
        if len(shared):
            core = block_components([sets[at] for at in shared], like)
            largest = np.bincount(core).argmax()
            stray = (found != found[shared[core == largest][0]]).astype(np.int64)
        linked = _smallest_reps(table, found)
        return linked.append_column("stray", pa.array(stray))

    return run


def one_of_each(documents: DataFrame, like: Similarity) -> DataFrame:
    """The documents that are the smallest of their component, and those without n-grams, with all their columns."""
    dropped = components(documents, like).where("doc_id != component_id")
    return without_rows(documents, dropped)
