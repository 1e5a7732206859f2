"""Best-fit packing of token pieces into sequences, in rounds over a tree of groups.

Every document is encoded once and cut into pieces, which are numbered. A round deals its items, at first the pieces, to
groups of about ``GROUP_ITEMS``; each group packs its items best-fit, largest first. Bins with at most ``slack`` free places
are final. Underfull bins go on to the next round, in which up to ``FAN_IN`` groups are merged: those at most half full as
single items, those that hardly anything fits beside by their pieces. Small items fill what others leave, so each group
keeps back its smallest ones, ``HELD_SHARE`` of its tokens, until the last round, which packs all that is left. The last
round comes when one group is left, or when a round has closed less than a tenth of its items; its groups hold at most
``FAN_IN`` times ``GROUP_ITEMS`` items, so no task ever holds more.

Defined results: a null or empty text is one piece, the end id alone. Repeated rows and repeated ids are packed as often
as they occur, dealt to groups by their numbers. A null id stays null. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import BATCH_BYTES, Batches, released, slices, with_columns
from tallybook.llm.tokens import encoder
from tallybook.operators.sinks import settle

CAPACITY = 4096
END_ID = 1
SLACK = 16
GROUP_ITEMS = 5000
FAN_IN = 8
HELD_SHARE = 0.1
STALLED = 0.9

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = f"{PIECES}, row long, item long, offset long, open boolean"

# A sequence id holds the round, the group and the place of the bin in its group.
GROUP_BITS, BIN_BITS = 31, 26


def pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Each document as ids and an end id, cut after every ``capacity`` ids."""

    def cut(batches: Batches) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        end = end_id.to_bytes(4, "little")
        for batch in slices(batches, BATCH_BYTES):
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = encode(text or "") + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) or [()] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return with_columns(documents, doc_id="long", text="string").mapInArrow(released(cut), PIECES)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and how full each bin is: largest item first, into the fullest bin that has room.

    ``room`` has a bit for each number of free places that some open bin has, so that the fullest bin with room for an
    item is found by one shift.
    """
    place = np.empty(len(sizes), np.int64)
    offset = np.empty(len(sizes), np.int64)
    filled: list[int] = []
    bins_by_room: dict[int, list[int]] = {}
    room = 0
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = room >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            bins = bins_by_room[free]
            chosen = bins.pop()
            if not bins:
                room ^= 1 << free
        else:
            free, chosen = capacity, len(filled)
            filled.append(0)
        place[item], offset[item] = chosen, capacity - free
        free -= size
        filled[chosen] = capacity - free
        if free:
            bins_by_room.setdefault(free, []).append(chosen)
            room |= 1 << free
    return place, offset, np.array(filled, np.int64)


def pack(parts: DataFrame, capacity: int = CAPACITY, slack: int = SLACK, group_items: int = GROUP_ITEMS) -> DataFrame:
    """``PIECES`` rows with ``sequence_id`` and ``offset``; parts are written to the shared folder round by round.

    An item is a bin of earlier rounds or, with a negative number, a piece by itself.
    """
    todo = settle(parts.withColumn("row", F.monotonically_increasing_id()), "pieces")
    todo = todo.withColumns({"item": -1 - F.col("row"), "offset": F.lit(0).cast("long")})
    items = todo.count()
    groups, stalled, step = _groups(items, group_items), False, 0
    done: DataFrame | None = None
    while True:
        last = groups == 1 or stalled
        packed = todo.withColumn("part", F.pmod(F.xxhash64("item", F.lit(step)), F.lit(groups)))
        packed = packed.groupBy("part").applyInPandas(_packer(step, capacity, slack, last), PLACED)
        packed = settle(packed, "packed", "open")
        closed = packed.where(~F.col("open"))
        done = closed if done is None else done.unionByName(closed)
        if last:
            break
        todo = packed.where("open").drop("open")
        left = todo.where("offset = 0").count()
        stalled = left > STALLED * items
        merged = _groups(left, FAN_IN * group_items) if stalled else _groups(left, group_items)
        groups, items, step = merged if stalled else max(-(-groups // FAN_IN), merged), left, step + 1
    return done.withColumnRenamed("item", "sequence_id").drop("open", "row")


def _groups(items: int, group_items: int) -> int:
    return max(1, -(-items // group_items))


def _packer(step: int, capacity: int, slack: int, last: bool):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        group = int(frame.pop("part").iloc[0])
        frame = frame.sort_values(["item", "offset"], kind="stable").reset_index(drop=True)
        ids = frame["item"].to_numpy(np.int64)
        number = np.cumsum(np.append(True, ids[1:] != ids[:-1])) - 1
        sizes = np.bincount(number, weights=frame["length"].to_numpy()).astype(np.int64)
        held = np.zeros(len(sizes), bool)
        if not last:
            smallest = np.argsort(sizes, kind="stable")
            held[smallest[np.cumsum(sizes[smallest]) <= HELD_SHARE * sizes.sum()]] = True
        packing = np.flatnonzero(~held)
        bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        bins[packing], offsets[packing], filled = best_fit(sizes[packing], capacity)
        waits = held[number]
        full = filled[bins[number]]
        is_open = waits | (full < capacity - slack) & (not last)
        by_piece = is_open & ~waits & (2 * full > capacity)
        placed = ((step << GROUP_BITS | group) << BIN_BITS) + bins[number]
        frame["item"] = np.where(waits, ids, np.where(by_piece, -1 - frame["row"].to_numpy(np.int64), placed))
        frame["offset"] = np.where(by_piece, 0, frame["offset"].to_numpy(np.int64) + np.where(waits, 0, offsets[number]))
        frame["open"] = is_open
        return frame

    return run


def packed_documents(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """All documents packed: one row per piece, with its sequence and its place there."""
    return pack(pieces(documents, tokenizer, capacity, end_id), capacity)
