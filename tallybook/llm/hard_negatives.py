"""Hard negatives of anchors by inner product, through R-trees packed by sort-tile-recursive order.

Trees. The rows are sorted by ranges of (label, length, first two coordinates) and cut into trees of one label and at most
``TREE_ROWS`` rows. Within a tree, rows are sorted and tiled coordinate by coordinate, those of the widest spread first,
into leaves of ``LEAF`` rows; ``FAN`` consecutive boxes make one of the next level. The minimum bounding box of a node gives
an interval for each coordinate's product with the anchor, and the sum of these an interval for the inner product.

Search. For an anchor, a window of scores and a number k, a queue gives the box that can hold the greatest score within the
window first. Boxes whose interval lies outside the window never enter it; the search ends when the box ahead is strictly
below the kth score found, since one that equals it may hold a smaller id. So each tree gives its exact first k.

Two rounds. Anchors are packed too, ``PACK_ROWS`` of one label at a time. A pack meets the trees of its own label for the
positives, then the trees of all other labels with the windows that follow from these. Every tree and ``LANE`` packs are one
group of bounded size; the first k of all trees are merged per anchor by a ranked window that cuts before it shuffles. All
anchors meet all rows that can count, block by block: in many dimensions the boxes of spread data prune little.

Defined results: rows with a null vec_id, label or vector, or with null or non-finite components, take no part. Vectors of
different lengths do not meet. Other rows are those of another vec_id. Rows that repeat a vec_id all take part, an anchor
that is repeated gives its rows as often. Components beyond 2^62 count as 2^62, scores beyond a long as the greatest or
least long. An empty table gives an empty result; columns beyond the named ones are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.common import Batches, with_columns
from tallybook.operators.sinks import settle

# Fixed values of the task.
SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW_SHARE, HIGH_SHARE, WHOLE = 30, 90, 100

TREE_ROWS, PACK_ROWS, LANE = 16384, 1024, 64
BLOCK_BYTES = 16 << 20  # of one tree or pack, whatever the length of its vectors
LEAF, FAN = 256, 8
AT_ONCE = 128  # anchors of a pack that share the scores of a leaf
EXACT = 1 << 53
LIMIT = 1 << 62
LONGEST = (1 << 63) - 1

BLOCKS = pa.schema(
    [("block", pa.int64()), ("label", pa.int64()), ("size", pa.int32()), ("ids", pa.binary()), ("rows", pa.binary())]
)
BLOCKS_DDL = "block long, label long, size int, ids binary, rows binary"


def tile(rows: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Sort-tile-recursive order of rows: consecutive runs of ``leaf`` make the boxes."""
    leaves = -(-len(rows) // leaf)
    ways = max(1, min(rows.shape[1], int(np.ceil(np.log2(max(leaves, 1))))))
    by_spread = np.argsort(-rows.astype(np.float64).var(axis=0), kind="stable")[:ways].tolist() if rows.size else []

    def tiled(places: np.ndarray, coordinates: list[int]) -> list[np.ndarray]:
        if not coordinates or len(places) <= leaf:
            return [places]
        places = places[np.argsort(rows[places, coordinates[0]], kind="stable")]
        pages = -(-len(places) // leaf)
        slabs = max(1, int(np.ceil(pages ** (1 / len(coordinates)) - 1e-9)))
        each = -(-pages // slabs) * leaf
        return [part for at in range(0, len(places), each) for part in tiled(places[at : at + each], coordinates[1:])]

    return np.concatenate(tiled(np.arange(len(rows)), by_spread))


class Tree:
    """Rows in tiled order and the boxes of every level, leaves first."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        starts = np.arange(0, len(rows), LEAF)
        low = np.minimum.reduceat(rows, starts, axis=0)
        high = np.maximum.reduceat(rows, starts, axis=0)
        self.levels = [(low, high)]
        while len(self.levels[-1][0]) > 1:
            low, high = self.levels[-1]
            starts = np.arange(0, len(low), FAN)
            self.levels.append((np.minimum.reduceat(low, starts, axis=0), np.maximum.reduceat(high, starts, axis=0)))


def products(*pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Exact inner products of integer rows, summed over the pairs of matrices, within a long."""
    most = sum(_most(left) * _most(right) * max(1, left.shape[1]) for left, right in pairs)
    if most < EXACT:
        sums = sum(left.astype(np.float64) @ right.astype(np.float64).T for left, right in pairs)
        return np.rint(sums).astype(np.int64)
    sums = sum(left.astype(object) @ right.astype(object).T for left, right in pairs)
    return np.clip(sums, -LONGEST - 1, LONGEST).astype(np.int64)


def _most(rows: np.ndarray) -> int:
    return int(np.abs(rows).max(initial=0))


class Search:
    """A few anchors against one tree; the scores of a leaf are taken for all of them when the first one needs it."""

    def __init__(self, tree: Tree, anchors: np.ndarray):
        self.tree, self.anchors = tree, anchors
        above, below = np.maximum(anchors, 0), np.minimum(anchors, 0)
        self.bounds = []
        for low, high in tree.levels:
            self.bounds.append((products((above, low), (below, high)), products((above, high), (below, low))))
        self.leaves: dict[int, np.ndarray] = {}

    def scores(self, anchor: int, leaf: int) -> np.ndarray:
        if leaf not in self.leaves:
            self.leaves[leaf] = products((self.anchors, self.tree.rows[leaf * LEAF : (leaf + 1) * LEAF]))
        return self.leaves[leaf][anchor]

    def first(self, anchor: int, own_id: int, low: int, high: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the first k rows in the window, none of them with the anchor's id."""
        scores, ids = np.empty(0, np.int64), np.empty(0, np.int64)
        if low > high:
            return scores, ids
        queue: list[tuple[int, int, int]] = []

        def offer(level: int, nodes: range) -> None:
            lower, upper = self.bounds[level]
            for node in nodes:
                most = int(upper[anchor, node])
                if most >= low and lower[anchor, node] <= high:
                    heapq.heappush(queue, (-min(most, high), level, node))

        offer(len(self.bounds) - 1, range(1))
        while queue:
            most, level, node = heapq.heappop(queue)
            if len(scores) == k and -most < scores[-1]:
                break
            if level:
                width = len(self.tree.levels[level - 1][0])
                offer(level - 1, range(node * FAN, min((node + 1) * FAN, width)))
                continue
            found = self.scores(anchor, node)
            least = max(low, int(scores[-1])) if len(scores) == k else low
            at = np.flatnonzero((found >= least) & (found <= high))
            if not len(at):
                continue
            found_ids = self.tree.ids[node * LEAF + at]
            other = found_ids != own_id
            scores = np.concatenate((scores, found[at][other]))
            ids = np.concatenate((ids, found_ids[other]))
            order = np.lexsort((ids, ~scores))[:k]  # ~x falls as x grows, without the overflow of -x
            scores, ids = scores[order], ids[order]
        return scores, ids


def window(positive: int) -> tuple[int, int]:
    """Least and greatest score of a negative: LOW_SHARE * p <= WHOLE * n <= HIGH_SHARE * p."""
    return -(-LOW_SHARE * positive // WHOLE), HIGH_SHARE * positive // WHOLE


def _blocks(most_rows: int, tiled: bool) -> Callable[[Batches], Iterator[pa.RecordBatch]]:
    """Rows sorted by label and length as blocks of one label and length."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        key, ids, parts = None, [], []

        def block() -> pa.RecordBatch:
            nonlocal number
            rows, own = np.concatenate(parts), np.concatenate(ids)
            if tiled:
                order = tile(rows)
                rows, own = rows[order], own[order]
            fits = np.abs(rows).max(initial=0) < 1 << 31
            data = rows.astype(np.int32 if fits else np.int64).tobytes()
            columns = [[number], [key[0]], [key[1]], [own.tobytes()], [data]]
            number += 1
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, BLOCKS)], schema=BLOCKS)

        for batch in batches:
            vectors = batch.column("embedding")
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            ends = np.concatenate(([0], np.cumsum(batch.column("size").to_numpy())))
            quantised = np.clip(np.floor(SCALE * flat.astype(np.float64)), -LIMIT, LIMIT).astype(np.int64)
            own, at = batch.column("vec_id").to_numpy(), 0
            keys = list(zip(batch.column("label").to_pylist(), batch.column("size").to_pylist()))
            while at < len(keys):
                if keys[at] != key:
                    if parts:
                        yield block()
                    key, ids, parts = keys[at], [], []
                room = max(1, min(most_rows, BLOCK_BYTES // (8 * max(1, key[1])))) - sum(map(len, ids))
                upto = at
                while upto < len(keys) and upto - at < room and keys[upto] == key:
                    upto += 1
                ids.append(own[at:upto])
                parts.append(quantised[ends[at] : ends[upto]].reshape(upto - at, key[1]))
                if upto - at == room:
                    yield block()
                    ids, parts = [], []
                at = upto
        if parts:
            yield block()

    return run


def _opened(table: pa.Table, at: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(table.column("ids")[at].as_py(), np.int64)
    data = table.column("rows")[at].as_py()
    size = table.column("size")[at].as_py()
    kind = np.int32 if len(data) == 4 * size * len(ids) else np.int64
    return ids, np.frombuffer(data, kind).reshape(len(ids), size)


def _meet(trees: DataFrame, packs: DataFrame, on: list[str], run, ddl: str) -> DataFrame:
    """Every pack with every tree that agrees in ``on``: groups of one tree and ``LANE`` packs, evenly dealt."""
    spark = trees.sparkSession
    own = Window.partitionBy(*on).orderBy("block")
    # these two hold a row per block, without its data
    tree_places = trees.select("block", *on, (F.row_number().over(own) - 1).alias("tree"))
    lanes = packs.select("block", *on, F.floor((F.row_number().over(own) - 1) / LANE).cast("int").alias("lane"))
    tree_places, lanes = settle(tree_places, "trees"), settle(lanes, "lanes")
    tree_counts = tree_places.groupBy(*on).agg(F.count(F.lit(1)).cast("int").alias("trees"))
    lane_counts = lanes.groupBy(*on).agg((F.max("lane") + 1).alias("lanes"))
    groups = tree_counts.join(lane_counts, on).agg(F.sum(F.col("trees").cast("long") * F.col("lanes"))).first()[0] or 0
    number = int(groups) if groups <= 2000 else max(2000, int(groups) // 8)

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    key = [*on, "tree", "lane"]
    left = tree_places.join(lane_counts, on).select("block", "tree", every("lanes").alias("lane"))
    left = trees.join(left, "block").repartition(max(1, number), *key)
    right = lanes.join(tree_counts, on).select("block", "lane", every("trees").alias("tree"))
    right = packs.join(right, "block").repartition(max(1, number), *key)
    if not groups:
        return spark.createDataFrame([], ddl)
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, ddl)


FOUND_DDL = "pack long, at int, place int, score long, vec_id long"
FOUND_NAMES = ("pack", "at", "place", "score", "vec_id")
FOUND_TYPES = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())


def _found(rows: list[tuple]) -> pa.Table:
    """(pack, at, place, scores, ids) entries as one row per score."""
    sizes = [len(row[3]) for row in rows]
    columns = [np.repeat([row[at] for row in rows], sizes) if rows else [] for at in range(3)]
    columns += [np.concatenate([row[at] for row in rows]) if rows else [] for at in (3, 4)]
    return pa.table([pa.array(c, kind) for c, kind in zip(columns, FOUND_TYPES)], names=FOUND_NAMES)


def _positives(left: pa.Table, right: pa.Table) -> pa.Table:
    rows = []
    if len(left):
        tree = Tree(*_opened(left, 0))
        for at in range(len(right)):
            ids, anchors = _opened(right, at)
            pack = right.column("block")[at].as_py()
            for begin in range(0, len(ids), AT_ONCE):
                search = Search(tree, anchors[begin : begin + AT_ONCE])
                for own in range(begin, min(begin + AT_ONCE, len(ids))):
                    first = search.first(own - begin, int(ids[own]), -LONGEST - 1, LONGEST, POSITIVES)
                    rows.append((pack, own, 0, *first))
    return _found(rows)


def _negatives(left: pa.Table, right: pa.Table) -> pa.Table:
    rows = []
    if len(left):
        tree, label = Tree(*_opened(left, 0)), left.column("label")[0].as_py()
        for at in range(len(right)):
            if right.column("label")[at].as_py() == label:
                continue
            ids, anchors = _opened(right, at)
            pack = right.column("block")[at].as_py()
            asked: dict[int, list[tuple[int, int]]] = {}
            for entry in right.column("positives")[at].as_py():
                asked.setdefault(entry["at"], []).append((entry["place"], entry["score"]))
            for begin in range(0, len(ids), AT_ONCE):
                search = Search(tree, anchors[begin : begin + AT_ONCE])
                for own in range(begin, min(begin + AT_ONCE, len(ids))):
                    for place, score in asked.get(own, ()):
                        first = search.first(own - begin, int(ids[own]), *window(score), NEGATIVES)
                        rows.append((pack, own, place, *first))
    return _found(rows)


def _ranked(found: DataFrame, key: list[str], most: int) -> DataFrame:
    """The first rows of each key over all trees."""
    best = Window.partitionBy(*key).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)


def participants(embeddings: DataFrame) -> DataFrame:
    """``vec_id, label, embedding, size`` of the rows that take part."""
    rows = with_columns(embeddings, vec_id="long", embedding="array<double>", label="long")
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where("vec_id is not null and label is not null and embedding is not null").where(~odd)
    return rows.withColumn("size", F.size("embedding"))


def relabelled(rows: DataFrame) -> DataFrame:
    """Rows whose vec_id is divisible by 7 get the next label of ten."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rows.withColumn("label", label)


def _sorted(rows: DataFrame) -> DataFrame:
    order = ["label", "size", F.get("embedding", F.lit(0)), F.get("embedding", F.lit(1))]
    # equal vectors are dealt by id; the order within a task is that of the ranges
    ranges = rows.repartitionByRange(*order, F.xxhash64("vec_id"))
    return ranges.sortWithinPartitions(*order, F.xxhash64("vec_id"), "vec_id").select("vec_id", "label", "size", "embedding")


def hard_negatives(rows: DataFrame, anchors: Column, tree_rows: int = TREE_ROWS, pack_rows: int = PACK_ROWS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows that are ``anchors``.

    ``rows`` come from ``participants``; ``anchors`` is a condition on them.
    """
    trees = settle(_sorted(rows).mapInArrow(_blocks(tree_rows, True), BLOCKS_DDL), "trees")
    packs = settle(_sorted(rows.where(anchors)).mapInArrow(_blocks(pack_rows, False), BLOCKS_DDL), "packs")

    found = _meet(trees, packs, ["label", "size"], _positives, FOUND_DDL)
    positives = _ranked(found, ["pack", "at"], POSITIVES)
    positives = settle(positives.select("pack", "at", F.col("rank").alias("place"), "score", "vec_id"), "positives")
    # at most POSITIVES entries for each of the anchors of a pack
    asked = positives.groupBy("pack").agg(F.collect_list(F.struct("at", "place", "score")).alias("positives"))
    asking = settle(packs.join(asked.withColumnRenamed("pack", "block"), "block"), "asking")

    found = _meet(trees, asking, ["size"], _negatives, FOUND_DDL)
    negatives = _ranked(found, ["pack", "at", "place"], NEGATIVES)
    ids = packs.mapInArrow(_ids, "pack long, at int, anchor_id long")
    named = positives.select("pack", "at", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = named.join(ids, ["pack", "at"])
    return negatives.join(named, ["pack", "at", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def _ids(batches: Batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, data in zip(batch.column("block").to_pylist(), batch.column("ids").to_pylist()):
            ids = np.frombuffer(data, np.int64)
            columns = [pa.array([block] * len(ids), pa.int64()), pa.array(np.arange(len(ids)), pa.int32()), pa.array(ids)]
            yield pa.RecordBatch.from_arrays(columns, ["pack", "at", "anchor_id"])
