"""Near copies among vectors of one label, by cosine, through binary codes learned by iterative quantisation.

Codes. Unit vectors of a bounded sample (``SAMPLE_ROWS`` rows and ``SAMPLE_BYTES``, taken in the order of a hash of the vector)
give principal axes and rotations of these: each starts at random and is improved in turns with the signs that it gives, so
that its planes keep clear of the vectors. A vector's code is the signs of its rotated coordinates. The axes go through the
origin: with the mean taken off, as it is where codes need balance alone, vectors that all lie close to their mean would
get codes of noise. The learned model is all that the sample decides; every vector gets a code and is searched for.

Retrieval. The code is cut into substrings of ``width`` bits, a table each. Vectors that agree in a whole substring, label and
length are candidates. ``width`` grows with the logarithm of the number of vectors, and ``tables`` follows from it: at the
least cosine that links, a share of at most ``MISSED`` of the pairs agrees in no table, if signs differ independently;
closer pairs agree more often. A bucket of more than ``CHUNK`` vectors is dealt to tasks by pairs of its chunks, so no
vector of a bucket goes without its comparison.

Rerank. Candidates are compared by their original vectors in double precision, as matrix products. A pair is counted in
the first table where both agree. A task returns sums of links and a spanning forest, not pairs.

Equal vectors are one class, counted by their number, so copies meet once. Links between classes count all copies.

Defined results: rows with a null label, or a vector that is null, zero, empty or holds null or non-finite components, link
with nothing and are components of their own. Vectors of different lengths do not link. Repeated rows and repeated ids
link like any others. Rows without vec_id take part; the smallest id of a component ignores them, and is null where no row
has one. An empty table gives an empty result. Columns beyond the named ones are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import Batches, with_columns
from tallybook.llm.components import connected, forest
from tallybook.operators.sinks import settle

SAMPLE_ROWS = 10_000
SAMPLE_BYTES = 32 << 20
LEAST_SAMPLE = 64  # vectors of a length that learn; fewer leave the rotation at random
TURNS = 40
MOST_BITS = 64  # of one rotation
LEAST_WIDTH, MOST_WIDTH = 16, 32
OCCUPANCY = 256  # vectors per bucket that the width aims at, over all labels
MISSED = 0.02
CHUNK = 2000
SALTS = 64


def table_shape(vectors: int, cosine: float) -> tuple[int, int]:
    """Bits of a substring, and the number of tables."""
    width = max(LEAST_WIDTH, min(MOST_WIDTH, math.ceil(math.log2(max(vectors, 1) / OCCUPANCY + 1))))
    agree = (1 - math.acos(max(-1.0, min(1.0, cosine))) / math.pi) ** width
    if agree >= 1:
        return width, 1
    return width, max(1, math.ceil(math.log(MISSED) / math.log(1 - agree)))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that no product overflows; cosines stay the same to the bit."""
    _, exponents = np.frexp(np.abs(vectors).max(axis=1, initial=0))
    return np.ldexp(vectors, -exponents[:, None])


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = scaled(vectors)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def iterative_quantisation(rows: np.ndarray, rotation: np.ndarray, turns: int = TURNS) -> np.ndarray:
    """The rotation that brings the rows nearest to their own signs: signs and rotation are improved in turns."""
    for _ in range(turns):
        signs = np.where(rows @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(rows.T @ signs)
        rotation = left @ right
    return rotation


@dataclass(frozen=True)
class Coder:
    """A projection by length of vectors; a length that was not learned has random rotations, drawn alike everywhere."""

    width: int
    tables: int
    learned: dict[int, np.ndarray] = field(default_factory=dict)

    @classmethod
    def learn(cls, sample: list[np.ndarray], width: int, tables: int) -> Coder:
        coder = cls(width, tables)
        by_size: dict[int, list[np.ndarray]] = {}
        for vector in sample:
            by_size.setdefault(len(vector), []).append(vector)
        for size, rows in by_size.items():
            if len(rows) < LEAST_SAMPLE:
                continue
            vectors = unit(np.array(rows, np.float64))
            _, axes = np.linalg.eigh(vectors.T @ vectors)
            axes = axes[:, ::-1][:, : min(size, MOST_BITS)]
            turned = vectors @ axes
            learned = [axes @ iterative_quantisation(turned, start) for start in coder.starts(size)]
            coder.learned[size] = np.concatenate(learned, axis=1)
        return coder

    def starts(self, size: int) -> Iterator[np.ndarray]:
        """Random rotations, as many as give all bits."""
        bits, random = min(size, MOST_BITS), np.random.default_rng(size)
        for _ in range(-(-self.width * self.tables // bits)):
            yield np.linalg.qr(random.normal(size=(bits, bits)))[0]

    def projection(self, size: int) -> np.ndarray:
        if size not in self.learned:
            axes = np.eye(size)[:, : min(size, MOST_BITS)]
            if size > MOST_BITS:
                axes = np.linalg.qr(np.random.default_rng(size + 1).normal(size=(size, MOST_BITS)))[0]
            self.learned[size] = np.concatenate([axes @ start for start in self.starts(size)], axis=1)
        return self.learned[size]

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """The substrings of each row's code, a table per column."""
        bits = unit(vectors) @ self.projection(vectors.shape[1]) >= 0
        bits = bits[:, : self.width * self.tables].reshape(len(vectors), self.tables, self.width)
        return (bits * (1 << np.arange(self.width, dtype=np.int64))).sum(axis=2)


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and vectors of a batch by length."""
    sizes = batch.column("size").to_numpy()
    flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.concatenate(([0], np.cumsum(sizes)))
    for size in np.unique(sizes).tolist():
        places = np.flatnonzero(sizes == size)
        yield places, flat[(ends[places][:, None] + np.arange(size)).ravel()].reshape(len(places), size)


CODES_DDL = "node long, label long, size int, n long, keys array<long>"


def _encode(coder: Coder):
    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.zeros((batch.num_rows, coder.tables), np.int64)
            for places, vectors in _matrices(batch):
                keys[places] = coder.keys(vectors)
            lists = pa.ListArray.from_arrays(np.arange(batch.num_rows + 1, dtype=np.int32) * coder.tables, pa.array(keys.ravel()))
            yield batch.select(["node", "label", "size", "n"]).append_column("keys", lists)

    return run


GROUP = ("label", "size", "table", "bucket", "first", "second")
LINKS = pa.schema([("kind", pa.string()), ("node", pa.int64()), ("other", pa.int64()), ("links", pa.int64())])
LINKS_DDL = "kind string, node long, other long, links long"


@dataclass
class Members:
    """The vectors of a bucket, or of two of its chunks."""

    node: np.ndarray
    n: np.ndarray
    chunk: np.ndarray
    keys: np.ndarray
    vectors: np.ndarray

    @classmethod
    def joined(cls, parts: list[Members]) -> Members:
        names = cls.__dataclass_fields__
        return parts[0] if len(parts) == 1 else cls(*[np.concatenate([getattr(part, name) for part in parts]) for name in names])

    def linked(self, table: int, first: int, second: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
        """Places of pairs that link and agree in this table before any other."""
        vectors = scaled(self.vectors)
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        if first == second:
            left = right = np.arange(len(self.node))
        else:
            left, right = np.flatnonzero(self.chunk == first), np.flatnonzero(self.chunk == second)
        near = vectors[left] @ vectors[right].T >= cosine * np.outer(norms[left], norms[right])
        a, b = np.nonzero(np.triu(near, 1) if first == second else near)
        a, b = left[a], right[b]
        before = (self.keys[a, :table] == self.keys[b, :table]).any(axis=1)
        return a[~before], b[~before]


def _compare(cosine: float):
    """Groups of sorted rows: per vector the copies that it links to, and edges that connect the same vectors."""

    def compared(key: tuple, parts: list[Members], out: list) -> None:
        members = Members.joined(parts)
        if len(members.node) < 2:
            return
        a, b = members.linked(key[2], key[4], key[5], cosine)
        if not len(a):
            return
        links = np.bincount(a, weights=members.n[b], minlength=len(members.node))
        links += np.bincount(b, weights=members.n[a], minlength=len(members.node))
        found = np.flatnonzero(links)
        child, parent = forest(members.node[a], members.node[b])
        out.append(("count", members.node[found], None, links[found].astype(np.int64)))
        out.append(("edge", child, parent, None))

    def rows(out: list) -> pa.RecordBatch:
        kinds = np.repeat([kind for kind, *_ in out], [len(node) for _, node, *_ in out]) if out else []
        columns = [pa.array(kinds, pa.string())]
        for at in (1, 2, 3):
            parts = [pa.array(row[at], pa.int64()) if row[at] is not None else pa.nulls(len(row[1]), pa.int64()) for row in out]
            columns.append(pa.concat_arrays(parts) if parts else pa.array([], pa.int64()))
        return pa.RecordBatch.from_arrays(columns, schema=LINKS)

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        key, parts = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            out: list = []
            keys = np.stack([batch.column(name).to_numpy().astype(np.int64) for name in GROUP], axis=1)
            starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
            flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            codes = batch.column("keys").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            node, n, chunk = (batch.column(name).to_numpy() for name in ("node", "n", "chunk"))
            ends = np.concatenate(([0], np.cumsum(keys[:, 1])))
            for start, end in zip(starts, [*starts[1:], len(keys)]):
                own = tuple(keys[start].tolist())
                if own != key:
                    if parts:
                        compared(key, parts, out)
                    key, parts = own, []
                rows_ = slice(start, end)
                vectors = flat[ends[start] : ends[end]].reshape(end - start, own[1])
                parts.append(Members(node[rows_], n[rows_], chunk[rows_], codes[rows_], vectors))
            if out:
                yield rows(out)
        out = []
        if parts:
            compared(key, parts, out)
        if out:
            yield rows(out)

    return run


def _sample(classes: DataFrame) -> list[np.ndarray]:
    """A bounded number of vectors, the same for the same table."""
    longest = classes.agg(F.max("size")).first()[0] or 1
    rows = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * longest)))
    sample = classes.select("embedding", "h1", "h2").orderBy("h1", "h2").limit(rows).toArrow()
    return [np.array(vector, np.float64) for vector in sample.column("embedding").to_pylist()]


def near_copies(embeddings: DataFrame, cosine: float = 0.98, chunk: int = CHUNK) -> DataFrame:
    """Per row: ``vec_id, n_links, component_id, kept``."""
    wide = dict(embeddings.dtypes).get("embedding") != "array<float>"
    rows = with_columns(embeddings, vec_id="long", embedding="array<double>" if wide else "array<float>", label="long")
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    valid = F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~odd & some
    rows = rows.withColumns({"valid": F.coalesce(valid, F.lit(False)), "h1": F.xxhash64("embedding"), "h2": F.xxhash64(F.lit(1), "embedding")})
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    # a row's salt is stored, as the rows of one vector may have no id that would spread them
    short = settle(rows.select("vec_id", "label", "h1", "h2", "valid", salt.alias("salt")), "rows")

    key = ["label", "h1", "h2"]
    counts = short.where("valid").groupBy(*key).agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"), F.bit_or(F.expr("shiftleft(1L, salt)")).alias("salts")
    )
    vectors = rows.where("valid").select(*key, "embedding").distinct()
    classes = vectors.join(counts, key).withColumn("size", F.size("embedding"))
    classes = settle(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    links = _links(classes, cosine, chunk)

    linked = links.where("kind = 'count'").groupBy("node").agg(F.sum("links").alias("links"))
    labels = connected(links.where("kind = 'edge'").select("node", "other")).withColumnRenamed("label", "component")
    found = classes.select("node", *key, "least", "n", "salts").join(linked, "node", "left").join(labels, "node", "left")
    found = settle(found.withColumn("component", F.coalesce("component", "node")), "components")

    # the smallest id of a component, which its classes look up by salt, those in use
    own_salt = F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")
    members = found.withColumn("salt", own_salt)
    lowest = members.groupBy("component").agg(F.min("least").alias("component_id"), F.bit_or(F.expr("shiftleft(1L, salt)")).alias("used"))
    lowest = lowest.select("component", "component_id", _in_use("used").alias("salt"))
    result = members.join(lowest, ["component", "salt"]).select(
        *key, (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id", _in_use("salts").alias("salt")
    )
    of_valid = short.where("valid").join(result, [*key, "salt"]).select("vec_id", "n_links", "component_id")
    others = short.where("not valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = of_valid.unionByName(others)
    return every.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _in_use(bits: str):
    return F.explode(F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda salt: F.getbit(F.col(bits), salt) == 1))


def _links(classes: DataFrame, cosine: float, chunk: int) -> DataFrame:
    """``LINKS`` rows: copies linked per class and task, and edges."""
    coder = Coder.learn(_sample(classes), *table_shape(classes.count(), cosine))
    codes = classes.select("node", "label", "size", "n", "embedding").mapInArrow(_encode(coder), CODES_DDL)
    codes = settle(codes, "codes")
    place = ["label", "size", "table", "bucket"]
    dealt = codes.select("node", "label", "size", F.posexplode("keys").alias("table", "bucket"))
    buckets = dealt.groupBy(*place).agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    chunks = F.ceil(F.col("held") / chunk).cast("int")
    own = F.pmod(F.xxhash64("node", "table"), F.col("chunks")).cast("int")
    members = dealt.join(buckets, place).withColumn("chunks", chunks).withColumn("chunk", own)
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda other: F.struct(F.least("chunk", other).alias("first"), F.greatest("chunk", other).alias("second")),
    )
    members = members.select("node", *place, "chunk", F.inline(pairs))
    members = members.join(codes.select("node", "n", "keys"), "node").join(classes.select("node", "embedding"), "node")
    ordered = members.repartition(*GROUP).sortWithinPartitions(*GROUP)
    return settle(ordered.mapInArrow(_compare(cosine), LINKS_DDL), "links", "kind")
