"""Exact duplicates of texts, combined in three stages so that no group of copies meets in one task.

1. Each task combines the equal texts it reads (the map side of the first aggregate).
2. Those partial groups are merged per digest and salt; a group of any size is spread over ``SALTS`` keys.
3. The winners of the salts, at most ``SALTS`` rows per text, are merged into the class.

The whole normalised text is a grouping key in each stage, so texts are compared, not digests alone. Documents find
their class through (digest, salt), the way back down the same tree; where texts of one digest differ, which the query
checks, the text joins them as well. What stays is the row with the most code points, then the smallest doc_id.

Defined results: a null text counts as empty, and texts of blanks alone equal the empty one. Repeated rows count as
copies. A row without doc_id loses every tie, and is kept only where no row with an id is as long; its class then has a
null ``keep_id``. Rows that repeat the kept doc_id with an equal text are all marked kept, since the id names the row.
An empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import BLANKS, text_key, with_columns, without_rows
from tallybook.operators.sinks import settle

SALTS = 64

Digest = Callable[[Column], Column]

# A class is ranked by one number, code points first: decimals are combined in place, structures are not.
ID_ROOM = Decimal(1 << 64)


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def normalised(text: Column) -> Column:
    """The text without any of the six blanks."""
    for blank in BLANKS.decode():
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def _rank(points: Column, doc_id: Column) -> Column:
    """Greater is better; the second part is 0 without an id, else 2^63 - doc_id, from 1 to 2^64."""
    tie = F.coalesce(F.lit(ID_ROOM // 2) - doc_id.cast("decimal(20,0)"), F.lit(0))
    return (points.cast("decimal(12,0)") * F.lit(2 * ID_ROOM) + tie).cast("decimal(38,0)")


def _id_of(rank: Column) -> Column:
    tie = rank % F.lit(2 * ID_ROOM)
    return F.when(tie > 0, (F.lit(ID_ROOM // 2) - tie).cast("long"))


def _prepared(documents: DataFrame, digest: Digest) -> DataFrame:
    rows = with_columns(documents, doc_id="long", text="string")
    text = F.coalesce(F.col("text"), F.lit(""))
    points = F.char_length(text).alias("points")
    rows = rows.select("doc_id", normalised(text).alias("norm"), points, text_key().alias("text_key"))
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    return rows.select(
        "doc_id", "norm", "points", "text_key", digest(F.col("norm")).alias("digest"), salt.alias("salt")
    )


def _classes(rows: DataFrame) -> DataFrame:
    """One row per text: digest, norm, copies, rank of the best row, and the salts it was spread over as bits."""
    salted = rows.groupBy("digest", "salt", "norm").agg(
        F.count(F.lit(1)).alias("copies"), F.max(_rank(F.col("points"), F.col("doc_id"))).alias("rank")
    )
    bit = F.expr("shiftleft(1L, salt)")
    return salted.groupBy("digest", "norm").agg(
        F.sum("copies").alias("copies"), F.max("rank").alias("rank"), F.bit_or(bit).alias("salts")
    )


def exact_duplicates(documents: DataFrame, digest: Digest = sha256) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``, and ``text_key`` of the original text.

    ``digest`` only routes rows; a poor one costs time and gives the same result.
    """
    rows = _prepared(documents, digest)
    classes = settle(_classes(rows).drop("norm"), "classes")
    mixed = settle(classes.groupBy("digest").count().where("count > 1").select("digest"), "mixed")
    if mixed.isEmpty():
        return _joined(rows, classes, "digest", "salt")
    routed = rows.join(mixed, "digest", "left_semi")
    single = _joined(rows.join(mixed, "digest", "left_anti"), classes.join(mixed, "digest", "left_anti"), "digest", "salt")
    return single.unionByName(_joined(routed, _classes(routed), "digest", "salt", "norm"))


def _joined(rows: DataFrame, classes: DataFrame, *key: str) -> DataFrame:
    salts = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda salt: F.getbit(F.col("salts"), salt) == 1)
    spread = classes.withColumn("salt", F.explode(salts)).select(
        *key, _id_of(F.col("rank")).alias("keep_id"), F.col("copies").alias("group_size")
    )
    rows = rows.withColumn("text_sha256", sha256(F.col("norm")))
    wanted = dict.fromkeys([*key, "doc_id", "text_sha256", "text_key"])
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    joined = rows.select(*wanted).join(spread, list(key))
    return joined.select("doc_id", "keep_id", "group_size", kept, "text_sha256", "text_key")


def deduplicated(documents: DataFrame) -> DataFrame:
    """The documents without the dropped copies, with all their columns. Of wholly equal rows one stays."""
    verdicts = settle(exact_duplicates(documents), "verdicts")
    kept = without_rows(documents, verdicts.where("not kept"))
    again = verdicts.where("kept and doc_id is not null").groupBy("doc_id", "text_key").count().where("count > 1")
    again = settle(again.select("doc_id", "text_key"), "again")
    if again.isEmpty():
        return kept
    key = [documents["doc_id"] == again["doc_id"], text_key() == again["text_key"]]
    return without_rows(kept, again).unionByName(kept.join(again, key, "left_semi").dropDuplicates(["doc_id", "text"]))
