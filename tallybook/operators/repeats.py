"""First occurrence wins: find later records with a key seen before; null parts of a key are equal.

A window over the key would collect a whole group in one task, and one key may hold a third of all records.
So the first record per key comes from an aggregate, which combines before its shuffle, and is joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.operators.sinks import settle

# Keys with the most copies, joined by broadcast: no other key can hold more than 1/HOT_KEYS of the records.
# The length limit bounds the broadcast to about a megabyte; a longer key stays in the shuffled join.
HOT_KEYS = 1000
HOT_KEY_BYTES = 1000

# All repeated keys are broadcast when their measured size stays below both bounds.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 << 20

# More repeated keys are broadcast as bits of their hashes, 16 per key and at most these (32 MB); beyond half as many keys
# as bits, most records would hit one by chance.
BITS_PER_KEY = 16
MOST_BITS = 1 << 28


def repeated_keys(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """Keys of more than one record, with the first record (``first_ord``) and the number of ``copies``.

    Null parts of a key are equal to each other. Only records without a ``reason`` count. The others are not filtered
    out, which would make Spark evaluate the rules inside a filter once more, but share one group that counts nothing.
    """
    counts = F.col("reason").isNull()
    keys = [F.when(counts, F.col(name)).alias(name) for name in key]
    rows = df.select(*keys, (~counts).alias("_rejected"), F.when(counts, F.col(order)).alias(order))
    groups = rows.groupBy(*key, "_rejected").agg(F.min(order).alias("first_ord"), F.count(order).alias("copies"))
    return groups.where(F.col("copies") > 1).drop("_rejected")


def mark_repeats(df: DataFrame, key: Sequence[str], order: str, measure: bool = False) -> DataFrame:
    """Add ``first_ord`` to records that repeat an earlier one; null for all others.

    Only records whose ``reason`` is null take part. With ``measure`` the repeated keys are stored and counted
    first: as long as they are few, which is the rule for ledgers, the records themselves are not shuffled; if they are
    many, only records that may have such a key are (``_join_by_bitmap``).
    """
    repeated = repeated_keys(df, key, order)
    if not measure:
        return _join_by_shuffle(df, key, order, repeated)
    repeated = settle(repeated, "keys")
    size = repeated.agg(F.count(F.lit(1)).alias("rows"), F.sum(_key_bytes(key)).alias("bytes")).first()
    if size.rows <= BROADCAST_ROWS and (size.bytes or 0) <= BROADCAST_BYTES:
        return _join_by_broadcast(df, key, order, repeated)
    if size.rows <= MOST_BITS // 2:
        return _join_by_bitmap(df, key, order, repeated, size.rows)
    return _join_by_shuffle(df, key, order, repeated)


def mark_repeats_by_bitmap(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """``mark_repeats`` for a table with many repeated keys among far more records."""
    repeated = settle(repeated_keys(df, key, order), "keys")
    return _join_by_bitmap(df, key, order, repeated, repeated.count())


def _join_by_bitmap(df: DataFrame, key: Sequence[str], order: str, repeated: DataFrame, keys: int) -> DataFrame:
    """Shuffle only the records whose key has its bit set among those of the repeated keys.

    A bit that is set by the hash of another key costs a shuffled record, no more. The other records are read a second
    time instead, which needs no order or exchange.
    """
    bits = 1 << min(max(15, (BITS_PER_KEY * max(keys, 1) - 1).bit_length()), MOST_BITS.bit_length() - 1)
    place = F.pmod(F.xxhash64(*key), F.lit(bits))
    places = repeated.select(place.alias("_place"))
    maps = places.groupBy(F.bitmap_bucket_number("_place").alias("_bucket"))
    maps = maps.agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits"))
    rows = df.withColumn("_place", F.when(F.col("reason").isNull(), place))
    rows = rows.join(F.broadcast(maps), F.bitmap_bucket_number("_place") == F.col("_bucket"), "left")
    position = F.bitmap_bit_position("_place")
    byte = F.substring("_bits", (F.floor(position / 8) + 1).cast("int"), F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (position % 8).cast("int"))
    rows = rows.withColumn("_may_repeat", F.coalesce(bit == 1, F.lit(False)))
    may = rows.where("_may_repeat").select(*df.columns)
    cannot = rows.where("not _may_repeat").select(*df.columns)
    marked = _join_by_shuffle(may, key, order, repeated)
    return marked.unionByName(cannot.withColumn("first_ord", F.lit(None).cast(marked.schema["first_ord"].dataType)))


def _join_by_broadcast(df: DataFrame, key: Sequence[str], order: str, repeated: DataFrame) -> DataFrame:
    firsts = F.broadcast(_renamed(repeated, key, "_key_"))
    rows = df.join(firsts, _same_key(key, "_key_") & F.col("reason").isNull(), "left")
    return _with_first(rows, df.columns, order, F.col("_key_first"))


def _join_by_shuffle(df: DataFrame, key: Sequence[str], order: str, repeated: DataFrame) -> DataFrame:
    takes_part = F.col("reason").isNull()
    # the length test stays above the limit, so that both sides share one aggregation
    short = _key_bytes(key) <= HOT_KEY_BYTES
    hot = repeated.orderBy(F.when(short, F.col("copies")).desc_nulls_last()).limit(HOT_KEYS).where(short)
    rows = df.join(F.broadcast(_renamed(hot, key, "_hot_")), _same_key(key, "_hot_") & takes_part, "left")

    # Records that need no match (rejected, or settled by the hot keys) get a slot of their own, so that the
    # shuffle spreads them. The slot of the other side is always 0, written so that it stays a join key.
    slot = F.when(takes_part & F.col("_hot_first").isNull(), F.lit(0).cast("bigint")).otherwise(F.xxhash64(order))
    rest = _renamed(repeated, key, "_key_", F.pmod("copies", F.lit(1)).cast("bigint").alias("_key_slot"))
    same = _same_key(key, "_key_") & (F.col("_slot") == F.col("_key_slot"))
    rows = rows.withColumn("_slot", slot).join(rest, same, "left")
    return _with_first(rows, df.columns, order, F.coalesce("_hot_first", "_key_first"))


def keep_first(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """Only the first record per key. Spark keeps one row per key and task before the shuffle."""
    window = Window.partitionBy(*key).orderBy(order)
    return df.withColumn("_place", F.row_number().over(window)).where("_place = 1").drop("_place")


def _renamed(side: DataFrame, key: Sequence[str], prefix: str, *more: Column) -> DataFrame:
    names = [F.col(name).alias(prefix + name) for name in key]
    return side.select(*names, F.col("first_ord").alias(f"{prefix}first"), *more)


def _same_key(key: Sequence[str], prefix: str) -> Column:
    same = F.lit(True)
    for name in key:
        same = same & F.col(name).eqNullSafe(F.col(prefix + name))
    return same


def _with_first(rows: DataFrame, columns: Sequence[str], order: str, first: Column) -> DataFrame:
    later = F.col("reason").isNull() & (F.col(order) > first)
    return rows.select(*columns, F.when(later, first).alias("first_ord"))


def _key_bytes(key: Sequence[str]) -> Column:
    size = F.lit(0)
    for name in key:
        size = size + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
    return size
