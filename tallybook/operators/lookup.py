"""Look up a value by key in a small dimension."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Most rows and bytes of a dimension that is broadcast without asking Spark's size estimate.
BROADCAST_ROWS = 10_000
BROADCAST_BYTES = 1 << 20


def from_mapping(key: Column, mapping: Mapping[str, object], kind: T.DataType) -> Column:
    """Value of a fixed mapping, null for unknown keys; a literal map, so no join and no shuffle."""
    entries = chain.from_iterable((F.lit(name), F.lit(value).cast(kind)) for name, value in mapping.items())
    return F.try_element_at(F.create_map(*entries), key)


def add_from_table(
    df: DataFrame, key: Column, table: DataFrame, table_key: str, name: str, kind: T.DataType
) -> DataFrame:
    """Add column ``name`` of a dimension table with unique keys; null for unknown keys.

    A few keys hold all records, so the dimension is broadcast once its size is checked. A larger one is
    left to Spark, which splits skewed join partitions.
    """
    entries = table.select(F.col(table_key).alias("_entry"), F.col(name).cast(kind).alias(name))
    if entries.groupBy("_entry").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
        raise ValueError(f"{table_key} must be unique in the looked-up table")
    text = F.concat_ws("", F.col("_entry").cast("string"), F.col(name).cast("string"))
    size = entries.limit(BROADCAST_ROWS + 1).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length(text)).alias("bytes"))
    size = size.first()
    if size.rows <= BROADCAST_ROWS and (size.bytes or 0) <= BROADCAST_BYTES:
        entries = F.broadcast(entries)
    return df.join(entries, key == F.col("_entry"), "left").drop("_entry")
