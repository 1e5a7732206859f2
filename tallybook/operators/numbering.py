"""Dense numbers 1..n in record order, without a one-task window over the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.operators.sinks import settle

# monotonically_increasing_id keeps the position within a partition in its lower 33 bits
POSITION_BITS = (1 << 33) - 1

# Starts of splits that are broadcast, 24 bytes each; for more files than that the rows are shuffled by split.
MOST_SPLITS = 1_000_000


def number_rows(df: DataFrame, order: str, name: str) -> DataFrame:
    """Add ``name``: 1 for the first row by ``order``, then 2, 3, ... without gaps.

    Rows are range-partitioned and sorted, and each keeps its partition and position. That is written to the shared
    folder first, since the ranges come from a sample and a lost task must not draw them anew.
    """
    placed = df.repartitionByRange(order).sortWithinPartitions(order)
    placed = settle(
        placed.select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(POSITION_BITS).alias("_position"),
        ),
        "numbering",
    )
    # one row per shuffle partition, so the broadcast does not grow with the rows
    starts = F.broadcast(_starts(placed, ["_part"]))
    number = F.col("_start") + F.col("_position") + 1
    return placed.join(starts, "_part").select(number.alias(name), *df.columns)


def number_scanned(df: DataFrame, order: str, name: str) -> DataFrame:
    """The same for rows of a file scan that no shuffle has moved; only counts are shuffled, one per file split.

    ``order`` is that of ``scan_delimited``. Every split is read by one task, from its first line to its last, so rows
    keep their place among those of their split. They are written once, as the plan may filter, and a filter must not
    run a second time over files that are split in another way.
    """
    split = [F.xxhash64(f"{order}.file").alias("_file"), F.col(f"{order}.block").alias("_block")]
    position = F.monotonically_increasing_id().alias("_position")
    placed = settle(df.select("*", *split, position), "numbering")
    splits = placed.groupBy("_file", "_block").agg(
        F.min(f"{order}.file").alias("_path"), F.min("_position").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    before = Window.orderBy("_path", "_block").rowsBetween(Window.unboundedPreceding, -1)
    start = (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_start")
    starts = settle(splits.select("_file", "_block", start), "splits")
    if starts.count() <= MOST_SPLITS:
        starts = F.broadcast(starts)
    number = F.col("_start") + F.col("_position") + 1
    return placed.join(starts, ["_file", "_block"]).select(number.alias(name), *df.columns)


def _starts(rows: DataFrame, group: list[str]) -> DataFrame:
    """Rows before each group. The window sees one row per group, that is per task, not per record."""
    before = Window.orderBy(*group).rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows"))
    return sizes.select(*group, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
