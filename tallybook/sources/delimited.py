"""Delimited files to raw text columns with a record order."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDER = "ord"
BROKEN_LINE = "broken_line"


def scan_delimited(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``ord``, one text column per name (bound by position) and ``broken_line``.

    The first line of each file is dropped unread. ``broken_line`` holds the line when it has too few or
    too many fields. ``ord`` follows path, then line: the row id alone does not, because Spark packs the
    splits of several files into tasks by size.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in (*columns, BROKEN_LINE)])
    lines = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("sep", ",")
        .option("quote", '"')
        .option("escape", '"')
        .option("comment", "#")
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BROKEN_LINE)
        # a pruned read would not count the fields of a line
        .option("columnPruning", False)
        .csv(path if isinstance(path, str) else list(path))
    )
    order = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return lines.select(order.alias(ORDER), *columns, BROKEN_LINE)


def input_files(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """The files that a scan of ``path`` reads, in the order of their records."""
    lines = spark.read.text(path if isinstance(path, str) else list(path))
    return [unquote(file) for file in sorted(lines.inputFiles())]  # records are ordered by the path as Spark writes it
