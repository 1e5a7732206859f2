"""From raw documents to packed training sequences; every stage writes Parquet that the next one reads.

The stages drop toxic documents, exact copies, near copies (five-word shingles, a Jaccard similarity of 0.8 or more; the
smallest doc_id of each group stays) and documents with benchmark passages, and pack what is left. All but the last
return the columns of ``documents``.

Defined results: null, empty and blank texts are scored like a text without toxic words, are copies of each other (one
stays, the longest, then that with the smallest id), have no near copies and no passages, and are packed as an end id
alone. Of wholly equal rows one stays. Rows without doc_id are never dropped as copies, since nothing names them.
Columns beyond those of ``documents`` pass through. An empty table gives an empty one at every stage.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallybook.llm import decontamination, exact_dedup, jaccard_join, toxicity
from tallybook.llm.best_fit_packing import packed_documents
from tallybook.session import shared_folder, use_local_scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOKENIZER = "word_bpe_49k.json"
NEAR_COPIES = jaccard_join.Similarity(words=5, num=80, den=100)

# The tokenizer, the trained classifier and the components cannot be written in SQL.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(build: Stage) -> Stage:
    """A local session that names no folder for intermediate data gets one of its own."""

    @functools.wraps(build)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        use_local_scratch(spark)
        return build(spark, docs, sf_dir)

    return run_stage


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.3 or more go; the model learns from the labelled ones among them."""
    return toxicity.without_toxic(docs, _table(spark, sf_dir, "labels"))


@stage
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, the longest stays, then the smallest doc_id."""
    return exact_dedup.deduplicated(docs)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the smallest doc_id stays."""
    return jaccard_join.one_of_each(docs, NEAR_COPIES)


@stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item go."""
    return decontamination.clean(docs, _table(spark, sf_dir, "benchmark"))


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document that is left, packed into sequences of at most 4096 tokens."""
    return packed_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    use_local_scratch(spark)
    docs = _table(spark, sf_dir, "documents")
    for name, build in STAGES:
        path = shared_folder(spark, name)
        build(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
