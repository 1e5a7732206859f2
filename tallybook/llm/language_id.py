"""Language of a text by hierarchical discrimination: its family first, then the languages of the family.

Both steps use linear support vector machines, one against one: each pair of families, and each pair of languages
within a family, has a machine of its own, trained in a task of its own. The candidate with most votes wins, the
greater sum of margins decides ties. Features are byte n-grams of two and three bytes of the whole text, A-Z
lower-cased and signs and digits as blanks, counted in ``BUCKETS`` hashed places, square roots, scaled to length 1.

Learning uses a bounded sample of labelled rows: at most ``TEXTS_PER_LANGUAGE`` texts per language in the order of a hash
of the id, fewer if there are more than ``LANGUAGES``. Learning and prediction read all of every text, its features are
counted a piece at a time. Vectors travel compressed, and a machine's task holds those of its texts once; tasks take
their texts a slice at a time and give their memory back.

Defined results: a null text and one without a letter are ``und`` with score 0. If only one language was learned, it
is predicted with score 1; if none was, every text is ``und``. Repeated rows are predicted alike. Rows without id
belong to the remainder of the empty text. Empty tables give empty results.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.common import BATCH_BYTES, Batches, released, released_group, remainder, slices, with_columns

BUCKETS = 4096
TEXTS_PER_LANGUAGE = 1200
LANGUAGES = 10
PIECE = 1 << 16  # bytes whose features are counted at once
ROWS = 256  # vectors that are squared at once
SALTS = 64
EPOCHS = 15
SOFTNESS = 4.0
UNDETERMINED = "und"

# Families of languages by their ISO 639-1 codes. A language not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "turkic": "tr az kk ky uz tk tt",
    "indo-aryan": "hi ur bn pa gu mr ne",
    "baltic": "lt lv",
    "finnic": "fi et",
    "semitic": "ar he am mt",
}
FAMILY = {language: family for family, languages in FAMILIES.items() for language in languages.split()}

LETTER = re.compile(r"[^\W\d_]")
PLAIN = bytes(
    byte if byte >= 0x80 or 0x61 <= byte <= 0x7A else byte + 32 if 0x41 <= byte <= 0x5A else 0x20 for byte in range(256)
)


def family_of(language: str) -> str:
    return FAMILY.get(language.lower().split("-")[0], language)


def vector(text: bytes) -> np.ndarray:
    """Features of a text."""
    plain = np.frombuffer(b" " + text.translate(PLAIN).strip() + b" ", np.uint8)
    blank = plain == 0x20
    blank[1:] &= blank[:-1].copy()  # those that follow another
    blank[[0, -1]] = False
    plain = plain[~blank]
    counts = np.zeros(BUCKETS, np.int64)
    shift = np.uint32(32 - (BUCKETS - 1).bit_length())
    for at in range(0, len(plain), PIECE):
        # two bytes of the next piece end the pairs and triples that begin in this one
        codes = plain[at : at + PIECE + 2].astype(np.uint32)
        pairs = codes[:-1] * np.uint32(0x9E3779B1) + codes[1:] * np.uint32(0x85EBCA77)
        triples = (pairs[:-1] ^ (codes[2:] * np.uint32(0xC2B2AE3D))) * np.uint32(0x27D4EB2F)
        counts += np.bincount((pairs[:PIECE] * np.uint32(0x27D4EB2F)) >> shift, minlength=BUCKETS)
        counts += np.bincount(triples[:PIECE] >> shift, minlength=BUCKETS)
    roots = np.sqrt(counts.astype(np.float32))
    return roots / max(float(np.sqrt(counts.sum())), 1.0)


def train_machine(rows: np.ndarray, sides: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and constant of a linear support vector machine, by dual coordinate descent; sides are 1 or -1.

    The steps follow from the rows and sides in whatever order they come. Nothing is as large as ``rows`` beside them.
    """
    ordered = np.argsort(rows.view(f"S{rows.shape[1] * rows.itemsize}").ravel(), kind="stable")
    ordered = ordered[np.argsort(sides[ordered], kind="stable")]
    lengths = np.empty(len(rows), np.float32)
    for at in range(0, len(rows), ROWS):
        some = np.column_stack([rows[at : at + ROWS], np.ones(len(rows[at : at + ROWS]), np.float32)])
        lengths[at : at + ROWS] = (some * some).sum(axis=1)
    limits = SOFTNESS * len(rows) / (2 * np.array([(sides == side).sum() for side in sides]))  # equal say for each side
    alphas, weights = np.zeros(len(rows)), np.zeros(rows.shape[1] + 1)
    row, order = np.ones(rows.shape[1] + 1), np.random.default_rng(0)
    for _ in range(EPOCHS):
        for at in ordered[order.permutation(len(rows))]:
            row[:-1] = rows[at]
            slope = sides[at] * float(row @ weights) - 1
            alpha = min(max(alphas[at] - slope / lengths[at], 0.0), limits[at])
            if alpha != alphas[at]:
                weights += (alpha - alphas[at]) * sides[at] * row
                alphas[at] = alpha
    return weights[:-1], float(weights[-1])


@dataclass(frozen=True)
class LanguageModel:
    """Languages by family, and for each pair of names the column of its machine; positive margins vote for the first."""

    families: dict[str, list[str]]
    pairs: dict[tuple[str, str, str], int]
    weights: np.ndarray
    constants: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.families or text is None or not LETTER.search(text):
            return UNDETERMINED, 0.0
        margins = vector(text.encode()) @ self.weights + self.constants
        family, sure = self._winner("", sorted(self.families), margins)
        language, surer = self._winner(family, self.families[family], margins)
        return language, sure * surer

    def _winner(self, level: str, names: list[str], margins: np.ndarray) -> tuple[str, float]:
        if len(names) == 1:
            return names[0], 1.0
        votes = dict.fromkeys(names, (0, 0.0))
        for pair in itertools.combinations(names, 2):
            margin = float(margins[self.pairs[(level, *pair)]])
            for name, side in zip(pair, (margin, -margin)):
                number, total = votes[name]
                votes[name] = (number + (side > 0), total + side)
        best = max(names, key=lambda name: votes[name])
        mean = votes[best][1] / (len(names) - 1)
        return best, 1 / (1 + math.exp(-max(-50.0, min(50.0, 2 * mean))))


def fit(documents: DataFrame) -> LanguageModel:
    """Learn from a bounded sample of the documents whose crc32(doc_id) mod 4 is not 2."""
    docs = with_columns(documents, doc_id="long", text="string", lang="string")
    docs = docs.where(remainder("doc_id", 4) != 2).where("lang is not null and text is not null and doc_id is not null")
    languages = sorted(row.lang for row in docs.select("lang").distinct().collect())
    families: dict[str, list[str]] = {}
    for language in languages:
        families.setdefault(family_of(language), []).append(language)
    pairs = [("", *pair) for pair in itertools.combinations(sorted(families), 2)]
    pairs += [(name, *pair) for name, own in families.items() for pair in itertools.combinations(own, 2)]
    number = {pair: at for at, pair in enumerate(pairs)}
    if not pairs:
        return LanguageModel(families, number, np.zeros((BUCKETS, 0)), np.zeros(0))

    each = max(20, min(TEXTS_PER_LANGUAGE, TEXTS_PER_LANGUAGE * LANGUAGES // len(languages)))
    # the first ids of each salt, of which those of the language are the first: no language meets in one task
    ids = docs.select("doc_id", "lang", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt"))
    for group in (["lang", "salt"], ["lang"]):
        order = Window.partitionBy(*group).orderBy(F.xxhash64("doc_id", F.lit("language")), "doc_id")
        ids = ids.withColumn("place", F.row_number().over(order)).where(F.col("place") <= each)
    sample = docs.join(F.broadcast(ids.select("doc_id", "lang").distinct()), ["doc_id", "lang"])

    def spread(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BATCH_BYTES):
            rows = []
            for text, language in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                if not LETTER.search(text):
                    continue
                family, held = family_of(language), zlib.compress(vector(text.encode()).tobytes(), 1)
                for pair, at in number.items():
                    name = family if pair[0] == "" else language if pair[0] == family else None
                    if name in pair[1:]:
                        rows.append((at, 1 if name == pair[1] else -1, held))
            columns = list(zip(*rows)) or [(), (), ()]
            kinds = (pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["pair", "side", "held"]
            )

    def train(table: pa.Table) -> pa.Table:
        rows = np.empty((len(table), BUCKETS), np.float32)
        for at, held in enumerate(table.column("held")):
            rows[at] = np.frombuffer(zlib.decompress(held.as_buffer()), np.float32)
        weights, constant = train_machine(rows, table.column("side").to_numpy().astype(np.float64))
        columns = [table.column("pair")[:1].cast(pa.int32()), [weights.tobytes()], [constant]]
        return pa.table(columns, pa.schema([("pair", pa.int32()), ("weights", pa.binary()), ("constant", pa.float64())]))

    machines = sample.select("text", "lang").mapInArrow(released(spread), "pair int, side int, held binary")
    # what a group takes is its vectors, more than the compressed ones that come
    machines = machines.groupBy("pair").applyInArrow(released_group(train, 0), "pair int, weights binary, constant double")
    weights, constants = np.zeros((BUCKETS, len(pairs))), np.zeros(len(pairs))
    for row in machines.collect():  # one row per pair of languages
        weights[:, row.pair], constants[row.pair] = np.frombuffer(row.weights), row.constant
    return LanguageModel(families, number, weights, constants)


def predicted(batches: Batches, model: LanguageModel) -> Batches:
    """``doc_id, lang_pred, score`` of batches with ``doc_id, text``."""
    for batch in slices(batches, BATCH_BYTES):
        found = [model.predict(text) for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([language for language, _ in found], pa.string()),
                pa.array([score for _, score in found], pa.float64()),
            ],
            ["doc_id", "lang_pred", "score"],
        )


def languages(documents: DataFrame) -> DataFrame:
    """Per document: ``doc_id, held_out, lang_pred, score``."""
    shared = documents.sparkSession.sparkContext.broadcast(fit(documents))
    rows = with_columns(documents, doc_id="long", text="string")
    run = released(lambda batches: predicted(batches, shared.value))
    rows = rows.mapInArrow(run, "doc_id long, lang_pred string, score double")
    return rows.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
