"""Toxicity by compression distance: which of two zstandard dictionaries makes the windows of a text shorter.

Texts are lower-cased (A-Z) and cut into windows of ``WINDOW_WORDS`` words, all of them, without overlap. Each window is
compressed with a dictionary of ordinary text and with one of toxic text. The ordinary dictionary holds the most frequent
words of ordinary texts; the toxic one holds the words, or beginnings of words, that toxic texts have significantly more
often than ordinary ones, and then the same ordinary words, so that ordinary language costs the same under both and a
difference comes from toxic words. A text is described by its largest difference, the sum and the share of those above
a window threshold, and their mean; the threshold and the weights of the four are calibrated on labelled texts that
neither dictionary has seen, to give the probability of label 1; the constant is then moved from the odds of label 1
among those to its odds among all labelled texts, so that a score means the same however many were sampled.

Learning uses a bounded sample of labelled rows: at most ``TOXIC_TEXTS`` and ``ORDINARY_TEXTS`` in the order of a hash of
the id, and at most ``SAMPLE_BYTES`` of text; a text that does not fit is left out, the next ones may fit. Dictionaries
have at most ``TOXIC_WORDS`` and ``ORDINARY_WORDS`` words. Scoring reads all of every text.

Defined results: null, empty and blank texts have no windows, their features are 0, and they get the score that goes
with that. Labels of one id that disagree count as toxic; null labels and labels without a text are ignored. Without
labelled texts of both kinds every score is the share of toxic labels, 0 if there are none. Repeated rows are scored
alike. Empty tables give empty results.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import BATCH_BYTES, LOWER, Batches, released, remainder, slices, texts_of, with_columns

WINDOW_WORDS = 6
TOXIC_TEXTS, ORDINARY_TEXTS = 2000, 6000
SAMPLE_BYTES = 24 << 20
TOXIC_WORDS, ORDINARY_WORDS = 400, 3000
BEGINNINGS = (4, 5, 6, 7, 8, 10)
LEAST_TEXTS, LEAST_SHARE = 5, 0.01
SKETCH_MASKS = (0, 0x5BD1E995, 0xA3B19535, 0xF1357AEA)
SIGNIFICANT = 25.0  # log-likelihood ratio of a word's numbers of texts
LEAST_RATIO = 1.5  # log of the ratio of its shares
THRESHOLDS = (1, 2, 3, 4, 5)  # bytes, of which one is chosen
FEATURES = 4
PREDICTED_FROM = 0.3

# zstandard's binary-tree search over the whole dictionary finds short matches reliably; faster searches miss some.
SEARCH = {"strategy": zstandard.STRATEGY_BTLAZY2, "window_log": 16, "hash_log": 17, "chain_log": 17, "search_log": 9}
FRAME = {"min_match": 4, "target_length": 64, "write_content_size": False, "write_checksum": False, "write_dict_id": False}


@dataclass(frozen=True)
class ToxicityModel:
    """Dictionaries, window threshold, and a logistic function of the features."""

    ordinary: bytes
    toxic: bytes
    threshold: int
    weights: tuple[float, ...]
    constant: float

    def score(self, features: np.ndarray) -> float:
        if math.isinf(self.constant):  # one kind of label only
            return float(self.constant > 0)
        power = self.constant + float(np.dot(self.weights, features))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, power))))


def windows(text: bytes) -> list[bytes]:
    words = text.translate(LOWER).split()
    return [b" " + b" ".join(words[at : at + WINDOW_WORDS]) + b" " for at in range(0, len(words), WINDOW_WORDS)]


@lru_cache(maxsize=4)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    content = zstandard.ZstdCompressionDict(dictionary or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    settings = zstandard.ZstdCompressionParameters(**SEARCH, **FRAME)
    return zstandard.ZstdCompressor(dict_data=content, compression_params=settings)


def differences(text: bytes, ordinary: bytes, toxic: bytes) -> np.ndarray:
    """Per window, how many bytes shorter it is under the toxic dictionary."""
    plain, hostile = _compressor(ordinary).compress, _compressor(toxic).compress
    return np.array([len(plain(window)) - len(hostile(window)) for window in windows(text)], np.float64)


def features(gains: np.ndarray, threshold: int) -> np.ndarray:
    """Largest gain, sum of the gains from the threshold on, their share of the windows, mean."""
    if not len(gains):
        return np.zeros(FEATURES)
    above = gains >= threshold
    return np.array([gains.max(), np.log1p(gains[above].sum()), above.mean(), gains.mean()])


def beginnings(text: bytes) -> set[bytes]:
    """The words of a text with the blank before them: whole, and their beginnings of ``BEGINNINGS`` bytes."""
    words = {b" " + word for word in text.translate(LOWER).split()}
    cut = {word[: size + 1] for size in BEGINNINGS for word in words if len(word) > size}
    return cut.union(word + b" " for word in words)


def without_copies(texts: list[bytes]) -> list[bytes]:
    """The texts that share no smallest shingle hash with one before: copies would make their chance words count."""
    seen: set[tuple[int, int]] = set()
    out = []
    for text in texts:
        words = text.translate(LOWER).split()
        hashes = [zlib.crc32(b" ".join(words[at : at + 3])) for at in range(max(1, len(words) - 2))]
        lowest = {(turn, min(code ^ mask for code in hashes)) for turn, mask in enumerate(SKETCH_MASKS)}
        if not lowest & seen:
            out.append(text)
        seen |= lowest
    return out


def train_dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    """The ordinary and the toxic dictionary; what matters most stands last, nearest to the window."""
    in_toxic = Counter(part for text in toxic for part in beginnings(text))
    least = max(LEAST_TEXTS, LEAST_SHARE * len(toxic))
    wanted = {part for part, count in in_toxic.items() if count >= least}
    in_ordinary = Counter(part for text in ordinary for part in beginnings(text) & wanted)
    frequent = Counter(word for text in ordinary for word in text.translate(LOWER).split())

    def ratio(part: bytes) -> float:
        there, here = (in_toxic[part] + 0.5) / (len(toxic) + 1), (in_ordinary[part] + 0.5) / (len(ordinary) + 1)
        return math.log(there / here)

    def likelihood(part: bytes) -> float:
        counts, sizes = (in_toxic[part], in_ordinary[part]), (len(toxic), len(ordinary))
        expected = [sum(counts) * size / sum(sizes) for size in sizes]
        return 2 * sum(count * math.log(count / mean) for count, mean in zip(counts, expected) if count)

    power = {part: likelihood(part) for part in wanted if ratio(part) > LEAST_RATIO}
    marked: list[bytes] = []
    for part in sorted(power, key=lambda part: (-power[part], -len(part), part)):
        if power[part] <= SIGNIFICANT or len(marked) == TOXIC_WORDS:
            break
        if not any(part.startswith(other) or other.startswith(part) for other in marked):
            marked.append(part)
    known = sorted(frequent, key=lambda word: (-frequent[word], word))[:ORDINARY_WORDS]
    base = b" ".join(reversed(known))
    return base, b"".join([*reversed(marked), b" ", base])


def calibrate(gains: list[np.ndarray], toxic: np.ndarray) -> tuple[int, np.ndarray, float, float]:
    """Threshold, weights, constant and log-likelihood of the best logistic function of the features."""
    best = None
    for threshold in THRESHOLDS:
        table = np.array([features(gain, threshold) for gain in gains])
        spread = table.std(axis=0) + 1e-9
        rows = np.column_stack([table / spread, np.ones(len(table))])
        weights = np.zeros(rows.shape[1])
        ridge = np.diag([1e-1] * (rows.shape[1] - 1) + [1e-6])
        for _ in range(30):
            chance = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
            bend = (rows * (chance * (1 - chance))[:, None]).T @ rows + ridge
            weights += np.linalg.solve(bend, rows.T @ (toxic - chance) - ridge @ weights)
        chance = np.clip(1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30))), 1e-9, 1 - 1e-9)
        fit = float(np.log(np.where(toxic == 1, chance, 1 - chance)).sum())
        if best is None or fit > best[3]:
            best = (threshold, weights[:-1] / spread, float(weights[-1]), fit)
    return best


def learn(rows: list[tuple[bytes, int]], counts: dict[int, int]) -> ToxicityModel:
    """Two thirds of the texts make the dictionaries, the rest calibrate; ``counts`` are those of all labelled texts."""
    share = counts.get(1, 0) / sum(counts.values()) if counts else 0.0
    parts = {label: without_copies([text for text, own in rows if own == label]) for label in (0, 1)}
    if min(map(len, parts.values())) < 3:
        power = math.log(share / (1 - share)) if 0 < share < 1 else math.inf if share else -math.inf
        return ToxicityModel(b"", b"", 1, (0.0,) * FEATURES, power)
    kept = {label: texts[len(texts) // 3 :] for label, texts in parts.items()}
    ordinary, toxic = train_dictionaries(kept[1], kept[0])
    left = [(text, label) for label, texts in parts.items() for text in texts[: len(texts) // 3]]
    gains = [differences(text, ordinary, toxic) for text, _ in left]
    threshold, weights, constant, _ = calibrate(gains, np.array([label for _, label in left], np.float64))
    sampled = Counter(label for _, label in left)  # the sample has both labels in a mix of its own
    constant += math.log(counts[1] / counts[0]) - math.log(sampled[1] / sampled[0])
    return ToxicityModel(ordinary, toxic, threshold, tuple(weights.tolist()), constant)


def fit(documents: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Learn from a bounded sample of the labelled documents whose crc32(doc_id) mod 4 is not 2."""
    known = with_columns(labels, doc_id="long", toxic="int").where("toxic is not null and doc_id is not null")
    known = known.groupBy("doc_id").agg(F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    docs = with_columns(documents, doc_id="long", text="string").where(remainder("doc_id", 4) != 2)
    sized = docs.where("text is not null").select("doc_id", F.octet_length("text").alias("bytes")).join(known, "doc_id")
    order = F.xxhash64("doc_id", F.lit("toxicity"))
    fitting = sized.where(F.col("bytes") <= SAMPLE_BYTES // 2)
    chosen, total = {}, 0
    for label, most in ((1, TOXIC_TEXTS), (0, ORDINARY_TEXTS)):
        total = 0
        for row in fitting.where(F.col("toxic") == label).orderBy(order, "doc_id", "bytes").limit(most).collect():
            if total + row.bytes <= SAMPLE_BYTES // 2:  # a text that does not fit is left out, the next may fit
                total += row.bytes
                chosen[row.doc_id] = label
    counts = {row.toxic: row.texts for row in sized.groupBy("toxic").agg(F.count_distinct("doc_id").alias("texts")).collect()}
    if not chosen:
        return learn([], counts)
    ids = documents.sparkSession.createDataFrame(list(chosen), "long").toDF("doc_id")
    docs = docs.where(F.octet_length("text") <= SAMPLE_BYTES // 2)
    rows = docs.join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"]).orderBy(order, "doc_id").collect()
    return learn([(row.text.encode(), chosen[row.doc_id]) for row in rows], counts)


def _scored(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in slices(batches, BATCH_BYTES):
            scores = [
                held.score(features(differences(text, held.ordinary, held.toxic), held.threshold))
                for text in texts_of(batch)
            ]
            at = batch.schema.get_field_index("_toxicity")
            yield batch.set_column(at, "_toxicity", pa.array(scores, pa.float64()))

    rows = documents.withColumn("_toxicity", F.lit(None).cast("double"))
    return rows.mapInArrow(released(run), rows.schema)


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: ``doc_id, held_out, score, predicted``."""
    rows = _scored(with_columns(documents, doc_id="long", text="string"), fit(documents, labels))
    return rows.select(
        "doc_id",
        (remainder("doc_id", 4) == 2).alias("held_out"),
        F.col("_toxicity").alias("score"),
        (F.col("_toxicity") >= PREDICTED_FROM).cast("int").alias("predicted"),
    )


def without_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    return _scored(documents, fit(documents, labels)).where(F.col("_toxicity") < PREDICTED_FROM).drop("_toxicity")
