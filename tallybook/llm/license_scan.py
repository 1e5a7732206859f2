"""Licences in documents: normalised text compared to templates by the Dice coefficient over word bigrams.

Words are runs of ASCII letters and digits and of all letters beyond ASCII, in lower case. A template is its set of
bigrams. It is compared with the windows of as many words as it has that begin at one of its bigrams; Dice is twice the shared
bigrams over the sizes of both sets, and a template is found where some window reaches ``LEAST_DICE``.

Size bounds come first: a window of n words has at most n - 1 bigrams, so a template of b bigrams is found only if
some window shares at least ``least_shared(b)`` of them. Templates longer than the text by more than the bound allows,
and those of whose bigrams the whole text holds too few, are dropped before any window is looked at. A window that would
run over the end of the text is moved back to end with it.

One row per document: the best template's licence, its Dice, where its window begins, and all licences found. Notices of
related licences differ in a word or a version, so several templates reach the bound on one notice: of templates of
different licences whose windows share more than half of the shorter one, the better alone counts as found.

Defined results: null, empty and one-word texts have no bigram and no licence (null, Dice 0). Of equal Dice the longer
template is taken, then the first in the list. Repeated rows are each reported. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallybook.llm.common import Batches, texts_of, with_columns
from tallybook.llm.license_templates import TEMPLATES

LEAST_DICE = 0.8
FOUND = "doc_id long, license string, dice double, first_word long, n_words long, licenses array<string>"

WORDS = bytes(
    byte if byte >= 0x80 or 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A else byte + 32 if 0x41 <= byte <= 0x5A else 0x20
    for byte in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


class Templates:
    """The templates by bigram; ``first`` holds the first words of all bigrams, to pass over most of a text quickly."""

    def __init__(self, templates: Sequence[tuple[str, str]], least_dice: float):
        self.least_dice = least_dice
        self.names = [name for name, _ in templates]
        words = [words_of(text.encode()) for _, text in templates]
        self.lengths = [len(own) for own in words]
        self.bigrams = [set(zip(own, own[1:])) for own in words]
        self.owners: dict[tuple[bytes, bytes], list[int]] = {}
        for number, own in enumerate(self.bigrams):
            for bigram in own:
                self.owners.setdefault(bigram, []).append(number)
        self.words = {word for bigram in self.owners for word in bigram}

    def least_shared(self, number: int, window: int) -> float:
        """Shared bigrams needed by a window of so many words; its set has at least as many bigrams as it shares.

        From dice = 2 s / (b + w) and w >= s follows s >= dice * b / (2 - dice).
        """
        needed = self.least_dice * len(self.bigrams[number]) / (2 - self.least_dice)
        needed = math.ceil(needed - 1e-9)  # the bound itself may be met exactly
        return needed if needed <= window - 1 else math.inf

    def scan(self, text: bytes) -> list[tuple[float, int, int, int]]:
        """(dice, template, first word, words) of each template found, best window each."""
        words = words_of(text)
        known = self.words
        if len(known.intersection(words)) < 2:
            return []
        places: dict[int, list[int]] = {}
        for at, bigram in enumerate(zip(words, words[1:])):
            if bigram[0] in known and bigram in self.owners:
                for number in self.owners[bigram]:
                    places.setdefault(number, []).append(at)
        found = []
        for number, held in places.items():
            length = min(self.lengths[number], len(words))
            needed = self.least_shared(number, length)
            if len(held) < needed or len({(words[at], words[at + 1]) for at in held}) < needed:
                continue
            best = (0.0, 0)
            dense = _dense_starts(held, length, needed, len(words))
            for first in dense:
                window = set(zip(words[first : first + length - 1], words[first + 1 : first + length]))
                shared = len(window & self.bigrams[number])
                dice = 2 * shared / (len(window) + len(self.bigrams[number]))
                best = max(best, (dice, -first))
            if best[0] >= self.least_dice:
                found.append((best[0], number, -best[1], length))
        return found


def apart(found: list[tuple[float, int, int, int]], names: Sequence[str]) -> list[tuple[float, int, int, int]]:
    """What is found, best first, without templates whose window a better one of another licence covers by half."""
    kept: list[tuple[float, int, int, int]] = []
    for hit in sorted(found, key=lambda hit: (-hit[0], -hit[3], hit[1])):
        _, number, first, length = hit
        covered = any(
            names[other] != names[number] and 2 * (min(first + length, begin + size) - max(first, begin)) > min(length, size)
            for _, other, begin, size in kept
        )
        if not covered:
            kept.append(hit)
    return kept


def _dense_starts(held: list[int], length: int, needed: float, words: int) -> list[int]:
    """Starts of windows with enough places in them: at a place, or where the text's last window begins."""
    places = np.array(held)
    starts = np.unique(np.minimum(places, words - length))
    inside = np.searchsorted(places, starts + length - 1) - np.searchsorted(places, starts)
    return starts[inside >= needed].tolist()


@lru_cache(maxsize=4)
def _templates(templates: tuple[tuple[str, str], ...], least_dice: float) -> Templates:
    return Templates(templates, least_dice)


def licenses(
    documents: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, least_dice: float = LEAST_DICE
) -> DataFrame:
    """The best licence of every document, and all that were found; no shuffle."""
    chosen = tuple(templates)

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        held = _templates(chosen, least_dice)
        for batch in batches:
            rows = []
            for text in texts_of(batch):
                found = apart(held.scan(text), held.names)
                if not found:
                    rows.append((None, 0.0, None, None, []))
                    continue
                dice, number, first, length = found[0]
                names = sorted({held.names[hit[1]] for hit in found})
                rows.append((held.names[number], dice, first, length, names))
            kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.list_(pa.string()))
            columns = [pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 5, kinds)]
            names = ["doc_id", "license", "dice", "first_word", "n_words", "licenses"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    return with_columns(documents, doc_id="long", text="string").mapInArrow(run, FOUND)
