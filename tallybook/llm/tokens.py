"""Encoding whole texts with a public tokenizer, fast enough for word vocabularies.

``Encoder`` gives the ids of ``Tokenizer.encode(text, add_special_tokens=False)`` as little-endian bytes. For a
vocabulary that drops white space, a text is the sequence of its blank-free chunks, so each distinct chunk is encoded
once and remembered, full stops and commas apart. Chunks of letters followed by signs, nearly all of them, go to the
merge model as one or two parts; anything else goes through the tokenizer itself. The memory is emptied when it
reaches ``REMEMBERED`` entries, about 150 MB.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

from tokenizers import Tokenizer

REMEMBERED = 700_000

# The parts a tokenizer file must have for its texts to be encoded chunk by chunk.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

# Python splits at the first four, the tokenizer does not; it lower-cases the other two without their context.
UNUSUAL = "\x1c\x1d\x1e\x1fΣİ"

# A full stop or comma beside another sign belongs to a run of signs; otherwise it stands alone.
STOP_BY_SIGN = re.compile(r"[.,](?:(?=[^\s\w]|_)|(?<=[^\s\w][.,])|(?<=_[.,]))")

# Letters that NFC and lower-casing treat one by one, then signs that are neither letters, digits nor apostrophes.
CHUNK = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([.,!?;:#$%&*()\[\]{}\"=+/\\_|~^@-]*)")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {byte: chr(byte) for byte in printable}
    for place, byte in enumerate(byte for byte in range(256) if byte not in letters):
        letters[byte] = chr(256 + place)
    return letters


class Encoder:
    def __init__(self, path: str, remembered: int = REMEMBERED):
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.remembered = remembered
        self.known: dict[str, bytes] = {}
        self.letters = _byte_letters()
        pre = (parts.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_chunk = (
            (parts.get("normalizer") or {}).get("normalizers") == NORMALIZERS
            and [step.get("type") for step in pre] == ["Split", "ByteLevel"]
            and pre[0].get("pattern") == {"Regex": SPLIT}
            and not any(" " in token["content"] for token in parts.get("added_tokens", []))
        )

    def encode(self, text: str) -> bytes:
        """The ids as unsigned 32-bit little-endian integers."""
        if not self.by_chunk or any(sign in text for sign in UNUSUAL):
            return self._whole(text)
        if not STOP_BY_SIGN.search(text):
            text = text.lower().replace(".", " . ").replace(",", " , ")
        chunks = text.split()
        known = self.known
        try:
            return b"".join(map(known.__getitem__, chunks))
        except KeyError:
            new = set(chunks).difference(known)
        if len(known) + len(new) > self.remembered:
            known.clear()
            new = set(chunks)
        for chunk in new:
            known[chunk] = self._chunk(chunk)
        return b"".join(map(known.__getitem__, chunks))

    def _chunk(self, chunk: str) -> bytes:
        match = CHUNK.fullmatch(chunk)
        if match is None:
            return self._whole(chunk)
        word, signs = match.groups()
        return (self._part(word.lower()) if word else b"") + (self._part(signs) if signs else b"")

    def _part(self, part: str) -> bytes:
        ids = self.known.get(part)
        if ids is None:
            letters = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
            ids = _packed([token.id for token in self.model.tokenize(letters)])
        return ids

    def _whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)


def _packed(ids) -> bytes:
    values = array("I", ids)
    if values.itemsize != 4 or array("H", [1]).tobytes() != b"\x01\x00":
        raise RuntimeError("a little-endian machine with 32-bit integers is needed")
    return values.tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker; its memory lasts over tasks."""
    return Encoder(path)
