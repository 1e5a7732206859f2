"""Language model with gated recurrent units and a class-factored softmax, trained and applied with numpy in tasks.

Words. Counts of all training tokens are gathered over all documents: each batch of documents asks for the counts of its
distinct words, by 64-bit hash, and gets them back. The ``FREQUENT`` most frequent words are modelled one by one, in
classes of ``CLASS_WORDS`` words by rank; every other word belongs to one of ``SHAPES`` classes by its shape (length,
letters beyond ASCII, closing sign). Then

    P(word | text so far) = P(class | state) * P(word | class, state)     for frequent words
    P(word | text so far) = P(class | state) * (c + 1) / (N' + V' + 1)    for the others,

with the class's own N' tokens and V' words; all unseen words of a class share the last part, so a text of any words has
a probability.

Training. One pass over all training documents, dealt by hash to ``TRAIN_SHARE`` shares and these in turn to ``ROUNDS``
rounds. A round deals its documents by hash to units of about ``UNIT_BYTES`` of text. Each unit trains by itself, by truncated
backpropagation over windows of ``WINDOW`` tokens, and the weights of all units are averaged by tokens after each round. Units
and the order within them follow from the documents alone, so the network does not depend on how the table is read.

Scoring. The documents of a unit run side by side in lanes; the state is carried from window to window until a document
ends, so the score is the log-likelihood of the complete document, of any length. A lane is a cursor into the unit's codes:
besides these, memory holds one window of all lanes. In training, texts of over ``TRAIN_PIECE`` tokens are pieces of it.

Documents of the remainder 2 of crc32(doc_id) mod 7 take no part in counts or training. Words are compared by 64-bit
hashes.

Defined results: a null or empty text is the end token alone. Repeated rows are counted and scored as often as they
occur; rows without doc_id are dealt to units by their place in the table. Without training documents all counts are 0 and the model is the uniform one over its classes. An empty table
gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import LOWER, Batches, remainder, slices, texts_of, with_columns
from tallybook.operators.sinks import settle

FREQUENT = 1024
CLASS_WORDS = 64
SHAPES = 65  # the last is that of the end token, if that is not among the frequent ones
STATE = 24
WINDOW = 16
TRAIN_LANES, SCORE_LANES = 384, 512
TRAIN_PIECE = 1024
TRAIN_SHARE = 32
ROUNDS = 2
RATE = 0.02
SLOT_BYTES = 8 << 20
BATCH_BYTES = 24 << 20  # of text that shares one list of words
UNIT_BYTES = 24 << 20  # of text whose documents meet in one task, to be scored or, a round of them at a time, to train
UNIT_DOCUMENTS = 100_000
WEIGHT_PARTS = 16
LANE_UNITS = 64  # networks that a task adds up
END = b"\n"  # no word holds a line break
LOG10 = math.log(10)


class Words(dict):
    """Numbers words in the order they are met; the end token is 0."""

    def __init__(self):
        super().__init__({END: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def shape(word: bytes) -> int:
    """Length, first letter beyond ASCII, and closing sign of a word, as a class from 0 to 63."""
    if word == END:
        return SHAPES - 1
    last = word[-1]
    closing = 1 if last == 0x2E else 2 if last == 0x2C else 0 if last >= 0x80 or 0x61 <= last <= 0x7A else 3
    length = 0 if len(word) <= 4 else 1 if len(word) <= 7 else 2 if len(word) <= 11 else 3
    beyond = 0 if word.isascii() else 1 + next((byte for byte in word if 0x80 <= byte < 0xC0), 0) % 3
    return closing * 16 + length * 4 + beyond


@lru_cache(maxsize=1)
def _zstandard() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    """Made once per process: a pair for each text would cost more than its ids."""
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _packed(values: np.ndarray) -> bytes:
    return _zstandard()[0].compress(values.tobytes())


def _unpacked(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(_zstandard()[1].decompress(data), kind)


TOKENS = "kind string, batch string, slot long, doc_id long, held_out boolean, a binary, b binary, c binary"
TOKENS_SCHEMA = pa.schema(
    [
        ("kind", pa.string()),
        ("batch", pa.string()),
        ("slot", pa.int64()),
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("a", pa.binary()),
        ("b", pa.binary()),
        ("c", pa.binary()),
    ]
)


def _rows(schema: pa.Schema, length: int, **columns) -> pa.RecordBatch:
    arrays = []
    for field in schema:
        values = columns.get(field.name)
        if values is None:
            arrays.append(pa.nulls(length, field.type))
        else:
            arrays.append(values if isinstance(values, pa.Array) else pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _tokenise(slots: int):
    """Rows of kind doc (a: word numbers), vocab (a: place of each word by hash, b: its shape by hash) and ask."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for at, batch in enumerate(slices(batches, BATCH_BYTES)):
            words, name = Words(), f"{task}.{at}"
            texts = texts_of(batch)
            held_out = batch.column("held_out").to_pylist()
            blobs, learned = [], [np.empty(0, np.uint32)]
            for text, held in zip(texts, held_out):
                ids = array("I", map(words.__getitem__, text.translate(LOWER).split()))
                ids.append(0)
                ids = np.frombuffer(ids, np.uint32)
                blobs.append(_packed(ids))
                if not held:
                    learned.append(ids)
            total = np.bincount(np.concatenate(learned), minlength=len(words))
            hashes = np.array([xxhash.xxh3_64_intdigest(word) for word in words], np.uint64)
            shapes = np.array([shape(word) for word in words], np.uint8)
            order = np.argsort(hashes)
            hashes, total, shapes = hashes[order], total[order].astype(np.uint32), shapes[order]
            number = len(texts)
            yield _rows(
                TOKENS_SCHEMA,
                number,
                kind=["doc"] * number,
                batch=[name] * number,
                doc_id=batch.column("doc_id"),
                held_out=batch.column("held_out"),
                a=blobs,
            )
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            held = {"a": [place.tobytes()], "b": [shapes.tobytes()], "c": [hashes.tobytes()]}
            yield _rows(TOKENS_SCHEMA, 1, kind=["vocab"], batch=[name], **held)
            slot = ((hashes >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)
            starts = np.flatnonzero(np.diff(slot, prepend=-1))
            ends = np.append(starts[1:], len(slot))
            yield _rows(
                TOKENS_SCHEMA,
                len(starts),
                kind=["ask"] * len(starts),
                batch=[name] * len(starts),
                slot=slot[starts],
                a=[hashes[x:y].tobytes() for x, y in zip(starts, ends)],
                b=[total[x:y].tobytes() for x, y in zip(starts, ends)],
                c=[shapes[x:y].tobytes() for x, y in zip(starts, ends)],
            )

    return run


REPLIES = "kind string, batch string, slot long, counts binary, shape long, word long, tokens long, words long"


def _reply(table: pa.Table) -> pa.Table:
    """Counts for every batch that asked, sums by shape, and the most frequent words of the slot."""
    parts = [np.frombuffer(data, np.uint64) for data in table.column("a").to_pylist()]
    hashes, back = np.unique(np.concatenate(parts), return_inverse=True)
    own = np.frombuffer(b"".join(table.column("b").to_pylist()), np.uint32)
    counts = np.bincount(back, weights=own, minlength=len(hashes)).astype(np.int64)
    shapes = np.zeros(len(hashes), np.uint8)
    shapes[back] = np.frombuffer(b"".join(table.column("c").to_pylist()), np.uint8)
    ends = np.cumsum([len(part) for part in parts])
    blobs = [counts[back[end - len(part) : end]].tobytes() for part, end in zip(parts, ends)]
    slot = table.column("slot")[0].as_py()
    top = np.argsort(-counts, kind="stable")[:FREQUENT]
    top = top[counts[top] > 0]
    tokens = np.bincount(shapes, weights=counts, minlength=SHAPES).astype(np.int64)
    words = np.bincount(shapes, weights=counts > 0, minlength=SHAPES).astype(np.int64)
    replies, stats, tops = len(parts), SHAPES, len(top)
    none, ids = [None], hashes[top].view(np.int64).tolist()
    return pa.table(
        {
            "kind": ["reply"] * replies + ["sum"] * stats + ["top"] * tops,
            "batch": pa.array(table.column("batch").to_pylist() + none * (stats + tops), pa.string()),
            "slot": pa.array([slot] * (replies + stats + tops), pa.int64()),
            "counts": pa.array(blobs + none * (stats + tops), pa.binary()),
            "shape": pa.array(none * replies + list(range(SHAPES)) + shapes[top].tolist(), pa.int64()),
            "word": pa.array(none * (replies + stats) + ids, pa.int64()),
            "tokens": pa.array(none * replies + tokens.tolist() + counts[top].tolist(), pa.int64()),
            "words": pa.array(none * replies + words.tolist() + none * tops, pa.int64()),
        }
    )


@dataclass(frozen=True)
class Vocabulary:
    """Sizes of the training tokens, the frequent words in order of rank, and what the shapes hold besides them."""

    tokens: int
    words: int
    frequent: np.ndarray  # hashes
    counts: np.ndarray
    shape_tokens: np.ndarray
    shape_words: np.ndarray

    @property
    def classes(self) -> int:
        return -(-len(self.frequent) // CLASS_WORDS) + SHAPES

    def rare_log(self, counts: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        """Natural log of the share of a word in its shape's class."""
        return np.log((counts + 1) / (self.shape_tokens[shapes] + self.shape_words[shapes] + 1.0))


def vocabulary(replies: DataFrame) -> Vocabulary:
    """At most ``FREQUENT`` words and ``SHAPES`` sums come to the driver."""
    sums = replies.where("kind = 'sum'").groupBy("shape").agg(F.sum("tokens").alias("n"), F.sum("words").alias("v"))
    tokens, words = np.zeros(SHAPES, np.int64), np.zeros(SHAPES, np.int64)
    for row in sums.collect():
        tokens[row["shape"]], words[row["shape"]] = row.n, row.v
    top = replies.where("kind = 'top'").orderBy(F.col("tokens").desc(), "word").limit(FREQUENT).collect()
    shape_tokens, shape_words = tokens.copy(), words.copy()
    for row in top:
        shape_tokens[row["shape"]] -= row["tokens"]
        shape_words[row["shape"]] -= 1
    frequent = np.array([row.word for row in top], np.int64).view(np.uint64)
    counts = np.array([row["tokens"] for row in top], np.int64)
    return Vocabulary(int(tokens.sum()), int(words.sum()), frequent, counts, shape_tokens, shape_words)


CODED = "doc_id long, held_out boolean, share int, n_tokens long, n_known long, base_score double, rare double, codes binary"


def _code(known: Vocabulary):
    """Documents as codes: a frequent word's rank, or FREQUENT + shape; with what does not depend on the state."""
    by_hash = np.argsort(known.frequent)
    sorted_hashes = known.frequent[by_hash]
    floor = known.tokens + known.words + 1

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        vocab = left.filter(pc.equal(left.column("kind"), "vocab"))
        place = np.frombuffer(vocab.column("a")[0].as_py(), np.uint32)
        shapes = np.frombuffer(vocab.column("b")[0].as_py(), np.uint8)
        hashes = np.frombuffer(vocab.column("c")[0].as_py(), np.uint64)
        replies = sorted(zip(right.column("slot").to_pylist(), right.column("counts").to_pylist()))
        counts = np.frombuffer(b"".join(data for _, data in replies), np.int64)
        codes = FREQUENT + shapes.astype(np.int64)
        rare = known.rare_log(counts, shapes)
        if len(sorted_hashes):
            at = np.minimum(np.searchsorted(sorted_hashes, hashes), len(sorted_hashes) - 1)
            found = sorted_hashes[at] == hashes
            codes[found], rare[found] = by_hash[at[found]], 0.0
        base = np.log10((counts + 1) / floor)
        codes, rare, base, seen = codes[place].astype(np.uint16), rare[place], base[place], (counts > 0)[place]
        docs = left.filter(pc.equal(left.column("kind"), "doc"))
        rows = []
        for blob in docs.column("a").to_pylist():
            ids = _unpacked(blob, np.uint32)
            rows.append((len(ids), int(seen[ids].sum()), float(base[ids].sum()), float(rare[ids].sum()), codes[ids].tobytes()))
        numbers, n_known, bases, rares, blobs = list(zip(*rows)) or [()] * 5
        doc_ids, held_out = docs.column("doc_id").to_pylist(), docs.column("held_out").to_pylist()
        share = [
            -1 if held else xxhash.xxh3_64_intdigest(f"{doc_id}:{number}") % TRAIN_SHARE
            for doc_id, held, number in zip(doc_ids, held_out, numbers)
        ]
        return pa.table(
            {
                "doc_id": pa.array(doc_ids, pa.int64()),
                "held_out": pa.array(held_out, pa.bool_()),
                "share": pa.array(share, pa.int32()),
                "n_tokens": pa.array(numbers, pa.int64()),
                "n_known": pa.array(n_known, pa.int64()),
                "base_score": pa.array(bases, pa.float64()),
                "rare": pa.array(rares, pa.float64()),
                "codes": pa.array(blobs, pa.binary()),
            }
        )

    return run


class Network:
    """Gated recurrent units over codes. Arrays by name; ``inputs`` has a row per code and one for the start."""

    def __init__(self, arrays: dict[str, np.ndarray], frequent: int):
        self.arrays, self.frequent = arrays, frequent
        self.word_classes = -(-frequent // CLASS_WORDS)

    @classmethod
    def fresh(cls, known: Vocabulary) -> Network:
        """Starts at the unigram probabilities, with a state that says little."""
        random, frequent = np.random.default_rng(1), len(known.frequent)
        word_classes = -(-frequent // CLASS_WORDS)
        padded = np.zeros(word_classes * CLASS_WORDS)
        padded[:frequent] = known.counts
        by_class = np.concatenate((padded.reshape(-1, CLASS_WORDS).sum(axis=1), known.shape_tokens)) + 1.0
        words = np.where(np.arange(len(padded)) < frequent, np.log(padded + 1), -30.0).reshape(-1, CLASS_WORDS)
        scale = 0.3 / math.sqrt(STATE)
        arrays = {
            "inputs": random.normal(0, 0.1, (FREQUENT + SHAPES + 1, 3 * STATE)),
            "recurrent": random.normal(0, scale, (STATE, 3 * STATE)),
            "classes": random.normal(0, 0.02, (STATE, len(by_class))),
            "class_bias": np.log(by_class / by_class.sum()),
            "words": random.normal(0, 0.02, (word_classes, STATE, CLASS_WORDS)),
            "word_bias": words,
        }
        arrays["inputs"][:, STATE : 2 * STATE] += 1.0  # keep most of the state at first
        return cls({name: value.astype(np.float32) for name, value in arrays.items()}, frequent)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.arrays[name].ravel() for name in sorted(self.arrays)])

    def filled(self, flat: np.ndarray) -> Network:
        arrays, at = {}, 0
        for name in sorted(self.arrays):
            shape_ = self.arrays[name].shape
            size = int(np.prod(shape_))
            arrays[name] = flat[at : at + size].reshape(shape_).astype(np.float32)
            at += size
        return Network(arrays, self.frequent)

    def over(self, flat: np.ndarray) -> Network:
        """A network whose arrays are views of ``flat``."""
        arrays, at = {}, 0
        for name in sorted(self.arrays):
            size = self.arrays[name].size
            arrays[name] = flat[at : at + size].reshape(self.arrays[name].shape)
            at += size
        return Network(arrays, self.frequent)

    def class_of(self, codes: np.ndarray) -> np.ndarray:
        return np.where(codes < FREQUENT, codes // CLASS_WORDS, self.word_classes + codes - FREQUENT)

    def step(self, inputs: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
        """Next state, and what training needs: both gates, the proposal, and its recurrent part."""
        own, carried = self.arrays["inputs"][inputs], state @ self.arrays["recurrent"]
        gates = 0.5 + 0.5 * np.tanh(0.5 * (own[:, : 2 * STATE] + carried[:, : 2 * STATE]))
        reset, keep = gates[:, :STATE], gates[:, STATE:]
        part = carried[:, 2 * STATE :]
        proposal = np.tanh(own[:, 2 * STATE :] + reset * part)
        return proposal + keep * (state - proposal), reset, keep, proposal, part

    def log_likelihood(self, states: np.ndarray, codes: np.ndarray, gradients: dict | None = None):
        """Natural log of P(class) and, for frequent words, P(word | class), per token.

        With ``gradients`` their sums are added there, and the gradient of the states comes as a second value.
        """
        classes = self.class_of(codes)
        logs, powers, totals = _log_share(states, self.arrays["classes"], self.arrays["class_bias"], classes)
        at = np.arange(len(codes))
        back = None
        if gradients is not None:
            powers /= -totals[:, None]
            powers[at, classes] += 1
            gradients["classes"] += states.T @ powers
            gradients["class_bias"] += powers.sum(axis=0)
            back = powers @ self.arrays["classes"].T
        order = np.argsort(classes, kind="stable")
        bounds = np.searchsorted(classes[order], np.arange(self.word_classes + 1))
        for number in range(self.word_classes):
            rows = order[bounds[number] : bounds[number + 1]]
            if not len(rows):
                continue
            words = codes[rows] - number * CLASS_WORDS
            own = states[rows]
            share, powers, totals = _log_share(own, self.arrays["words"][number], self.arrays["word_bias"][number], words)
            logs[rows] += share
            if gradients is not None:
                powers /= -totals[:, None]
                powers[np.arange(len(rows)), words] += 1
                gradients["words"][number] += own.T @ powers
                gradients["word_bias"][number] += powers.sum(axis=0)
                back[rows] += powers @ self.arrays["words"][number].T
        return logs, back


def _log_share(states: np.ndarray, weights: np.ndarray, bias: np.ndarray, chosen: np.ndarray):
    """Log of the chosen softmax share per row, and the powers and their sums."""
    powers = states @ weights
    powers += bias
    if np.abs(weights).sum(axis=0).max() + np.abs(bias).max() > 80:  # states are within 1, so exp may overflow
        powers -= powers.max(axis=1, keepdims=True)
    logs = powers[np.arange(len(chosen)), chosen]
    np.exp(powers, out=powers)
    totals = powers @ np.ones(powers.shape[1], powers.dtype)
    return logs - np.log(totals), powers, totals


START = FREQUENT + SHAPES


def lanes_of(sizes: list[int], lanes: int) -> list[list[int]]:
    """Documents dealt to lanes, longest first, each to the lane that ends first; lanes in descending length."""
    held: list[list[int]] = [[] for _ in range(max(1, min(lanes, len(sizes))))]
    ends = [(0, lane) for lane in range(len(held))]
    for at in sorted(range(len(sizes)), key=lambda at: -sizes[at]):
        end, lane = heapq.heappop(ends)
        held[lane].append(at)
        heapq.heappush(ends, (end + sizes[at], lane))
    return sorted(held, key=lambda lane: -sum(sizes[at] for at in lane))


class Lanes:
    """Documents laid end to end in lanes that run side by side, longest first; positions are places in ``codes``."""

    def __init__(self, documents: list[np.ndarray], lanes: int):
        dealt = lanes_of([len(codes) for codes in documents], lanes)
        self.order = [document for lane in dealt for document in lane]
        lengths = np.array([len(documents[document]) for document in self.order], np.int64)
        self.begins = np.cumsum(lengths) - lengths
        self.codes = np.concatenate([documents[document] for document in self.order] or [np.empty(0, np.uint16)]).astype(np.uint16)
        self.inputs = np.empty_like(self.codes)
        self.inputs[1:] = self.codes[:-1]
        self.inputs[self.begins] = START
        self.sizes = np.array([sum(len(documents[document]) for document in lane) for lane in dealt], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.steps = int(self.sizes.max(initial=0))

    def window(self, begin: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the tokens of a window, step by step, and where each step ends among them."""
        steps = np.arange(begin, min(begin + width, self.steps))
        running = np.searchsorted(-self.sizes, -steps, side="left")
        parts = [self.starts[:lanes] + step for step, lanes in zip(steps, running)]
        return np.concatenate(parts), np.cumsum(running)


def forward(network: Network, inputs: np.ndarray, ends: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
    """States after each token of a window, and what training needs: states before, gates, proposals, recurrent parts."""
    own = network.arrays["inputs"][inputs]
    live = (inputs != START).astype(state.dtype)[:, None]
    recurrent = network.arrays["recurrent"]
    before, after, part, proposal = (np.empty((len(inputs), STATE), own.dtype) for _ in range(4))
    gates = np.empty((len(inputs), 2 * STATE), own.dtype)
    first = 0
    with np.errstate(over="ignore"):  # of the exponent of a gate that is shut
        for last in ends.tolist():
            at = slice(first, last)
            held = np.multiply(state[: last - first], live[at], out=before[at])
            carried = held @ recurrent
            both = carried[:, : 2 * STATE]
            both += own[at, : 2 * STATE]
            gate = np.negative(both, out=gates[at])
            np.exp(gate, out=gate)
            gate += 1
            np.reciprocal(gate, out=gate)
            part[at] = carried[:, 2 * STATE :]
            new = np.multiply(gate[:, :STATE], part[at], out=proposal[at])
            new += own[at, 2 * STATE :]
            np.tanh(new, out=new)
            state = np.subtract(held, new, out=after[at])
            state *= gate[:, STATE:]
            state += new
            first = last
    return after, before, gates, proposal, part, live


def log_likelihoods(network: Network, documents: list[np.ndarray], lanes: int = SCORE_LANES, window: int = 64) -> np.ndarray:
    """Natural log-likelihood of each complete document without the share of rare words in their classes.

    A window has ``lanes * window`` tokens: the fewer lanes still run, the more steps it takes.
    """
    run = Lanes(documents, lanes)
    logs = np.zeros(len(run.codes), np.float32)
    state = np.zeros((len(run.sizes), STATE), np.float32)
    begin = 0
    while begin < run.steps:
        width = max(1, lanes * window // int((run.sizes > begin).sum()))
        places, ends = run.window(begin, width)
        states, *_ = forward(network, run.inputs[places], ends, state)
        logs[places], _ = network.log_likelihood(states, run.codes[places].astype(np.int64))
        state = states[len(states) - int(np.diff(ends, prepend=0)[-1]) :]
        begin += len(ends)
    out = np.zeros(len(documents))
    if len(logs):
        out[run.order] = np.add.reduceat(logs, run.begins, dtype=np.float64)
    return out


def _add_rows(table: np.ndarray, places: np.ndarray, rows: np.ndarray) -> None:
    """Adds each row at its place; places may repeat."""
    order = np.argsort(places, kind="stable")
    starts = np.flatnonzero(np.diff(places[order].astype(np.int64), prepend=-1))
    table[places[order[starts]]] += np.add.reduceat(rows[order], starts, axis=0)


def backward(network: Network, codes: np.ndarray, inputs: np.ndarray, ends: np.ndarray, state: np.ndarray, gradients: dict):
    """Adds the gradients of the log-likelihood of a window's tokens; returns the states after its last step."""
    after, before, gates, proposal, part, live = forward(network, inputs, ends, state)
    _, back = network.log_likelihood(after, codes, gradients)
    reset, keep = gates[:, :STATE], gates[:, STATE:]
    by_keep = (before - proposal) * keep * (1 - keep)
    by_proposal = (1 - keep) * (1 - proposal * proposal)
    by_reset = part * reset * (1 - reset)
    own, carried = (np.empty((len(inputs), 3 * STATE), back.dtype) for _ in range(2))
    across = np.ascontiguousarray(network.arrays["recurrent"].T)
    begins = np.concatenate(([0], ends[:-1]))
    later = np.zeros((0, STATE), back.dtype)
    for first, last in zip(begins[::-1].tolist(), ends[::-1].tolist()):
        at = slice(first, last)
        slope = back[at]
        slope[: len(later)] += later
        to_proposal = np.multiply(slope, by_proposal[at], out=own[at, 2 * STATE :])
        np.multiply(to_proposal, by_reset[at], out=own[at, :STATE])
        np.multiply(slope, by_keep[at], out=own[at, STATE : 2 * STATE])
        carried[at, : 2 * STATE] = own[at, : 2 * STATE]
        np.multiply(to_proposal, reset[at], out=carried[at, 2 * STATE :])
        later = carried[at] @ across
        later += slope * keep[at]
        later *= live[at]
    gradients["recurrent"] += before.T @ carried
    _add_rows(gradients["inputs"], inputs, own)
    return after[int(begins[-1]) :]


def train(network: Network, documents: list[np.ndarray], lanes: int = TRAIN_LANES, rate: float = RATE) -> Network:
    """One pass of truncated backpropagation, with the state carried from window to window (Adam steps).

    Documents longer than ``TRAIN_PIECE`` train as pieces of that length, so that no lane runs on by itself.
    """
    pieces = [codes[at : at + TRAIN_PIECE] for codes in documents for at in range(0, len(codes), TRAIN_PIECE)]
    run = Lanes(pieces, lanes)
    full = len(run.sizes) * WINDOW
    flat = network.flat().copy()
    network = network.over(flat)
    slopes, first, second = np.zeros_like(flat), np.zeros_like(flat), np.zeros_like(flat)
    gradients = network.over(slopes).arrays
    state = np.zeros((len(run.sizes), STATE), np.float32)
    for turn, begin in enumerate(range(0, run.steps, WINDOW), 1):
        places, ends = run.window(begin, WINDOW)
        slopes[:] = 0
        state = backward(network, run.codes[places].astype(np.int64), run.inputs[places], ends, state, gradients)
        slopes /= len(places)
        first += 0.1 * (slopes - first)
        second += 0.01 * (slopes * slopes - second)
        step = rate * len(places) / full  # lanes that have ended leave less to learn from
        flat += step / (1 - 0.9**turn) * first / (np.sqrt(second / (1 - 0.99**turn)) + 1e-6)
    return network


PARTS = "part int, lane int, tokens double, weights binary"
TRAINED = "unit long, part int, tokens double, weights binary"


def _unit_documents(table: pa.Table) -> tuple[pa.Table, list[np.ndarray]]:
    """The rows of a unit in an order that follows from them, and their codes."""
    codes = table.column("codes").to_pylist()
    ids = table.column("doc_id").to_pylist() if "doc_id" in table.column_names else [None] * len(codes)
    order = sorted(range(len(codes)), key=lambda at: (xxhash.xxh3_64_intdigest(codes[at]), ids[at] is not None, ids[at] or 0))
    return table.take(order), [np.frombuffer(codes[at], np.uint16) for at in order]


def _add(table: pa.Table) -> pa.Table:
    """Sums of a part over the rows of a lane, in an order that does not hang on how they arrive."""
    rows = sorted(zip(table.column("tokens").to_pylist(), table.column("weights").to_pylist()))
    weights = sum(np.frombuffer(data) for _, data in rows)
    tokens = sum(tokens for tokens, _ in rows)
    row = {"part": table.column("part")[:1], "lane": table.column("lane")[:1]}
    return pa.table({**row, "tokens": pa.array([tokens], pa.float64()), "weights": pa.array([weights.tobytes()], pa.binary())})


def _train_round(coded: DataFrame, network: Network, turn: int, units: int = 1) -> Network:
    """Train on the documents of the round's shares, unit by unit, and average the weights by tokens.

    Documents are dealt by their column ``unit``; without it they are one unit. Weights are added by lanes of
    ``LANE_UNITS``, these by lanes of their own, until one is left.
    """
    shared = coded.sparkSession.sparkContext.broadcast(network)

    def run(table: pa.Table) -> pa.Table:
        unit = table.column("unit")[0].as_py()
        _, documents = _unit_documents(table)
        tokens = float(sum(map(len, documents)))
        flat = train(shared.value, documents).flat() * tokens
        parts = [part.astype(np.float64).tobytes() for part in np.array_split(flat, WEIGHT_PARTS)]
        columns = [[unit] * WEIGHT_PARTS, range(WEIGHT_PARTS), [tokens] * WEIGHT_PARTS, parts]
        kinds = (pa.int64(), pa.int32(), pa.float64(), pa.binary())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["unit", "part", "tokens", "weights"])

    own = coded.where((F.col("share") >= 0) & (F.pmod("share", F.lit(ROUNDS)) == turn))
    own = own if "unit" in coded.columns else own.withColumn("unit", F.lit(0).cast("long"))
    names = [name for name in ("doc_id", "unit", "codes") if name in own.columns]
    sums = own.select(*names).groupBy("unit").applyInArrow(run, TRAINED).withColumnRenamed("unit", "lane")
    sums = sums.withColumn("lane", F.floor(F.col("lane") / LANE_UNITS).cast("int"))
    lanes = -(-units // LANE_UNITS)
    while True:
        sums = sums.groupBy("part", "lane").applyInArrow(_add, PARTS)
        if lanes == 1:
            break
        sums, lanes = sums.withColumn("lane", F.floor(F.col("lane") / LANE_UNITS).cast("int")), -(-lanes // LANE_UNITS)
    parts = sorted((row.part, row.tokens, row.weights) for row in sums.collect())  # one network
    if not parts:
        return network
    return network.filled(np.concatenate([np.frombuffer(data) / tokens for _, tokens, data in parts]))


def scores(documents: DataFrame) -> DataFrame:
    """Per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    docs = with_columns(documents, doc_id="long", text="string")
    size = docs.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    total = size.bytes or 0
    slots = max(1, -(-total // SLOT_BYTES))
    units = max(1, -(-total // UNIT_BYTES), -(-size.rows // UNIT_DOCUMENTS))
    docs = docs.withColumn("held_out", remainder("doc_id", 7) == 2)
    found = settle(docs.mapInArrow(_tokenise(slots), TOKENS), "tokens", "kind")
    asks = found.where("kind = 'ask'").select("batch", "slot", "a", "b", "c")
    replies = settle(asks.groupBy("slot").applyInArrow(_reply, REPLIES), "replies", "kind")
    known = vocabulary(replies)

    left = found.where("kind in ('doc', 'vocab')").select("batch", "kind", "doc_id", "held_out", "a", "b", "c")
    right = replies.where("kind = 'reply'").select("batch", "slot", "counts")
    coded = left.groupBy("batch").cogroup(right.groupBy("batch")).applyInArrow(_code(known), CODED)
    number = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    unit = F.pmod(F.xxhash64("doc_id", "codes", number), F.lit(units).cast("long"))
    coded = settle(coded.withColumn("unit", unit), "coded")
    network = Network.fresh(known)
    for turn in range(ROUNDS):
        network = _train_round(coded, network, turn, units)
    shared = documents.sparkSession.sparkContext.broadcast(network)

    def run(table: pa.Table) -> pa.Table:
        table, texts = _unit_documents(table)
        score = (log_likelihoods(shared.value, texts) + table.column("rare").to_numpy()) / LOG10
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score"]
        return table.select(names).append_column("score", pa.array(score))

    rows = coded.drop("share").groupBy("unit").applyInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    return rows.withColumn("train_tokens", F.lit(known.tokens).cast("long")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
