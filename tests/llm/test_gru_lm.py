from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallybook.llm import gru_lm
from tallybook.llm.gru_lm import FREQUENT, SHAPES, START, STATE, Network, Vocabulary, log_likelihoods, scores, shape, train


def tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), "\n"]


def check_base(rows, pairs):
    held = {doc_id: zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2 for doc_id, _ in pairs}
    counts = Counter(token for doc_id, text in pairs if not held[doc_id] for token in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    wanted = [
        (
            doc_id,
            held[doc_id],
            len(tokens(text)),
            sum(counts[token] > 0 for token in tokens(text)),
            total,
            round(sum(math.log10((counts[token] + 1) / (total + distinct + 1)) for token in tokens(text)), 6),
        )
        for doc_id, text in pairs
    ]
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)


def test_counts_base_and_a_better_score(documents):
    chooser, pairs = random.Random(6), []
    for at in range(600):  # two languages that share no words, and chains within each
        own = [f"{'ab'[at % 2]}{n}" for n in range(40)]
        words = [chooser.choice(own)]
        for _ in range(chooser.randint(5, 80)):
            words.append(own[(own.index(words[-1]) + chooser.randint(1, 3)) % 40])
        pairs.append((at, " ".join(words) + (" Unseen%d" % at if at % 9 == 0 else "")))
    rows = scores(documents(pairs)).collect()
    check_base(rows, pairs)
    held = [row for row in rows if row.held_out]
    assert sum(row.score for row in held) > sum(row.base_score for row in held)


def test_odd_rows(odd, odd_pairs, none):
    check_base(scores(odd).collect(), odd_pairs)
    assert scores(none).count() == 0


def test_without_training_documents(documents):
    pairs = [(at, "a b c") for at in range(60) if zlib.crc32(str(at).encode()) % 7 == 2]
    rows = scores(documents(pairs)).collect()
    check_base(rows, pairs)
    assert {row.train_tokens for row in rows} == {0}


@pytest.fixture
def network():
    frequent = 70
    known = Vocabulary(
        1000,
        120,
        np.arange(frequent, dtype=np.uint64),
        np.arange(frequent, 0, -1),
        np.full(SHAPES, 5),
        np.full(SHAPES, 2),
    )
    return Network.fresh(known)


def all_codes(frequent=70):
    return np.concatenate((np.arange(frequent), FREQUENT + np.arange(SHAPES)))


def test_shares_of_all_codes_sum_to_one(network):
    for state in (np.zeros(STATE, np.float32), np.linspace(-1, 1, STATE, dtype=np.float32)):
        codes = all_codes()
        logs, _ = network.log_likelihood(np.tile(state, (len(codes), 1)), codes)
        assert abs(np.exp(logs).sum() - 1) < 1e-4


def test_words_of_a_shape_and_the_unseen_one_share_its_class():
    known = Vocabulary(0, 0, np.empty(0, np.uint64), np.empty(0, np.int64), np.array([12]), np.array([3]))
    counts = np.array([7, 4, 1, 0])  # three known words and one part for the unseen
    assert abs(np.exp(known.rare_log(counts, np.zeros(4, int))).sum() - 1) < 1e-9


def plain_score(network, codes):
    """One document, one token at a time."""
    state, total, before = np.zeros((1, STATE), np.float32), 0.0, START
    for code in codes.tolist():
        state = network.step(np.array([before]), state)[0]
        total += float(network.log_likelihood(state, np.array([code]))[0][0])
        before = code
    return total


@pytest.mark.parametrize("lanes, window", [(1, 5), (3, 4), (64, 64)])
def test_state_is_carried_over_windows_and_not_over_documents(network, lanes, window):
    random_ = np.random.default_rng(3)
    texts = [random_.choice(all_codes(), size) for size in (1, 30, 2, 17, 64, 5)]
    found = log_likelihoods(network, texts, lanes, window)
    assert np.allclose(found, [plain_score(network, codes) for codes in texts], rtol=1e-4)


def test_gradients_equal_differences(network):
    """One step of training moves each weight against the slope that differences show."""
    random_ = np.random.default_rng(5)
    wide = {name: value.astype(np.float64) for name, value in network.arrays.items()}
    net = Network(wide, network.frequent)
    states = random_.normal(0, 0.5, (9, STATE))
    codes = random_.choice(all_codes(), 9)
    gradients = {name: np.zeros_like(value) for name, value in wide.items()}
    _, back = net.log_likelihood(states, codes, gradients)

    def total(own):
        return net.log_likelihood(own, codes)[0].sum()

    for row, column in ((0, 0), (4, 7), (8, 23)):
        moved = states.copy()
        moved[row, column] += 1e-5
        assert abs((total(moved) - total(states)) / 1e-5 - back[row, column]) < 1e-3
    for name, place in (("classes", (3, 1)), ("class_bias", (2,)), ("words", (1, 4, 2)), ("word_bias", (0, 3))):
        before = total(states)
        wide[name][place] += 1e-5
        assert abs((total(states) - before) / 1e-5 - gradients[name][place]) < 1e-3
        wide[name][place] -= 1e-5


def test_training_raises_the_likelihood(network):
    chain = np.array([(7 * at) % 50 for at in range(400)])
    texts = [np.roll(chain, at)[:200] for at in range(20)]
    before = log_likelihoods(network, texts).sum()
    trained = train(network, texts, lanes=4)
    assert log_likelihoods(trained, texts).sum() > 0.8 * before
    assert log_likelihoods(network, texts).sum() == before  # the given network is left alone


@pytest.mark.parametrize("share", [0, 1, 2, 17, gru_lm.TRAIN_SHARE - 1])
def test_the_rounds_visit_every_share_and_no_held_out_document(spark, network, share):
    codes = bytes(np.arange(40, dtype=np.uint16))
    for own, learned in ((share, True), (-1, False)):
        coded = spark.createDataFrame([(own, codes)] * 3, "share int, codes binary")
        after = network
        for turn in range(gru_lm.ROUNDS):
            after = gru_lm._train_round(coded, after, turn)
        assert np.array_equal(after.flat(), network.flat()) != learned


def test_shapes():
    assert shape(b"\n") == SHAPES - 1
    words = [b"a", b"abc.", b"abcdefgh,", b"abcdefghijklm!", "é".encode(), "straße".encode(), b"\xff"]
    assert all(0 <= shape(word) < SHAPES - 1 for word in words) and len({shape(word) for word in words}) > 4
    assert gru_lm.lanes_of([5, 1, 4, 2], 2) in ([[0, 1], [2, 3]], [[2, 3], [0, 1]])


def test_gradients_through_time_equal_differences(network):
    """Of the recurrent and input weights, over a window with several documents."""
    random_ = np.random.default_rng(8)
    wide = {name: value.astype(np.float64) for name, value in network.arrays.items()}
    net = Network(wide, network.frequent)
    texts = [random_.choice(all_codes(), size) for size in (7, 3, 9, 1, 5)]
    run = gru_lm.Lanes(texts, 2)
    places, ends = run.window(0, 100)
    start = random_.normal(0, 0.3, (2, STATE))
    gradients = {name: np.zeros_like(value) for name, value in wide.items()}
    gru_lm.backward(net, run.codes[places].astype(np.int64), run.inputs[places], ends, start, gradients)

    def total():
        states, *_ = gru_lm.forward(net, run.inputs[places], ends, start)
        return net.log_likelihood(states, run.codes[places].astype(np.int64))[0].sum()

    used = int(texts[2][3])
    spots = [("recurrent", (row, column)) for row, column in ((0, 0), (5, 30), (9, 60), (23, 71))]
    spots += [("inputs", (START, 2)), ("inputs", (START, 70)), ("inputs", (used, 10)), ("inputs", (used, 40)), ("inputs", (used, 65))]
    for name, place in spots:
        before = total()
        wide[name][place] += 1e-5
        assert abs((total() - before) / 1e-5 - gradients[name][place]) < 1e-3
        wide[name][place] -= 1e-5
    assert gradients["recurrent"].any() and gradients["inputs"][used].any()


def test_lanes_hold_every_document_once(network):
    random_ = np.random.default_rng(9)
    texts = [random_.choice(all_codes(), size).astype(np.uint16) for size in random_.integers(1, 40, 30)]
    run = gru_lm.Lanes(texts, 4)
    places = np.concatenate([run.window(begin, 7)[0] for begin in range(0, run.steps, 7)])
    assert sorted(places.tolist()) == list(range(sum(map(len, texts))))
    assert [run.codes[at : at + len(texts[document])].tolist() for at, document in zip(run.begins, run.order)] == [
        texts[document].tolist() for document in run.order
    ]
    assert (run.inputs[run.begins] == START).all()


def test_a_very_long_text_among_short_ones_takes_little_memory(network):
    import tracemalloc

    random_ = np.random.default_rng(10)
    texts = [random_.choice(all_codes(), size).astype(np.uint16) for size in [200_000, *[20] * 600]]
    tracemalloc.start()
    found = log_likelihoods(network, texts)
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()
    assert np.allclose(found[1:4], [plain_score(network, codes) for codes in texts[1:4]], rtol=1e-4)


def test_scores_do_not_hang_on_runs_or_partitions(documents, prose, monkeypatch):
    monkeypatch.setattr(gru_lm, "UNIT_BYTES", 30_000)  # several units
    pairs = [(at, prose(at, at % 40)) for at in range(300)]
    table = documents(pairs)
    runs = [scores(table), scores(table), scores(table.repartition(8)), scores(table.coalesce(1))]
    found = [sorted((row.doc_id, row.score) for row in run.collect()) for run in runs]
    assert found[0] == found[1] == found[2] == found[3]
