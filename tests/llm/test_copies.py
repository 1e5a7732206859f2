from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybook.llm import common
from tallybook.llm.components import connected, forest
from tallybook.llm.exact_dedup import deduplicated, exact_duplicates, sha256
from tallybook.llm.jaccard_join import Similarity, block_components, components, one_of_each, shingle_sets

BLANK = re.compile(r"[\x20\x09-\x0D]")


def brute_copies(pairs):
    groups = {}
    for doc_id, text in pairs:
        groups.setdefault(BLANK.sub("", text or ""), []).append((doc_id, text or ""))
    out = []
    for norm, own in groups.items():
        best = max(own, key=lambda row: (len(row[1]), row[0] is not None, -(row[0] or 0)))[0]
        out += [(i, best, len(own), i == best, hashlib.sha256(norm.encode()).hexdigest()) for i, _ in own]
    return sorted(out, key=str)


def copies(table, **options):
    rows = exact_duplicates(table, **options).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    return sorted(map(tuple, rows), key=str)


def test_exact_copies(documents):
    chooser = random.Random(3)
    texts = ["a b", "ab", "a  b\t", "é", " é", "", None, "abc", "a b"]
    pairs = [(at * 2 - 40, chooser.choice(texts)) for at in range(120)]
    assert copies(documents(pairs)) == brute_copies(pairs)


@pytest.mark.parametrize("bits", [0, 3])
def test_texts_are_compared_where_digests_collide(documents, bits):
    pairs = [(at, "x" * (at % 7) + " " * (at % 3)) for at in range(60)]
    digest = lambda text: F.conv(F.substring(sha256(text), 1, 1), 16, 2).substr(1, bits)
    assert copies(documents(pairs), digest=digest) == brute_copies(pairs)


def test_exact_copies_of_odd_rows(odd, odd_pairs, none):
    assert copies(odd) == brute_copies(odd_pairs)
    assert copies(none) == []


def test_deduplicated_keeps_columns_and_one_of_equal_rows(odd, none):
    kept = deduplicated(odd)
    assert kept.columns == odd.columns
    rows = sorted((row.doc_id, row.text[:5]) for row in kept.where("doc_id is not null").collect())
    # the blanks of 3 are the longest of the empty texts
    assert rows == [(3, " \n\t"), (4, "one"), (6, "\x00   é"), (7, "w w w")]
    assert deduplicated(none).count() == 0


def test_rows_are_dropped_alike_without_broadcast(documents, monkeypatch):
    pairs = [(at, "abc"[: at % 3]) for at in range(30)]
    small = sorted(row.doc_id for row in deduplicated(documents(pairs)).collect())
    monkeypatch.setattr(common, "BROADCAST_KEYS", 0)
    assert sorted(row.doc_id for row in deduplicated(documents(pairs)).collect()) == small == [0, 1, 2]


def brute_components(pairs, like):
    sets = []
    for _, text in pairs:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lower)
        grams = {tuple(words[at : at + like.words]) for at in range(len(words) - like.words + 1)}
        sets.append(grams or ({tuple(words)} if words else set()))
    label = list(range(len(pairs)))
    for a in range(len(pairs)):
        for b in range(a):
            common_ = len(sets[a] & sets[b])
            if sets[a] and like.den * common_ >= like.num * (len(sets[a]) + len(sets[b]) - common_):
                old, new = label[a], label[b]
                label = [new if own == old else own for own in label]
    least = {}
    for (doc_id, _), own in zip(pairs, label):
        if doc_id is not None:
            least[own] = min(doc_id, least.get(own, doc_id))
    return sorted(((i, len(s), least.get(own)) for (i, _), s, own in zip(pairs, sets, label)), key=str)


def found_components(table, like=Similarity(), **options):
    rows = components(table, like, **options).select("doc_id", "n_shingles", "component_id").collect()
    return sorted(map(tuple, rows), key=str)


def near_copies(prose, seed, number, words, edits):
    """Copies of a text with some words changed, a few of them changed much."""
    chooser = random.Random(seed)
    base = prose(seed, words).split()
    out = []
    for at in range(number):
        own = list(base)
        for _ in range(edits * 6 if at % 5 == 4 else chooser.randint(0, edits)):
            own[chooser.randrange(words)] = prose(chooser.random(), 1) + "x"
        out.append(" ".join(own[chooser.randint(0, 2) :]))
    return out


@pytest.mark.parametrize("like", [Similarity(), Similarity(5, 80, 100), Similarity(2, 1, 2), Similarity(1, 9, 10)])
def test_near_copies(documents, prose, like):
    texts = [t for seed, words in ((1, 8), (2, 30), (3, 120), (4, 4)) for t in near_copies(prose, seed, 20, words, 2)]
    line = prose(99, 12)
    texts += [f"{line} {prose(100 + at, 40)}" for at in range(20)] + ["A b", "a B", "a", "A", "b"] * 3
    pairs = [(at * 7 % 1009, text) for at, text in enumerate(texts)]
    assert found_components(documents(pairs), like) == brute_components(pairs, like)


def test_large_blocks_are_split_without_losing_links(documents, prose):
    texts = near_copies(prose, 5, 90, 60, 3) + near_copies(prose, 6, 40, 60, 4)
    pairs = [(1000 - at, text) for at, text in enumerate(texts)]
    for block_sets in (7, 25):
        assert found_components(documents(pairs), block_sets=block_sets) == brute_components(pairs, Similarity())


@pytest.mark.parametrize("block_sets", [2000, 5])
def test_near_copies_without_an_id_link_the_others_and_take_no_component_over(documents, prose, block_sets):
    first, second = near_copies(prose, 7, 24, 60, 2), near_copies(prose, 8, 24, 60, 2)
    pairs = [(None if at % 3 == 0 else at, text) for at, text in enumerate([*first, *second])]
    assert found_components(documents(pairs), block_sets=block_sets) == brute_components(pairs, Similarity())


def test_near_copies_of_odd_rows(odd, odd_pairs, none):
    assert found_components(odd) == brute_components(odd_pairs, Similarity())
    assert found_components(none) == []


def test_one_of_each_keeps_the_least_and_all_without_words(odd, none):
    kept = one_of_each(odd, Similarity())
    assert kept.columns == odd.columns
    assert sorted(row.doc_id for row in kept.where("doc_id is not null").collect()) == [1, 2, 3, 4, 6, 7]
    assert one_of_each(none, Similarity()).count() == 0


def test_linked_sets_always_share_a_part_key():
    chooser = random.Random(8)
    for like in (Similarity(), Similarity(5, 80, 100), Similarity(3, 1, 2)):
        for _ in range(300):
            size = chooser.randint(1, 120)
            grams = {chooser.getrandbits(64) for _ in range(size)}
            other = set(grams)
            for _ in range(chooser.randint(0, max(1, size // 6))):
                if chooser.random() < 0.6 and len(other) > 1:
                    other.discard(chooser.choice(sorted(other)))
                else:
                    other.add(chooser.getrandbits(64))
            common_ = len(grams & other)
            if like.den * common_ < like.num * (len(grams) + len(other) - common_):
                continue
            firsts = like.size_classes(400)
            keys = []
            for own in (grams, other):
                values = np.array(sorted(own), np.uint64)
                number = int(np.searchsorted(firsts, len(values), side="right")) - 1
                keys.append({k for n in (number, number + 1) for k in like.part_keys(values, n, firsts[n + 1]).tolist()})
            assert keys[0] & keys[1]


def test_blocks_by_known_labels():
    sets = [np.arange(a, a + 20, dtype=np.uint64) for a in (0, 1, 500, 501, 900)]
    like = Similarity(1, 85, 100)
    free = block_components(sets, like)
    assert free[0] == free[1] != free[2] == free[3] != free[4]
    tied = block_components(sets, like, np.array([4, 5, 6, 7, 4]))
    assert tied[0] == tied[1] == tied[4] != tied[2] == tied[3]


def test_shingles_of_short_and_shared_texts():
    one, same, other, none_ = shingle_sets([b"a b", b"A\n b", b"b a", b" "], 4)
    assert np.array_equal(one, same) and len(one) == 1
    assert not np.array_equal(one, other) and len(none_) == 0


def test_components_of_edges(spark):
    chooser = random.Random(4)
    edges = [(chooser.randrange(300), chooser.randrange(300)) for _ in range(180)] + [(n, n + 1) for n in range(400, 440)]
    wanted = {n: n for edge in edges for n in edge}
    for _ in range(60):
        for a, b in edges:
            wanted[a] = wanted[b] = min(wanted[a], wanted[b])
    wanted = {n: label for n, label in wanted.items() if any(n in edge and edge[0] != edge[1] for edge in edges)}
    rows = connected(spark.createDataFrame(edges, "node long, other long")).collect()
    assert {row.node: row.label for row in rows} == wanted and len(rows) == len(wanted)
    node, low = forest(*np.array(edges).T)
    assert all(wanted[int(n)] == int(label) for n, label in zip(node, low))
