from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybook.llm import hard_negatives as hn

ROWS = "vec_id long, embedding array<float>, label int"


def expected(rows):
    given_rows = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = int(math.fmod(label + 1, 10)) if vec_id % 7 == 0 else label
        given_rows.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    for anchor, label, vector in given_rows:
        if anchor % 100:
            continue
        scores = [
            (-sum(x * y for x, y in zip(vector, other)), vec_id, own)
            for vec_id, own, other in given_rows
            if vec_id != anchor and len(other) == len(vector)
        ]
        for minus, positive, _ in sorted(row for row in scores if row[2] == label)[:5]:
            kept = sorted(row for row in scores if row[2] != label and 30 * -minus <= 100 * -row[0] <= 90 * -minus)
            out += [(anchor, positive, rank, row[1], -minus, -row[0]) for rank, row in enumerate(kept[:10], 1)]
    return sorted(out)


def mined(spark, rows, **options):
    table = spark.createDataFrame(rows, ROWS).selectExpr("*", "1 AS block", "'x' AS size", "0 AS score").repartition(5)
    found = hn.hard_negatives(hn.relabelled(hn.participants(table)), F.col("vec_id") % 100 == 0, **options)
    return sorted(map(tuple, found.collect()))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5), st.integers(1, 900), st.integers(0, 10_000), st.integers(1, 12), st.sampled_from([3, 50, 1 << 20, 1 << 40]))
def test_a_tree_gives_the_exact_first_rows_of_a_window(size, count, seed, k, reach):
    random_ = np.random.default_rng(seed)
    rows = random_.integers(-reach, reach + 1, (count, size))
    ids = random_.integers(0, count, count)
    anchors = random_.integers(-reach, reach + 1, (3, size))
    order = hn.tile(rows, hn.LEAF)
    assert sorted(order.tolist()) == list(range(count))
    search = hn.Search(hn.Tree(ids[order], rows[order]), anchors)
    for anchor in range(3):
        exact = [sum(int(x) * int(y) for x, y in zip(anchors[anchor], row)) for row in rows]
        scores = [max(-hn.LONGEST - 1, min(hn.LONGEST, score)) for score in exact]
        low, high = sorted(int(score) for score in random_.choice(scores, 2))
        kept = sorted((-s, int(i)) for s, i in zip(scores, ids) if low <= s <= high and i != 1)
        found = search.first(anchor, 1, low, high, k)
        assert [(-int(s), int(i)) for s, i in zip(*found)] == kept[:k]


def test_boxes_outside_the_window_are_not_opened():
    rows = np.repeat(np.arange(64)[:, None] * 1000, hn.LEAF, axis=0)
    search = hn.Search(hn.Tree(np.arange(len(rows)), rows), np.array([[1]]))
    scores, ids = search.first(0, -1, 20_000, 20_999, 5)
    assert set(scores.tolist()) == {20_000} and ids.tolist() == list(range(20 * hn.LEAF, 20 * hn.LEAF + 5))
    assert len(search.leaves) == 1


@pytest.mark.parametrize("options", [{}, {"tree_rows": 40, "pack_rows": 2}])
def test_hard_negatives_follow_the_contract(spark, options):
    chooser = random.Random(5)
    rows = []
    for vec_id in [*range(500), *range(500), None, 700, 1400]:
        center = chooser.choice([0.3, -0.2])
        vector = [center + chooser.choice([0.0, 0.05, -0.05, chooser.random() / 4]) for _ in range(6)]
        rows.append((vec_id, vector, chooser.choice([0, 1, 2, 9, None])))
    rows += [(800 + at, [0.25] * 6, at % 2) for at in range(120)]  # ties
    rows += [(2000, None, 1), (2001, [0.1, None], 1), (2002, [float("nan")] * 6, 1), (2100, [0.5, 0.5], 3), (2101, [0.5, 0.25], 3), (2102, [0.3, 0.2], 4)]
    rows += [(2200, [], 1), (2201, [], 1), (2202, [], 2)]
    found = mined(spark, rows, **options)
    assert found == expected(rows) and len(found) > 100


def test_huge_components_saturate(spark):
    large = [(100, [4e6], 1), (101, [4e6], 1), (102, [2e6], 2)]  # products beyond 2^53, within a long
    rows = [(100, [3e38], 1), (101, [2e38], 1), (102, [1e30], 2), (103, [1.0], 2)]
    assert (100, 101, 1, 103, hn.LONGEST, 256 * hn.LIMIT) not in mined(spark, rows)
    assert mined(spark, large) == expected(large) and expected(large)


def test_empty_table_and_no_anchors(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [0.5], 1), (2, [0.5], 2)]) == []
    assert mined(spark, [(100, [0.5], 1), (2, [0.5], 2)]) == []
