from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tallybook.llm import vector_copies as vc

ROWS = "vec_id long, embedding array<float>, label int"


def expected(rows, cosine=0.98):
    """n_links and component_id by place, every pair compared."""
    valid = []
    for place, (_, vector, label) in enumerate(rows):
        if label is None or not vector or any(x is None or not math.isfinite(x) for x in vector) or not any(vector):
            continue
        valid.append((place, np.array(vector, np.float32).astype(np.float64), label))
    links, parent = [0] * len(rows), list(range(len(rows)))

    def root(at):
        while parent[at] != at:
            at = parent[at]
        return at

    for at, (a, x, label) in enumerate(valid):
        for b, y, other in valid[:at]:
            if label == other and len(x) == len(y) and x @ y >= cosine * math.sqrt((x @ x) * (y @ y)):
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    least = {}
    for place, (vec_id, _, _) in enumerate(rows):
        if vec_id is not None:
            least[root(place)] = min(vec_id, least.get(root(place), vec_id))
    return [(vec_id, links[at], least.get(root(at)), vec_id == least.get(root(at))) for at, (vec_id, _, _) in enumerate(rows)]


def found(spark, rows, **options):
    table = spark.createDataFrame(rows, ROWS).selectExpr("*", "1 AS node", "'x' AS kind", "0 AS size", "2 AS salt").repartition(4)
    return sorted(map(tuple, vc.near_copies(table, **options).collect()), key=repr)


def spread(seed, count, size=32):
    return np.random.default_rng(seed).normal(size=(count, size))


def test_groups_of_near_copies(spark):
    random_ = np.random.default_rng(1)
    base = spread(2, 300)
    rows = [(at, base[at].tolist(), at % 3) for at in range(300)]
    for at in range(60):  # near copies, some under another label
        near = base[at] + random_.normal(size=32) * 0.1
        rows.append((300 + at, near.tolist(), (at + (at % 5 == 0)) % 3))
    rows += [(400 + at, base[7].tolist(), 1) for at in range(50)]  # equal ones
    rows += [(500 + at, (base[9] + random_.normal(size=32) * 0.08).tolist(), 0) for at in range(120)]
    wanted, got = expected(rows), found(spark, rows)
    assert sum(row[1] for row in got) >= 0.97 * sum(row[1] for row in wanted) and len(got) == len(wanted)
    links = {row[0]: row[1] for row in wanted}
    assert all(row[1] <= links[row[0]] for row in got)
    components = {row[0]: row[2] for row in wanted}
    assert sum(row[2] == components[row[0]] for row in got) >= 0.97 * len(got)


def test_chunks_of_a_bucket_lose_no_pair(spark):
    center = spread(3, 1)[0]
    rows = [(at, (center + spread(100 + at, 1)[0] * 0.02).tolist(), 1) for at in range(150)]
    assert found(spark, rows, chunk=20) == sorted(expected(rows), key=repr)


def test_odd_rows(spark):
    x, nan = spread(4, 1)[0].tolist(), float("nan")
    rows = [
        (1, x, 1), (2, x, 1), (2, x, 1), (None, x, 1), (None, x, 1), (3, x, None), (4, None, 1), (5, [], 1), (6, [0.0, 0.0], 1),
        (7, [nan, 1.0], 1), (8, [None, 1.0], 1), (9, [float("inf")], 1), (10, [1.0, 0.0], 2), (11, [2.0, 0.0], 2), (12, [-1.0, 0.0], 2),
        (13, [1e38, 0.0], 2), (14, [1e-38, 0.0], 2), (None, [0.5], 3), (15, [1.0, 0.0, 0.0], 2), (16, [-0.0, 1.0], 4), (17, [0.0, 1.0], 4),
        (None, None, None),
    ]
    wanted = [row[:3] + (row[0] is None and row[2] is None or row[3],) for row in expected(rows)]
    assert found(spark, rows) == sorted(wanted, key=repr)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_rotation_lowers_the_loss_and_uses_every_bit():
    vectors = vc.unit(spread(5, 2000, 16) * np.linspace(0.2, 2, 16))
    start = np.linalg.qr(np.random.default_rng(0).normal(size=(16, 16)))[0]

    def loss(rotation):
        turned = vectors @ rotation
        return ((np.where(turned >= 0, 1, -1) - turned) ** 2).sum()

    better = vc.iterative_quantisation(vectors, start)
    assert loss(better) < loss(start) and np.allclose(better @ better.T, np.eye(16))
    coder = vc.Coder.learn(list(vectors), 16, 10)
    ones = [(coder.keys(vectors) >> bit & 1).mean() for bit in range(16)]
    assert all(0.4 < share < 0.6 for share in ones)


@pytest.mark.parametrize("vectors", [1, 10_000, 10**9, 10**12])
def test_tables_meet_their_bound(vectors):
    width, tables = vc.table_shape(vectors, 0.98)
    agree = (1 - math.acos(0.98) / math.pi) ** width
    assert (1 - agree) ** tables <= vc.MISSED and vc.LEAST_WIDTH <= width <= vc.MOST_WIDTH


def test_scaling_keeps_every_bit():
    rows = np.array([[3e300, 1e290], [1e-300, 2e-301], [0.1, 0.7]])
    scaled = vc.scaled(rows)
    assert np.isfinite((scaled * scaled).sum()) and np.array_equal(scaled[:, 0] / scaled[:, 1], rows[:, 0] / rows[:, 1])


def test_the_sample_is_the_same_for_the_same_vectors(spark):
    chooser = random.Random(1)
    rows = [(at, [chooser.random() for _ in range(4)], 1) for at in range(50)]
    assert found(spark, rows) == found(spark, rows[::-1])
