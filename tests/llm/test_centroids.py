"""Centroid clustering against brute force."""

import hashlib
import random
from itertools import product

import numpy as np
import pytest

from ledgerloom.llm import centroids

SCHEMA = "vec_id bigint, embedding array<double>, cluster string, vector int, low int"


def slow(rows, count=40, rounds=5):
    """The same clustering with Python numbers."""
    kept = []
    for vec_id, vector in rows:
        if vector is not None and len(vector) == 64 and all(x is not None and np.isfinite(x) for x in vector):
            kept.append((vec_id, [int(np.floor(256 * x)) for x in vector]))

    def draw(row):
        return (row[0] is None, hashlib.sha256(f"2:{row[0]}".encode()).hexdigest() if row[0] is not None else "", row[1])

    current = [vector for _, vector in sorted(kept, key=draw)[:count]]
    for step in range(rounds + 1):
        near = []
        for _, vector in kept:
            apart = [sum((x - y) ** 2 for x, y in zip(vector, own, strict=True)) for own in current]
            near.append((min(apart), apart.index(min(apart))))
        for cluster in range(len(current) if step < rounds else 0):
            own = [vector for (_, vector), (_, at) in zip(kept, near, strict=True) if at == cluster]
            if own:
                current[cluster] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    inertia = {at: sum(far for far, one in near if one == at) for _, at in near}
    return [
        (vec_id, at, far, inertia[at], sum(inertia.values()), hashlib.sha256(",".join(map(str, current[at])).encode()).hexdigest())
        for (vec_id, _), (far, at) in zip(kept, near, strict=True)
    ]


def checked(spark, rows, count=40, statistics=None):
    frame = spark.createDataFrame([(*row, "clash", 1, 2) for row in rows], SCHEMA).repartition(3)
    found = [tuple(row) for row in centroids.cluster_vectors(frame, count, statistics=statistics).collect()]
    order = lambda row: (row[0] is None, row[0] or 0, *row[1:])
    assert sorted(found, key=order) == sorted(slow(rows, count), key=order)
    return found


def around(centers, size, spread, seed=1):
    draw = np.random.default_rng(seed)
    points = draw.normal(0, 3, (centers, 64))
    return [(n, (points[n % centers] + draw.normal(0, spread, 64)).tolist()) for n in range(size)]


def test_clusters_and_pruning(spark):
    """Groups far apart: the boxes leave few candidates, and nothing is lost."""
    statistics = []
    checked(spark, around(8, 3000, 0.05), 8, statistics)
    assert len(statistics) == 5
    blocks, asked = statistics[-1]
    assert asked < blocks * 8 / 2


def test_odd_vectors_are_left_out(spark):
    rows = around(3, 30, 1.0)
    whole = rows[0][1]
    rows += [
        (100, None), (101, []), (102, whole[:63]), (103, [*whole, 1.0]), (104, [None, *whole[1:]]),
        (105, [float("nan"), *whole[1:]]), (106, [float("inf"), *whole[1:]]), (107, [-0.0] * 64),
    ]
    found = checked(spark, rows)
    assert {row[0] for row in found} == {*range(30), 107}


def test_repeated_rows_ties_and_null_ids(spark):
    one, other = [0.0] * 64, [1.0] * 64
    middle = [0.5] * 64
    rows = [(n, [one, other, middle][n % 3]) for n in range(60)]
    rows += [(5, one), (5, one), (5, other), (None, one), (None, [9.0] * 64)] + [(7, middle)] * 300
    checked(spark, rows, 3)
    checked(spark, rows)


def test_large_components_are_exact(spark):
    draw = random.Random(1)
    rows = [(n, [1e12 + draw.randrange(100) for _ in range(64)]) for n in range(50)]
    checked(spark, rows, 4)
    rows = [(n, [float(draw.randrange(1 << 15)) for _ in range(64)]) for n in range(50)]
    checked(spark, rows, 4)


def test_too_large_components_are_an_error(spark):
    frame = spark.createDataFrame([(1, [1e30] * 64, "", 1, 2)], SCHEMA)
    with pytest.raises(Exception, match="62 bits"):
        centroids.cluster_vectors(frame).collect()


def test_empty_table_and_float_vectors(spark):
    assert centroids.cluster_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(n, [x / 7 for x in range(n, n + 64)]) for n in range(5)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    narrow = [(n, np.array(vector, np.float32).astype(float).tolist()) for n, vector in rows]
    assert sorted(tuple(row) for row in centroids.cluster_vectors(frame).collect()) == sorted(slow(narrow))


@pytest.mark.parametrize(("dimensions", "bits"), [(2, 4), (3, 2), (5, 1)])
def test_hilbert_neighbours_adjoin(dimensions, bits):
    """Along the curve every cell comes once, a step from the one before."""
    cells = np.array(list(product(range(1 << bits), repeat=dimensions)))
    keys = centroids.hilbert_keys(cells, bits)
    assert len(set(keys)) == len(cells)
    walk = cells[np.argsort(np.array(keys, object), kind="stable")]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_candidates_hold_every_nearest_centroid():
    draw = np.random.default_rng(4)
    for _ in range(200):
        own = draw.integers(-50, 50, (6, 3))
        others = draw.integers(-60, 60, (9, 3))
        apart = ((own[:, None] - others[None]) ** 2).sum(2)
        best = {at for row in apart for at in np.flatnonzero(row == row.min()).tolist()}
        assert best <= set(centroids.candidates(own.min(0), own.max(0), others).tolist())
