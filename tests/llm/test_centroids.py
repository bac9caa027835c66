import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from wordweft.llm import centroids


def brute(rows, count=40, rounds=5, components=64):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest())
    centres = [list(v) for _, v in order[:count]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        held = defaultdict(list)
        for _, v in kept:
            held[nearest(v)[1]].append(v)
        for k, vs in held.items():
            centres[k] = [sum(x) // len(vs) for x in zip(*vs)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = defaultdict(int)
    for _, k, d in found:
        inertia[k] += d
    return [(i, k, d, inertia[k], sum(inertia.values()), hashlib.sha256(",".join(map(str, centres[k])).encode()).hexdigest()) for i, k, d in found]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id bigint, embedding array<float>, label int, cluster string").repartition(3)


def test_equals_brute_force_with_ties_and_odd_rows(spark):
    rng = np.random.default_rng(6)
    rows = [(k, np.float32(v).tolist()) for k, v in enumerate(rng.normal(0, 0.2, (300, 64)))]
    rows += [(1000 + k, rows[5][1]) for k in range(60)] + [(2000, [0.5] * 63), (2001, [0.5] * 63 + [None]), (2002, [0.1] * 63 + [math.nan]),
                                                       (2003, [0.1] * 63 + [math.inf]), (2004, None), (2005, [0.0] * 64), (2006, [-0.0] * 64),
                                                       (None, [0.25] * 64), (2007, [0.1] * 65)]
    found = centroids.report(*centroids.cluster(frame(spark, rows))).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, brute(rows)))


def test_search_is_exact_and_skips():
    rng = np.random.default_rng(9)
    centres = rng.integers(-80, 80, (40, 64)) + rng.integers(-60, 60, (40, 1))
    centres[7] = centres[3]
    x = rng.integers(-80, 80, (2000, 64)) + rng.integers(-60, 60, (2000, 1))
    search = centroids.OutwardSearch(centres)
    number, distance = search.nearest(x)
    full = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (number == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
    assert search.measured < 0.8 * full.size


def test_few_and_huge(spark):
    huge = [(1, [3e38] * 64), (2, [-3e38] * 64), (3, [0.0] * 64)]
    found, centres = centroids.cluster(frame(spark, huge))
    assert centres.shape == (3, 64) and centres.max() == centroids.LIMIT
    assert all(r["distance"] == 0 for r in found.collect())
    assert centroids.report(*centroids.cluster(frame(spark, [(1, [0.5])]))).count() == 0


def test_farthest_distance_fits(spark):
    far = centroids.OutwardSearch(np.full((1, 64), -centroids.LIMIT)).nearest(np.full((1, 64), centroids.LIMIT))
    assert far[1][0] == 64 * (2 * centroids.LIMIT) ** 2


@pytest.mark.parametrize("count", [0])
def test_empty_table(spark, count):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert centroids.report(*centroids.cluster(empty)).count() == count
