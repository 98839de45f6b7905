import hashlib
import math
import random

import numpy as np
import pytest

from settleline.llm import centroids

from .llm_helpers import SF, clash

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, clusters, rounds, dim, scale=64, seed=1):
    """Plain k-means in Python integers over the usable rows."""
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in e]) for i, e in rows
            if e is not None and len(e) == dim and all(x is not None and math.isfinite(x) for x in e)]
    first = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centres = [v for _, v in first[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(nearest(v)[1], []).append(v)
        centres = [[sum(col) // len(own[n]) for col in zip(*own[n])] if n in own else c for n, c in enumerate(centres)]
    out = [(i, nearest(v)[1], nearest(v)[0]) for i, v in kept]
    total = sum(d for *_, d in out)
    inertia = {n: sum(d for _, m, d in out if m == n) for n in range(len(centres))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    key = lambda r: (r[0] is None, r)
    return sorted(((i, n, d, inertia[n], total, digest[n]) for i, n, d in out), key=key)


def got(spark, rows, schema=VECTORS, **kw):
    df = spark.createDataFrame([(i, e, 0) for i, e in rows], schema)
    return sorted((tuple(r) for r in centroids.clusters_with_inertia(df, **kw).collect()), key=lambda r: (r[0] is None, r))


def test_equals_plain_k_means_on_the_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    out = sorted(tuple(r) for r in centroids.clusters_with_inertia(df.repartition(7)).collect())
    assert out == brute(rows, 16, 3, 64)
    assert len(out) > 100


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ties_repeats_and_many_centroids(spark, seed):
    rng = random.Random(seed)
    # few distinct values: many equal means, equal distances and empty clusters
    rows = [(rng.randrange(40), [rng.choice([-0.03, 0.0, 0.0, 0.02, 1.0]) for _ in range(4)]) for _ in range(150)]
    rows += rows[:20]
    assert got(spark, rows, clusters=23, rounds=3, dim=4) == brute(rows, 23, 3, 4)


def test_unusable_vectors_are_left_out(spark):
    good = [(i, [i / 10, -i / 7, 0.5]) for i in range(9)]
    bad = [(20, None), (21, []), (22, [1.0, 2.0]), (23, [1.0, 2.0, 3.0, 4.0]), (24, [1.0, None, 2.0]), (25, [1.0, math.nan, 2.0]),
           (26, [math.inf, 0.0, 0.0]), (27, [0.0, 0.0, -math.inf])]
    rows = good + bad + [(None, [0.1, 0.2, 0.3])]
    out = got(spark, rows, clusters=4, rounds=2, dim=3)
    assert out == brute(rows, 4, 2, 3)
    assert out[-1][0] is None and len(out) == 10


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [0.5, 0.5]), (2, [-0.5, 0.5])]
    assert got(spark, rows, dim=2) == brute(rows, 16, 3, 2)
    assert got(spark, [], dim=2) == [] and got(spark, [(1, [1.0])], dim=2) == []


def test_huge_components_stay_exact(spark):
    rows = [(i, [float(np.float32(3e38 / (i + 1))), float(i), -1e20 * i]) for i in range(6)] + [(10 + i, [i * 0.1, 1.0, 2.0]) for i in range(6)]
    df = spark.createDataFrame([(i, e, 0) for i, e in rows], VECTORS)
    out = {r["vec_id"]: r for r in centroids.clusters_with_inertia(df, clusters=3, dim=3).collect()}
    want = {r[0]: r for r in brute(rows, 3, 3, 3)}
    for i, r in out.items():
        assert r["cluster"] == want[i][1] and r["centroid_sha256"] == want[i][5]
        assert r["distance"] == (want[i][2] if want[i][2] < 1 << 63 else None)
        assert r["inertia"] is None


def test_search_agrees_with_all_distances():
    rng = np.random.default_rng(5)
    for dim, k in ((1, 5), (3, 40), (64, 16)):
        x = rng.integers(-9, 9, (500, dim))
        c = np.concatenate([rng.integers(-9, 9, (k - 2, dim)), x[:1], x[:1]])
        d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        number, least = centroids.Centroids(c.tolist(), dim).nearest(x)
        assert (number == d.argmin(axis=1)).all() and (least == d.min(axis=1)).all()


def test_clashing_columns_and_batches(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    a = sorted(map(tuple, centroids.clusters_with_inertia(clash(df)).collect()))
    b = sorted(map(tuple, centroids.clusters_with_inertia(df.repartition(3)).collect()))
    assert a == b
