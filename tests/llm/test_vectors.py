"""Embedding near-duplicates against all pairs in double precision."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import vectors

from .fixtures import embeddings
from .test_texts import components, named


def brute(rows):
    def unit(v, label):
        if v is None or label is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, np.float32).astype(np.float64)
        return x / np.linalg.norm(x)
    units = [unit(v, l) for _, v, l, _ in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i)
            if units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2]
            and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.98]
    n = Counter(x for p in near for x in p)
    ids = [r[0] for r in rows]
    return Counter((i, n[k]) for k, i in enumerate(ids)), named(ids, components(len(rows), near))


def check(spark, rows, **how):
    got = vectors.cluster(embeddings(spark, rows), **how).collect()
    links, names = brute(rows)
    assert Counter((r.vec_id, r.n_links) for r in got) == links
    assert Counter((r.vec_id, r.component_id) for r in got) == names
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_clusters_copies_and_blocks(spark):
    rng, rows = np.random.default_rng(4), []
    for label in (0, 1, None):
        for c in range(12):
            centre = rng.standard_normal(24)
            for _ in range(int(rng.integers(1, 12)) if c else 70):
                v = centre + rng.standard_normal(24) * 0.1
                rows += [(0, v.astype(np.float32).tolist(), label, None)] * int(rng.integers(1, 3))
    rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    check(spark, rows)
    check(spark, rows, block=16)


def test_awkward_vectors(spark):
    v = [1.0, 2.0, 3.0]
    check(spark, [(1, v, 1, None), (2, v, 1, None), (3, v, 2, None), (4, v, None, None), (5, None, 1, None),
                  (6, [], 1, None), (7, [0.0, 0.0, 0.0], 1, None), (8, [0.0, 0.0, 0.0], 1, None),
                  (9, [float("nan"), 1.0, 2.0], 1, None), (10, [float("inf"), 1.0, 2.0], 1, None),
                  (11, [1.0, None, 3.0], 1, None), (12, [2.0, 4.0, 6.0], 1, None), (13, [1.0, 2.0], 1, None),
                  (14, [2.0, 4.0], 1, None), (15, [-0.0, 1.0, 0.0], 3, None), (16, [0.0, 1.0, 0.0], 3, None)])


def test_invalid_vector_beside_its_valid_part(spark):
    check(spark, [(1, [1.0, None, 3.0], 1, None), (2, [1.0, 3.0], 1, None), (3, [1.0, 3.0], 1, None)])


def test_no_vectors(spark):
    check(spark, [])


def test_double_vectors_stay_double(spark):
    rows = [(1, [1.0, 1e-9, 0.0], 1), (2, [1.0, 2e-9, 0.0], 1), (3, [0.0, 1.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.cluster(df).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3)}


def noisy(rng, centre, cosine):
    """A unit vector at exactly ``cosine`` to the unit vector ``centre``."""
    away = rng.standard_normal(len(centre))
    away -= (away @ centre) * centre
    return cosine * centre + np.sqrt(1 - cosine ** 2) * away / np.linalg.norm(away)


@pytest.mark.parametrize("window,passes,block", [(1, 1, 8), (3, 2, 16), (500, 3, 4096)])
def test_any_window_is_completed(spark, window, passes, block):
    """Whatever the passes see, pairs count once: in a window, on its border, or in the completion."""
    rng, rows = np.random.default_rng(9), []
    for c in range(40):
        centre = rng.standard_normal(16)
        rows += [(len(rows) + k, (centre + rng.standard_normal(16) * 0.08).tolist(), c % 3, None) for k in range(c % 9 + 1)]
    check(spark, rows, window=window, passes=passes, block=block)


def test_recall_of_the_passes(spark):
    """Vectors whose id is divisible by 20 against all rows: the passes alone find over
    nine in ten of the links; clusters of up to 400 among twice as many single vectors."""
    rng, rows = np.random.default_rng(11), []
    for size in (400, 150, 60, 20, 8, 3) * 2 + (1,) * 2_400:
        centre = rng.standard_normal(64)
        rows += [(len(rows) + k, (centre + rng.standard_normal(64) * 0.11).tolist(), 1, None) for k in range(size)]
    got = vectors.cluster(embeddings(spark, rows)).where("vec_id % 20 = 0").agg(
        F.sum("n_by_passes").alias("found"), F.sum("n_links").alias("links")).first()
    assert got.links > 1_000 and got.found >= 0.9 * got.links
    print(f"recall of the passes: {got.found} of {got.links}")


def test_star_group(spark):
    """Copies near the original, not near each other: all reach its component."""
    rng, n = np.random.default_rng(5), 2000
    centre = rng.standard_normal(64)
    centre /= np.linalg.norm(centre)
    rows = [(0, centre.tolist(), 1, None)] + [(i, noisy(rng, centre, 0.983).tolist(), 1, None) for i in range(1, n + 1)]
    got = {r.vec_id: r for r in vectors.cluster(embeddings(spark, rows)).collect()}
    assert got[0].n_links == n and {r.component_id for r in got.values()} == {0}
    assert min(r.n_links for r in got.values()) >= 1


def test_concentrated_label(spark):
    """One label whose vectors all lie close (cosine 0.9) and a few pairs are near."""
    rng, rows = np.random.default_rng(6), []
    centre = rng.standard_normal(64)
    centre /= np.linalg.norm(centre)
    for _ in range(1500):
        v = noisy(rng, centre, 0.9 ** 0.5)
        rows += [v, noisy(rng, v / np.linalg.norm(v), 0.9805)]
    rows = [(i, v.tolist(), 1, None) for i, v in enumerate(rows)]
    x = np.array([v for _, v, _, _ in rows], np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.98
    np.fill_diagonal(near, False)
    for how in ({}, {"block": 200}):
        got = vectors.cluster(embeddings(spark, rows), **how).collect()
        assert {r.vec_id: r.n_links for r in got} == dict(enumerate(near.sum(0)))
        i, j = np.nonzero(near)
        assert {r.vec_id: r.component_id for r in got} == dict(enumerate(np.array(components(len(rows), list(zip(i, j))))))
