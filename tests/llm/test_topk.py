"""Exact top-k against brute force."""

import numpy as np
from pyspark.sql import functions as F

from snaptrack.llm import topk


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def brute(rows, k=topk.K):
    good = [
        (i, np.floor(np.array(v, np.float32).astype(float) * topk.SCALE).astype(int))
        for i, v, _ in rows
        if v is not None and None not in v and np.isfinite(v).all()
    ]
    out = []
    for at, (q, a) in enumerate(good):
        if q % 100 == 0:
            found = sorted((-int(a @ b), i) for n, (i, b) in enumerate(good) if n != at)[:k]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(found, 1)]
    return sorted(out)


def run(spark, rows, **options):
    found = topk.top_k(vectors(spark, rows), F.col("vec_id") % 100 == 0, **options)
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect())


def test_random_blocks_and_ties(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=8) * 0.3).round(1).tolist(), 0) for i in range(1500)]
    rows += [(2000 + i, rows[7][1], 0) for i in range(150)]
    found = run(spark, rows, query_block=4, candidate_block=100)
    assert found == brute(rows)


def test_rows_of_one_id(spark):
    """Each is a query of its own, and a candidate of the others."""
    rows = [(0, [1.0, 0.0], 0), (0, [0.0, 1.0], 0), (1, [1.0, 0.0], 0), (2, [0.0, 0.5], 0)]
    assert run(spark, rows) == brute(rows) and len(brute(rows)) == 6
    rng = np.random.default_rng(8)
    rows = [(i % 40 * 50, rng.normal(size=3).round(1).tolist(), 0) for i in range(300)]
    assert run(spark, rows, candidate_block=20) == brute(rows)


def clusters(rng, count, spread):
    """Vectors around 40 far centres."""
    centres = rng.normal(size=(40, 16))
    centres *= 3 / np.linalg.norm(centres, axis=1)[:, None]
    place = rng.integers(0, 40, count)
    return [(i, row.tolist(), 0) for i, row in enumerate(centres[place] + rng.normal(size=(count, 16)) * spread)]


def test_clustered_vectors_are_mostly_not_evaluated(spark):
    rows = clusters(np.random.default_rng(1), 4000, 0.02)
    assert run(spark, rows) == brute(rows)
    counts = topk.top_k(vectors(spark, rows), F.col("vec_id") % 100 == 0, evaluated=True).collect()
    share = sum(r["evaluated"] for r in counts) / (40 * 3999)
    assert len(counts) == 40 and share < 0.2, share


def test_a_clashing_column_is_not_read(spark):
    rows = [(i, [float(i), 1.0], 0) for i in range(5)]
    frame = vectors(spark, rows).selectExpr("*", "1 as block", "2 as keys", "3 as _row", "4 as score")
    found = topk.top_k(frame, F.col("vec_id") % 100 == 0).collect()
    assert sorted(tuple(r) for r in found) == brute(rows)


def test_bad_rows(spark):
    rows = [
        (0, [1.0, 2.0], 0), (1, None, 0), (2, [1.0, None], 0), (3, [float("nan"), 1.0], 0),
        (4, [float("inf"), 0.0], 0), (5, [-0.5, 0.25], 0), (100, [0.0, 0.0], 0),
    ]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == [] and run(spark, rows[1:2]) == []
    assert run(spark, [(0, [1.0], 0)]) == []


def test_bound_holds():
    rng = np.random.default_rng(5)
    a, b, p = (rng.integers(-3000, 3000, (n, 16)) for n in (40, 300, 8))
    bound = topk.upper_bounds(a, topk.distances(a, p), b, topk.distances(b, p))
    assert (bound >= a @ b.T).all()
