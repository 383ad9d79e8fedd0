"""Hard negatives against brute force and against their SQL."""

import duckdb
import numpy as np
from pyspark.sql import functions as F

from snaptrack.llm import negatives
from tests.compare import duck_rows, spark_rows
from tests.conftest import SMALL

SCHEMA = "vec_id long, embedding array<float>, label int, score string, block int, slot string"


def frame(spark, rows):
    return spark.createDataFrame([(*row, "s", 7, "x") for row in rows], SCHEMA)


def brute(rows, positives=negatives.POSITIVES, k=negatives.K):
    good = [
        (i, np.floor(np.array(v, np.float32).astype(float) * negatives.SCALE).astype(int), label)
        for i, v, label in rows
        if i is not None and v and label is not None and None not in v and np.isfinite(v).all()
    ]
    out = []
    for at, (anchor, a, label) in enumerate(good):
        if anchor % 100:
            continue
        others = [
            (-int(a @ b), i, other)
            for n, (i, b, other) in enumerate(good)
            if n != at and len(a) == len(b)
        ]
        near = sorted((s, i) for s, i, other in others if other == label)[:positives]
        for p, positive in near:
            inside = sorted(
                (s, i) for s, i, other in others if other != label and 30 * -p <= 100 * -s <= 90 * -p
            )[:k]
            out += [(anchor, positive, r, i, -p, -s) for r, (s, i) in enumerate(inside, 1)]
    return sorted(out)


def run(spark, rows, **options):
    found = negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0, **options)
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(row[n] for n in names) for row in found.collect())


def test_random_ties_and_blocks(spark):
    rng = np.random.default_rng(11)
    rows = [
        (i, (rng.normal(size=6) * 0.4 + 0.2).round(1).tolist(), int(rng.integers(3)))
        for i in range(900)
    ]
    rows += [(1000 + i, rows[5][1], i % 2) for i in range(120)]
    expected = brute(rows)
    assert expected and run(spark, rows) == expected
    assert run(spark, rows, anchor_block=3, candidate_block=50) == expected


def test_repeated_ids_nulls_and_lengths(spark):
    rows = [
        (0, [1.0, 0.5], 1), (0, [0.5, 1.0], 1), (0, [0.25, 0.25], 2), (0, [1.0, 0.5], 1),
        (1, [0.5, 0.5], 1), (2, [0.4, 0.4], 2), (2, [0.4, 0.4], 2), (3, None, 1), (4, [], 1),
        (5, [1.0, None], 2), (6, [float("nan"), 1.0], 2), (7, [float("inf"), 0.0], 2),
        (8, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (9, [0.3, 0.3, 0.3], 2),
        (100, [0.5, 0.5, 0.5], 2), (200, [0.0, 0.0], 5), (10, [0.0, 1.0], 5), (300, [-1.0, -1.0], 1),
    ]
    expected = brute(rows)
    assert expected and run(spark, rows) == expected
    assert run(spark, []) == [] and run(spark, rows[:1]) == [] and run(spark, rows[7:9]) == []


def test_scores_beyond_floating_point(spark):
    big = 2.0**20
    rows = [(0, [big, 1.0], 1), (1, [big, 0.0], 1)] + [
        (i + 2, [big / 2, i / 256], 2) for i in range(30)
    ]
    assert run(spark, rows) == brute(rows)


def test_hot_label_and_one_vector_for_a_third(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).round(1).tolist(), 0 if i % 3 else i % 4) for i in range(600)]
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5], 3) for i in range(300)]
    assert run(spark, rows, candidate_block=64) == brute(rows)


def test_query_matches_its_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"create view embeddings as select * from '{SMALL}/embeddings.parquet'")
    found = spark_rows(negatives.op11(spark, SMALL))
    assert found == duck_rows(duck, negatives.ORACLE) and found[1]
