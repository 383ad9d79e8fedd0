"""Rows that were given another key, and summaries that merge."""

import random

import pytest
from pyspark.sql import functions as F

import snaptrack as st

RUN, LATER = "2024-06-01", "2024-07-01"
SCHEMA = "k int, l string, a string, b double, m map<string,int>"


def plain(new, old):
    """Pairs of keys of unmatched rows with equal values, in key order."""
    def values(row):
        return repr((row[2], row[3], sorted((row[4] or {}).items()) if row[4] is not None else None))

    new_keys, old_keys = {r[:2] for r in new}, {r[:2] for r in old}
    came = sorted(r for r in ((r[:2], values(r)) for r in new) if r[0] not in old_keys)
    went = sorted(r for r in ((r[:2], values(r)) for r in old) if r[0] not in new_keys)
    found = []
    for value in {v for _, v in came}:
        found += zip([k for k, v in came if v == value], [k for k, v in went if v == value])
    return sorted(a + b for a, b in found)


@pytest.mark.parametrize("seed", range(3))
def test_moves_against_brute_force(spark, seed):
    rng = random.Random(seed)
    kinds = [("x", 1.0, {"p": 1, "q": 2}), ("x", None, None), (None, None, {}), ("y", float("nan"), {"q": 2, "p": 1}), ("y", 2.5, None)]

    def snapshot():
        keys = {(rng.randrange(40), rng.choice("ab")) for _ in range(50)}
        return [(*key, *rng.choice(kinds)) for key in sorted(keys)]

    new, old = snapshot(), snapshot()
    recent = spark.createDataFrame(new, SCHEMA)
    history = st.open_rows(spark.createDataFrame(old, SCHEMA), "2024-01-01")
    found = st.moved_keys(recent, history, ["k", "l"])
    assert found.columns == ["k", "l", "previous_k", "previous_l"]
    expected = plain(new, old)
    assert sorted(map(tuple, found.collect())) == expected and expected
    events = st.classify_with_moves(recent, history, ["k", "l"]).collect()
    moved = {(r.k, r.l, r.previous_k, r.previous_l) for r in events if r.event == "moved"}
    assert moved == set(expected)
    names = [(r.k, r.l) for r in events]
    assert len(names) == len(set(names))
    assert {(r.k, r.l) for r in events if r.event == "missing"} == (
        {r[:2] for r in old} - {r[:2] for r in new} - {r[2:] for r in expected}
    )


def test_values_of_a_third_of_all_rows(spark):
    """All of them moved by a thousand: the n-th goes with the n-th, and no window holds them."""
    rows = spark.range(9000).selectExpr("id as k", "if(id % 3 = 0, 'same', 'v' || id) as v")
    history = st.open_rows(rows, "2024-01-01")
    recent = rows.selectExpr("k + 100000 as k", "v")
    found = st.moved_keys(recent, history, "k")
    assert found.filter("k = previous_k + 100000").count() == found.count() == 9000
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()


def test_moves_of_nothing(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    history = st.open_rows(rows, "2024-01-01")
    assert st.moved_keys(rows, history, "k").count() == 0
    assert st.moved_keys(rows.limit(0), history, "k").count() == 0
    assert st.moved_keys(rows, history.limit(0), "k").count() == 0
    # A table of keys alone has rows that are all alike.
    keys = rows.select("k")
    found = st.moved_keys(keys.selectExpr("k + 5 as k"), st.open_rows(keys, "2024-01-01"), "k")
    assert sorted(map(tuple, found.collect())) == [(6, 1), (7, 2)]


def history_of(spark, runs):
    """Runs of ``(date, key, column, new, old)`` edits."""
    text = F.to_json(F.create_map("c", F.array("new", "old")))
    rows = spark.createDataFrame(runs, "day string, k int, c string, new string, old string")
    return rows.select(
        "k", F.lit("v").alias("v"), F.lit(1.5).alias("n"), F.lit(False).alias("is_active"),
        F.lit("2023-01-01").cast("date").alias("valid_from"), F.col("day").cast("date").alias("valid_to"),
        text.alias("changes"),
    )


def test_merged_runs_are_one_run(spark):
    rng = random.Random(1)
    runs = [
        (rng.choice([RUN, LATER, "2024-08-01"]), rng.randrange(3000), c, str(rng.random() * 100), "50")
        for c in ("v", "n") for _ in range(6000)
    ]
    summaries = st.run_summaries(history_of(spark, runs), "k")
    assert summaries.count() == 6
    for since, until in ((None, None), (RUN, LATER), (LATER, LATER), ("2025-01-01", None)):
        merged = {r.column_name: r for r in st.merge_summaries(summaries, since, until).collect()}
        chosen = [r for r in runs if (since or "") <= r[0] <= (until or "9")]
        assert set(merged) == {r[2] for r in chosen}
        for name, row in merged.items():
            mine = [r for r in chosen if r[2] == name]
            assert row.edit_count == len(mine)
            keys = len({r[1] for r in mine})
            assert abs(row.key_count - keys) <= 0.05 * keys
            if name == "v":
                assert row.differences is None  # text, whatever it looks like
                continue
            ordered = sorted(float(r[3]) - 50 for r in mine)
            for quantile, value in zip((0.1, 0.5, 0.9), row.differences):
                rank = sum(x <= value for x in ordered) / len(ordered)
                assert abs(rank - quantile) < 0.03


def test_summaries_of_odd_cells(spark):
    runs = [(RUN, 1, "n", None, "1"), (RUN, 1, "n", "NaN", "1"), (RUN, 2, "gone", "a", "b"), (RUN, None, "n", "3", "1")]
    merged = {r.column_name: r for r in st.merge_summaries(st.run_summaries(history_of(spark, runs), "k")).collect()}
    assert merged["n"].edit_count == 3 and merged["n"].differences == [2.0, 2.0, 2.0]
    assert merged["gone"].differences is None
    empty = st.run_summaries(history_of(spark, runs).limit(0), "k")
    assert empty.count() == 0 and st.merge_summaries(empty).count() == 0
