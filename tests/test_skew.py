"""One key, or no key, on a third of the rows."""

import pytest
from pyspark.sql import functions as F

import snaptrack as st
from tests.plan_text import main_part, physical
from tests.test_cases import FAILURE

ROWS = 30_000
RUN = "2024-06-01"


def test_third_of_the_snapshot_without_key(spark):
    recent = spark.range(ROWS).selectExpr("if(id % 3 = 0, null, id) as k", "id as v")
    history = st.open_rows(recent, "2024-01-01")
    result = st.build_history(recent, history, "k", RUN)
    assert result.count() == ROWS
    assert st.key_violations(recent, "k").collect()[0].row_count == ROWS // 3
    # Rows without a key are filtered out below the shuffle of the join.
    shuffled = main_part(st.classify(recent, history, "k")).split("Exchange")[1:]
    assert len(shuffled) == 2 and all("Filter NOT" in side for side in shuffled)


def test_third_of_the_snapshot_under_one_key_fails_before_the_join(spark):
    recent = spark.range(ROWS).selectExpr("if(id % 3 = 0, 0, id) as k", "id as v")
    history = st.open_rows(spark.range(10).selectExpr("id as k", "id as v"), "2024-01-01")
    with pytest.raises(FAILURE, match="1 in the snapshot"):
        st.build_history(recent, history, "k", RUN).collect()
    first = st.build_history(
        recent, history, "k", RUN, mode="delta", on_duplicate="keep_first", order_by="v"
    )
    assert first.filter("k = 0").count() == 0  # its first row equals the stored one
    assert first.count() == ROWS - ROWS // 3 - 6


def test_first_of_a_hot_key_is_taken_before_the_shuffle(spark):
    recent = spark.range(ROWS).selectExpr("if(id % 3 = 0, 0, id) as k", "id as v")
    history = st.open_rows(recent.limit(0), "2024-01-01")
    plan = physical(
        st.classify(recent, history, "k", on_duplicate="keep_first", order_by="v")
    )
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.fixture(scope="module")
def hot_history(spark):
    """Key 0 has a third of all versions, many of them copies of each other."""
    return spark.range(ROWS).select(
        F.expr("if(id % 3 = 0, 0, id)").alias("k"),
        F.lit("v").alias("v"),
        F.lit(False).alias("is_active"),
        F.expr("date_add(date '2000-01-01', int(pmod(id, 900)))").alias("valid_from"),
        F.expr("date_add(date '2000-01-02', int(pmod(id, 900)))").alias("valid_to"),
        F.lit('{"v":["w","v"]}').alias("changes"),
    )


def test_timeline_of_a_hot_key(spark, hot_history):
    result = st.timeline(hot_history, "k")
    assert result.count() == ROWS
    hot = result.filter("k = 0")
    assert hot.count() == ROWS // 3
    numbers = hot.select("version_number", "valid_from", "previous_from").distinct()
    # 900 days, every third of which key 0 has: one number each.
    assert numbers.count() == 300
    gaps = numbers.filter("version_number > 1").selectExpr("datediff(valid_from, previous_from) d")
    assert {r.d for r in gaps.collect()} == {3}


def test_window_runs_over_dates_not_rows(spark, hot_history):
    plan = physical(st.timeline(hot_history, "k"))
    window = plan[plan.index("Window ") :]
    assert "HashAggregate" in window, "the window must see distinct periods"


def test_closed_rows_of_a_hot_key_do_not_join(spark, hot_history):
    active = st.open_rows(spark.range(10).selectExpr("id as k", "'v' as v"), "2024-01-01")
    history = st.union_all([hot_history, active])
    recent = spark.range(10).selectExpr("id as k", "'w' as v")
    result = st.build_history(recent, history, "k", RUN)
    assert result.count() == ROWS + 20
    assert st.column_change_counts(result).collect()[0].edit_count == ROWS + 10
    assert st.explode_changes(result, "k").count() == ROWS + 10


def test_hot_key_in_key_filter(spark, hot_history):
    ids = spark.range(ROWS).selectExpr("if(id % 3 = 0, 0, id + 1000000) as k")
    assert st.rows_with_keys(hot_history, ids, "k").count() == ROWS // 3


def test_sort_splits_a_hot_key(spark, hot_history):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        result = st.union_all([hot_history.limit(0), hot_history], order_by="k")
        assert result.columns == hot_history.columns
        parts = result.withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r.k for r in parts] == sorted(r.k for r in parts)
    sizes = {}
    for row in parts:
        sizes[row.part] = sizes.get(row.part, 0) + 1
    # Four partitions: a third of the rows under one key does not fill one of them.
    assert max(sizes.values()) < ROWS // 3
