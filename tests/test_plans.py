"""The plans are the ones the operators are written for."""

import pytest

import snaptrack as st
from snaptrack.registry import spark_queries
from snaptrack.registry.scenarios import ORDERS, RUN_DATE, frames
from tests.conftest import SMALL
from tests.plan_text import count, main_part, physical

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


@pytest.fixture
def stored(spark, tmp_path):
    """Snapshot and history as plain tables, the history partitioned by its flag."""
    recent, history = frames(spark, SMALL, ORDERS)
    recent.write.parquet(f"{tmp_path}/recent")
    table = st.HistoryTable(f"{tmp_path}/history")
    table.write(history, "2024-01-01")
    return spark.read.parquet(f"{tmp_path}/recent"), table


@pytest.fixture
def no_broadcast(spark):
    """Plans as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_history_build_is_one_join(spark, stored, no_broadcast):
    recent, table = stored
    result = st.build_history(recent, table.read(spark), ORDERS.key, RUN_DATE)
    plan = main_part(result)
    assert count(plan, "SortMergeJoin") == 1 and "FullOuter" in plan
    assert count(plan, "Exchange") == 2
    assert count(plan, "Generate") == 1
    assert "Window" not in plan
    # snapshot, active versions, closed versions, versions without a key
    assert count(plan, "FileScan") == 4


def test_delta_needs_no_full_join(spark, stored, no_broadcast):
    recent, table = stored
    result = st.build_history(recent, table.read(spark), ORDERS.key, RUN_DATE, mode="delta")
    plan = main_part(result)
    assert "LeftOuter" in plan and "FullOuter" not in plan
    assert count(plan, "FileScan") == 3


def test_sort_only_on_request(spark, stored, no_broadcast):
    recent, table = stored
    args = (recent, table.read(spark), ORDERS.key, RUN_DATE)
    assert "rangepartitioning" not in physical(st.build_history(*args))
    assert "rangepartitioning" in physical(st.build_history(*args, sort=True))


def test_no_python_in_any_query(spark):
    for name, query in spark_queries.queries().items():
        plan = physical(query(spark, SMALL))
        assert not any(node in plan for node in PYTHON_NODES), name
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_diff_reads_only_active_directories(spark, stored):
    recent, table = stored
    history = table.read(spark)
    for frame in (st.active_rows(history), st.closed_rows(history)):
        plan = physical(frame)
        assert "PartitionFilters: []" not in plan
        flags = {row.is_active for row in frame.select("is_active").distinct().collect()}
        assert len(flags) == 1
    active = {path.split("/")[-2] for path in st.active_rows(history).inputFiles()}
    assert "is_active=true" in active


def test_key_check_reads_only_keys(spark, stored):
    recent, table = stored
    plan = physical(st.edited_rows(recent, table.read(spark), ORDERS.key, RUN_DATE))
    schemas = [part.split(">")[0] for part in plan.split("ReadSchema: struct<")[1:]]
    assert "o_orderkey:bigint" in schemas
    assert "o_orderkey:bigint,valid_from:date" in schemas


def test_trusted_history_is_not_checked(spark, stored):
    recent, table = stored
    args = (recent, table.read(spark), ORDERS.key)
    assert "valid_from:date" not in physical(st.classify(*args, trusted_history=True))
    assert "Subquery" not in physical(st.classify(*args, on_duplicate="trust"))


def test_filters_reach_the_scan(spark, stored):
    _, table = stored
    plan = physical(st.as_of(table.read(spark), "2024-02-01"))
    assert "LessThanOrEqual(valid_from,2024-02-01)" in plan
    plan = physical(st.explode_changes(table.read(spark), ORDERS.key))
    assert "IsNotNull(changes)" in plan
    assert "o_orderdate" not in plan.split("ReadSchema")[-1]


def test_new_rows_read_only_keys_of_the_history(spark, stored):
    recent, table = stored
    plan = physical(st.new_rows(recent, table.read(spark), ORDERS.key, RUN_DATE))
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan
    assert "LeftOuter" in plan


def test_bucketed_tables_join_without_exchange(spark, tmp_path, no_broadcast):
    recent, history = frames(spark, SMALL, ORDERS)
    active = st.active_rows(history)
    for name, frame in (("plan_recent", recent), ("plan_active", active)):
        st.write_bucketed(frame, name, ORDERS.key, 4, f"{tmp_path}/{name}")
    sides = spark.table("plan_recent"), spark.table("plan_active")
    result = st.run_rows(*sides, ORDERS.key, RUN_DATE)
    assert count(main_part(result), "Exchange") == 0
    half = st.run_rows(recent, sides[1], ORDERS.key, RUN_DATE)
    assert count(main_part(half), "Exchange") == 1
    # Rows of that join are in their buckets: written back, each bucket is one file again.
    st.write_bucketed(st.active_rows(result), "plan_next", ORDERS.key, 4, f"{tmp_path}/next", colocated=True)
    again = st.run_rows(recent, spark.table("plan_next"), ORDERS.key, "2024-07-01")
    assert count(main_part(again), "Exchange") == 1
    assert len(spark.table("plan_next").inputFiles()) <= 4
    for name in ("plan_recent", "plan_active", "plan_next"):
        spark.sql(f"drop table {name}")


def test_buckets_follow_the_size_in_memory(spark, tmp_path):
    """Rows that all but vanish in a file still fill the memory of the task that sorts them."""
    rows = spark.range(4000).selectExpr("id", "repeat('a', 1000) as note", "array(id, null) as ids")
    rows.union(spark.sql("select null, null, null")).write.parquet(f"{tmp_path}/rows")
    stored = spark.read.parquet(f"{tmp_path}/rows")
    least = 4000 * (8 + 3 * 8 + 1000)
    assert least // 65_536 <= st.buckets_for(stored, 65_536) <= 1.1 * least // 65_536
    assert st.buckets_for(stored, 2 * least) == st.buckets_for(stored.limit(0)) == 1


def test_key_filter_shuffles_thinned_ids(spark, stored, no_broadcast):
    """Both inputs of the semi join are plain shuffles, which AQE can split."""
    recent, table = stored
    plan = physical(st.rows_with_keys(table.read(spark), recent, ORDERS.key))
    assert "LeftSemi" in plan and "ReadSchema: struct<o_orderkey:bigint>" in plan
    above = plan[: plan.index("HashAggregate")]
    assert count(above, "Exchange") == 2


def test_daily_run_shuffles_the_snapshot_only(spark, tmp_path, no_broadcast):
    recent, history = frames(spark, SMALL, ORDERS)
    table = st.HistoryTable(f"{tmp_path}/h", key=ORDERS.key, buckets=4)
    table.write(st.ensure_history(history, "2024-01-01"), "2024-01-01")
    st.apply_snapshot(spark, table, RUN_DATE, recent, ORDERS.key, missing="close")
    plain = st.HistoryTable(f"{tmp_path}/h")
    with table.active_rows(spark, table.runs(spark)[-1]) as before:
        rows = st.run_rows(recent, before, ORDERS.key, "2024-07-01", trusted_history=True)
        assert count(main_part(rows), "Exchange") == 1
        assert sorted(map(str, before.collect())) == sorted(
            map(str, st.active_rows(plain.read(spark)).collect())
        )
    # The first run on top of unbucketed rows leaves more files, any later one these.
    st.apply_snapshot(spark, table, "2024-07-01", recent, ORDERS.key, missing="close")
    files = [f for f in st.active_rows(plain.read(spark)).inputFiles() if "2024-07-01" in f]
    assert len(files) <= 5  # a file per bucket, and one for rows without a key
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("snaptrack_")]
