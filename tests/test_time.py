"""Runs that overlap, snapshots that arrive late, checks over time, joins at a point in time."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

import snaptrack as st
from snaptrack.sources.run_log import RUN
from tests.plan_text import count, physical

BASE = dt.date(2024, 1, 1)
DAYS = [BASE + dt.timedelta(days=10 * i) for i in range(1, 5)]
SCHEMA = "k int, v string, w array<int>"
ORDER = ["k", "valid_from"]


def snapshot(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def state(table, spark):
    """The history as comparable rows."""
    return sorted(map(str, table.read(spark).select("k", "v", "w", *st.MetaColumns().names).collect()))


def drawn(rng):
    """A snapshot in which keys come, go, and take one of few values."""
    values = [("a", [1]), ("b", [1, 2]), (None, None), ("a", [2])]
    return [(k, *rng.choice(values)) for k in range(12) if rng.random() < 0.75]


def started(spark, path, base, **options):
    table = st.HistoryTable(str(path), **options)
    table.write(st.ensure_history(snapshot(spark, base), BASE), BASE, checked=True)
    return table


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ---- runs that overlap


def test_a_run_on_a_state_that_is_no_longer_the_newest_is_refused(spark, tmp_path):
    rows = [[(1, "old", None), (2, "x", None)], [(1, "new", None), (2, "x", None)], [(1, "newer", None)]]
    table = started(spark, tmp_path / "t", rows[0])
    base = table.base(spark, DAYS[1])
    with table.active_rows(spark, base[RUN]) as before:
        late = st.run_rows(snapshot(spark, rows[2]), before, "k", DAYS[1], missing="close")
        st.apply_snapshot(spark, table, DAYS[0], snapshot(spark, rows[1]), "k", missing="close")
        unchanged = state(table, spark)
        with pytest.raises(st.StaleRun, match="built on that of 2024-01-01"):
            table.write(late, DAYS[1], checked=True, base=base)
    assert state(table, spark) == unchanged and table.runs(spark) == [BASE, DAYS[0]]
    st.apply_snapshot(spark, table, DAYS[1], snapshot(spark, rows[2]), "k", missing="close")
    plain = started(spark, tmp_path / "plain", rows[0])
    st.replay(spark, [(d, snapshot(spark, r)) for d, r in zip(DAYS, rows[1:])], plain, "k", missing="close")
    assert state(table, spark) == state(plain, spark)


def test_two_jobs_that_enter_at_the_same_moment(spark, tmp_path, monkeypatch):
    """Both have looked before either has entered: the state is that of one chain, and says so."""
    table = started(spark, tmp_path / "t", [(1, "old", None), (2, "x", None)])
    base = table.base(spark, DAYS[1])
    with table.active_rows(spark, base[RUN]) as before:
        late = st.run_rows(snapshot(spark, [(1, "newer", None), (2, "x", None)]), before, "k", DAYS[1])
        st.apply_snapshot(spark, table, DAYS[0], snapshot(spark, [(1, "new", None), (2, "x", None)]), "k")
        monkeypatch.setattr(st.HistoryTable, "_refuse_stale", lambda *_: None)
        with pytest.raises(st.StaleRun, match="left out"):
            table.write(late, DAYS[1], checked=True, base=base, missing="close")
    monkeypatch.undo()
    history = table.read(spark)
    assert history.filter("k = 1 and valid_to is not null").count() == 1
    assert st.history_violations(history, "k").count() == 0
    statuses = {(r.run_date, r.status) for r in table.run_log(spark).collect()}
    assert statuses == {(BASE, "current"), (DAYS[0], "left_out"), (DAYS[1], "current")}
    # The run that was left out can be inserted.
    st.apply_snapshot(
        spark, table, DAYS[0], snapshot(spark, [(1, "new", None), (2, "x", None)]), "k", late=True
    )
    assert table.runs(spark) == [BASE, *DAYS[:2]]
    values = [r.v for r in table.read(spark).filter("k = 1").orderBy("valid_from").collect()]
    assert values == ["old", "new", "newer"]


def test_the_same_date_twice_at_once(spark, tmp_path):
    table = started(spark, tmp_path / "t", [(1, "old", None)])
    for value in ("one", "two"):
        st.apply_snapshot(spark, table, DAYS[0], snapshot(spark, [(1, value, None)]), "k")
    log = table.run_log(spark).collect()
    assert sorted(r.status for r in log) == ["current", "current", "replaced"]
    assert {r.base_date for r in log} == {None, BASE}
    assert table.read(spark).filter("is_active").collect()[0].v == "two"


def test_a_run_before_the_newest_is_refused_when_it_ends(spark, tmp_path):
    table = started(spark, tmp_path / "t", [(1, "old", None)])
    base = table.base(spark, DAYS[0])
    with table.active_rows(spark, base[RUN]) as before:
        rows = st.run_rows(snapshot(spark, [(1, "new", None)]), before, "k", DAYS[0])
        st.apply_snapshot(spark, table, DAYS[1], snapshot(spark, [(1, "newest", None)]), "k")
        with pytest.raises(st.StaleRun, match="finished before"):
            table.write(rows, DAYS[0], base=base)


def test_logs_without_links_are_read(spark, tmp_path):
    """Entries of before name no base: every date counts with its last attempt."""
    table = started(spark, tmp_path / "t", [(1, "a", None)])
    st.apply_snapshot(spark, table, DAYS[0], snapshot(spark, [(1, "b", None)]), "k")
    expected = state(table, spark)
    old = spark.read.parquet(f"{tmp_path}/t/runs").select(
        "run_date", "written_at", "state", "columns", "attempt", "checked", "buckets"
    )
    old.write.parquet(f"{tmp_path}/old")
    table = st.HistoryTable(f"{tmp_path}/u")
    spark.read.parquet(f"{tmp_path}/old").write.parquet(f"{tmp_path}/u/runs")
    spark.read.option("basePath", f"{tmp_path}/t/rows").parquet(f"{tmp_path}/t/rows").write.partitionBy(
        "run_date", "attempt", "is_active"
    ).parquet(f"{tmp_path}/u/rows")
    assert state(table, spark) == expected and table.runs(spark) == [BASE, DAYS[0]]
    st.apply_snapshot(spark, table, DAYS[1], snapshot(spark, [(1, "c", None)]), "k")
    assert table.runs(spark) == [BASE, *DAYS[:2]]


# ---- late snapshots


@pytest.mark.parametrize("seed", range(3))
def test_any_order_gives_the_history_of_dates_in_order(spark, tmp_path, seed):
    rng = random.Random(seed)
    base, snapshots = drawn(rng), {day: drawn(rng) for day in DAYS[:3]}
    orders = list(itertools.permutations(DAYS[:3]))
    found = []
    for n, order in enumerate(orders[:1] + rng.sample(orders[1:], 3)):
        table = started(spark, tmp_path / f"{seed}-{n}", base)
        for day in order:
            st.apply_snapshot(
                spark, table, day, snapshot(spark, snapshots[day]), "k", missing="close", late=True
            )
        assert table.runs(spark) == [BASE, *DAYS[:3]]
        found.append(state(table, spark))
        for day in (BASE, *DAYS[:3]):
            expected = snapshots.get(day, base)
            kept = table.as_of(spark, day).select("k", "v", "w").collect()
            assert sorted(map(str, kept)) == sorted(str(r) for r in snapshot(spark, expected).collect())
    assert all(rows == found[0] for rows in found)
    assert st.history_violations(table.read(spark), "k").filter("violation <> 'gap'").count() == 0


def test_corrected_snapshots_and_runs_after(spark, tmp_path):
    rng = random.Random(9)
    base, wrong, snapshots = drawn(rng), drawn(rng), [drawn(rng) for _ in DAYS]
    table, plain = (started(spark, tmp_path / name, base) for name in ("t", "plain"))
    for table_, rows in ((table, [snapshots[0], wrong, snapshots[2]]), (plain, snapshots[:3])):
        for day, r in zip(DAYS, rows):
            st.apply_snapshot(spark, table_, day, snapshot(spark, r), "k", missing="close")
    st.insert_snapshot(spark, table, DAYS[1], snapshot(spark, snapshots[1]), "k", missing="close")
    assert state(table, spark) == state(plain, spark)
    # The newest run can still be repeated, and another one follows.
    for table_ in (table, plain):
        for day, r in ((DAYS[2], snapshots[3]), (DAYS[3], snapshots[0])):
            st.apply_snapshot(spark, table_, day, snapshot(spark, r), "k", missing="close")
    assert state(table, spark) == state(plain, spark)


def test_late_snapshot_that_keeps_what_it_lacks(spark, tmp_path):
    base, early, last = [(1, "a", None), (2, "a", None)], [(1, "b", None)], [(1, "a", None), (2, "a", None), (3, "c", None)]
    table, plain = (started(spark, tmp_path / name, base) for name in ("t", "plain"))
    st.apply_snapshot(spark, plain, DAYS[0], snapshot(spark, early), "k")
    for table_ in (table, plain):
        st.apply_snapshot(spark, table_, DAYS[1], snapshot(spark, last), "k", missing="close")
    st.insert_snapshot(spark, table, DAYS[0], snapshot(spark, early), "k")
    assert state(table, spark) == state(plain, spark)
    assert [r.v for r in table.read(spark).filter("k = 1").orderBy("valid_from").collect()] == ["a", "b", "a"]


def test_late_snapshot_in_buckets_and_rows_without_key(spark, tmp_path):
    base = [(1, "a", None), (2, "a", None), (None, "x", None)]
    table = started(spark, tmp_path / "t", base, key="k", buckets=2)
    st.apply_snapshot(spark, table, DAYS[1], snapshot(spark, [(1, "b", None)]), "k", missing="close")
    st.insert_snapshot(spark, table, DAYS[0], snapshot(spark, [(1, "c", None), (3, "n", None), (None, "y", None)]), "k", missing="close")
    st.apply_snapshot(spark, table, DAYS[2], snapshot(spark, [(1, "b", None)]), "k", missing="close")
    found = {(r.k, r.v, r.is_active, r.valid_from, r.valid_to) for r in table.read(spark).collect()}
    assert found == {
        (1, "a", False, BASE, DAYS[0]), (1, "c", False, DAYS[0], DAYS[1]), (1, "b", True, DAYS[1], None),
        (2, "a", False, BASE, DAYS[0]), (3, "n", False, DAYS[0], DAYS[1]), (None, "x", True, BASE, None),
    }


def test_late_snapshots_that_cannot_be_known_are_refused(spark, tmp_path):
    table = started(spark, tmp_path / "t", [(1, "a", None)])
    rows = snapshot(spark, [(1, "b", None)])
    st.apply_snapshot(spark, table, DAYS[1], rows, "k")
    with pytest.raises(ValueError, match="older than the newest run"):
        st.apply_snapshot(spark, table, DAYS[0], rows, "k")
    with pytest.raises(ValueError, match="not known"):
        st.insert_snapshot(spark, table, DAYS[0], rows, "k", missing="close")
    for day in (DAYS[2], BASE - dt.timedelta(days=1)):
        with pytest.raises(ValueError, match="not between"):
            st.insert_snapshot(spark, table, day, rows, "k")
    with pytest.raises(ValueError, match="keeps or closes"):
        st.insert_snapshot(spark, table, DAYS[0], rows, "k", missing="drop")
    table = started(spark, tmp_path / "u", [(1, "a", None)])
    st.apply_snapshot(spark, table, DAYS[1], rows, "k", missing="close")
    twice = snapshot(spark, [(1, "b", None), (1, "c", None)])
    with pytest.raises(Exception, match="duplicate keys"):
        st.insert_snapshot(spark, table, DAYS[0], twice, "k", missing="close")
    assert table.runs(spark) == [BASE, DAYS[1]]


def test_readers_see_the_old_chain_until_the_last_entry(spark, tmp_path, monkeypatch):
    table = started(spark, tmp_path / "t", [(1, "a", None)])
    st.apply_snapshot(spark, table, DAYS[1], snapshot(spark, [(1, "b", None)]), "k", missing="close")
    before, seen, enter = state(table, spark), [], st.HistoryTable.enter

    def watched(self, session, *args, **options):
        seen.append(state(table, session))
        enter(self, session, *args, **options)

    monkeypatch.setattr(st.HistoryTable, "enter", watched)
    st.insert_snapshot(spark, table, DAYS[0], snapshot(spark, [(1, "c", None)]), "k", missing="close")
    assert seen == [before, before] and state(table, spark) != before


# ---- checks of periods


def plain_violations(rows):
    found = []
    rows = [r for r in rows if r[0] is not None]
    for key, start, end, active in set(rows):
        count = rows.count((key, start, end, active))
        for name, wrong in (
            ("no_start", start is None),
            ("reversed", start is not None and end is not None and end < start),
            ("active_with_end", active and end is not None),
            ("closed_without_end", not active and end is None),
        ):
            if wrong:
                found.append((key, start, end, name, None, count))
    far = dt.date.max
    spans = [(k, s, e or far) for k, s, e, _ in rows if s and (e is None or e >= s)]
    for key, start, end in set(spans):
        count = spans.count((key, start, end))
        before = [e for k, s, e in spans if k == key and (s, e) < (start, end)] + [end] * (count > 1)
        if before and max(before) != start:
            until = max(before)
            name = "overlap" if start < until else "gap"
            found.append((key, start, None if end == far else end, name, None if until == far else until, count))
    return sorted(found, key=repr)


def test_history_violations_against_all_pairs(spark):
    rng = random.Random(4)
    days = [BASE + dt.timedelta(days=rng.randrange(100)) for _ in range(25)]
    rows = [
        (rng.choice([None, 1, 2, 3, 4]), rng.choice([*days, None]), rng.choice([*days, None]), rng.random() < 0.5)
        for _ in range(400)
    ]
    frame = spark.createDataFrame(rows, "k int, valid_from date, valid_to date, is_active boolean")
    columns = ["k", "valid_from", "valid_to", "violation", "until", "row_count"]
    result = st.history_violations(frame, "k")
    assert result.columns == columns
    assert sorted((tuple(r) for r in result.collect()), key=repr) == plain_violations(rows)
    assert st.history_violations(frame.limit(0), "k").count() == 0


def test_history_violations_of_a_hot_key(spark, no_broadcast):
    """Key 0 has most of the versions, one a day; one of them lasts a year too long."""
    rows = spark.range(20_000).select(
        F.expr("if(id < 15000, 0, id)").alias("k"),
        F.expr("date_add(date '1980-01-01', int(if(id < 15000, id, 0)))").alias("valid_from"),
        F.expr("date_add(date '1980-01-02', int(if(id < 15000, id, 0) + if(id = 7000, 365, 0)))").alias("valid_to"),
        F.lit(False).alias("is_active"),
    )
    result = st.history_violations(rows, "k")
    assert {(r.violation, r["count"]) for r in result.groupBy("violation").count().collect()} == {("overlap", 365)}
    windows = [line for line in physical(result).splitlines() if "Window [" in line]
    assert sum("trunc" in line or "_month" in line for line in windows) >= 1


# ---- joins at a point in time


def test_join_as_of_against_every_pair(spark):
    rng = random.Random(6)
    versions = []
    for key in range(8):
        cuts = sorted(rng.sample(range(60), rng.randrange(0, 6)))
        for a, b in zip(cuts, [*cuts[1:], None]):
            end = None if b is None else b - rng.choice([0, 0, 2])
            if end is None or end > a:
                versions.append((key, "x", f"v{key}-{a}", BASE + dt.timedelta(days=a), end and BASE + dt.timedelta(days=end)))
    facts = [
        (i, rng.choice([None, *range(9)]), "x", rng.choice([None, dt.datetime(2024, 1, 1, 23, 59) + dt.timedelta(days=rng.randrange(-3, 63))]))
        for i in range(300)
    ]
    frame = spark.createDataFrame(facts, "id int, k int, l string, at timestamp_ntz")
    history = spark.createDataFrame(versions, "k int, l string, v string, valid_from date, valid_to date")
    found = {r.id: r.v for r in st.join_as_of(frame, history, ["k", "l"], "at").collect()}
    for i, key, _, at in facts:
        held = [v for k, _, v, a, b in versions if at and k == key and a <= at.date() and (b is None or at.date() < b)]
        assert found[i] == (held[0] if held else None)
    assert len(found) == len(facts)
    assert st.join_as_of(frame, history.limit(0), ["k", "l"], "at").filter("v is not null").count() == 0
    with pytest.raises(ValueError, match="rename"):
        st.join_as_of(frame.withColumn("v", F.lit(1)), history, ["k", "l"], "at")


def test_join_as_of_a_hot_key_has_no_nested_loop(spark, no_broadcast):
    facts = spark.range(30_000).selectExpr(
        "id", "if(id % 3 = 0, 0, id) as k", "date_add(date '2024-01-01', int(id % 50)) as at"
    )
    history = spark.range(30_000).selectExpr(
        "if(id < 40, 0, id) as k", "id as v",
        "date_add(date '2024-01-01', if(id < 40, int(id), 0)) as valid_from",
        "if(id < 39, date_add(date '2024-01-02', int(id)), null) as valid_to",
    )
    result = st.join_as_of(facts, history, "k", "at")
    plan = physical(result)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert count(plan, "HashAggregate") == 2  # days of a key are made distinct before the shuffle
    hot = result.filter("k = 0").selectExpr("count(*)", "count_if(v = least(39, datediff(at, date '2024-01-01')))")
    assert tuple(hot.collect()[0]) == (10_000, 10_000)
    assert result.count() == 30_000
