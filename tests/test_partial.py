"""Runs on partial snapshots over a history stored in parts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import snaptrack as st
from snaptrack.sources.history_table import PART

BASE = dt.date(2024, 1, 1)
DAYS = [BASE + dt.timedelta(days=i) for i in range(1, 6)]
SCHEMA = "k int, v string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def texts(df):
    names = ["k", "v", *st.MetaColumns().names]
    return sorted(map(str, df.select(*names).collect()))


def started(spark, path, rows, parts=8):
    table = st.HistoryTable(str(path), key="k", parts=parts)
    table.write(st.ensure_history(frame(spark, rows), BASE), BASE, checked=True)
    return table


def files_of(df):
    return {row[0] for row in df.select(F.input_file_name()).distinct().collect()}


@pytest.mark.parametrize("seed", range(2))
def test_changes_give_what_whole_snapshots_give(spark, tmp_path, seed):
    rng = random.Random(seed)
    now = {k: "v0" for k in range(60)}
    parts, plain = started(spark, tmp_path / "p", list(now.items())), st.HistoryTable(str(tmp_path / "w"))
    plain.write(st.ensure_history(frame(spark, list(now.items())), BASE), BASE, checked=True)
    for n, day in enumerate(DAYS[:4]):
        edited = {k: f"v{n + 1}" for k in rng.sample(sorted(now), 3)} | {100 + n: "new"}
        gone = rng.sample(sorted(set(now) - set(edited)), 2)
        now = {k: v for k, v in (now | edited).items() if k not in gone}
        changes = [(k, v, False) for k, v in edited.items()] + [(k, None, True) for k in gone]
        changes = spark.createDataFrame([*changes, (None, "x", False)], SCHEMA + ", gone boolean")
        st.apply_changes(spark, parts, day, changes, "k", deleted="gone")
        st.apply_snapshot(spark, plain, day, frame(spark, list(now.items())), "k", missing="close")
        assert texts(parts.read(spark)) == texts(plain.read(spark))
    for day in (BASE, *DAYS[:4]):
        assert sorted(map(str, parts.as_of(spark, day).collect())) == sorted(map(str, plain.as_of(spark, day).collect()))
    parts.drop_superseded(spark, keep=1)
    assert texts(parts.read(spark)) == texts(plain.read(spark))


def test_only_touched_parts_are_read_and_written(spark, tmp_path):
    table = started(spark, tmp_path / "t", [(k, "a") for k in range(400)])
    base = table.log(spark).head()
    chosen = frame(spark, [(5, "b"), (6, "b")])
    touched = {r[0] for r in chosen.select(table.part_of()).collect()}
    some = table.parts_of(spark, base, touched)
    assert files_of(some) < files_of(table.read(spark))
    assert all(any(f"{PART}={p}/" in name for p in touched) for name in files_of(some))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and PART in plan
    st.apply_changes(spark, table, DAYS[0], chosen, "k")
    log = table.log(spark)
    holders = log.holders(log.head())
    assert {p for p, (day, _) in holders.items() if day == DAYS[0]} == touched and len(holders) == 8
    written = [p.name for p in (tmp_path / "t" / "rows" / f"run_date={DAYS[0]}").glob("attempt=*/is_active=true/*")]
    assert set(written) == {f"{PART}={p}" for p in touched}
    assert table.read(spark).filter("is_active").count() == 400
    # A whole snapshot writes all parts again; a second partial run builds on it.
    st.apply_snapshot(spark, table, DAYS[1], frame(spark, [(k, "c") for k in range(400)]), "k")
    st.apply_changes(spark, table, DAYS[2], frame(spark, [(7, "d")]), "k")
    assert {r.v for r in table.read(spark).filter("is_active").collect()} == {"c", "d"}
    assert st.history_violations(table.read(spark), "k").count() == 0


def test_a_part_that_becomes_empty_and_one_that_was(spark, tmp_path):
    table = started(spark, tmp_path / "t", [(1, "a")], parts=4)
    gone = spark.createDataFrame([(1, None, True)], SCHEMA + ", gone boolean")
    st.apply_changes(spark, table, DAYS[0], gone, "k", deleted="gone")
    assert table.read(spark).filter("is_active").count() == 0
    st.apply_changes(spark, table, DAYS[1], frame(spark, [(k, "n") for k in range(9)]), "k")
    assert table.read(spark).filter("is_active").count() == 9
    st.apply_changes(spark, table, DAYS[2], frame(spark, []), "k")
    assert table.read(spark).filter("is_active").count() == 9 and table.runs(spark)[-1] == DAYS[2]


def test_key_types_are_those_of_the_table(spark, tmp_path):
    """A long key falls into the part of the stored int."""
    table = started(spark, tmp_path / "t", [(k, "a") for k in range(50)])
    changes = spark.createDataFrame([(k, "b") for k in range(50)], "k long, v string")
    with pytest.raises(ValueError, match="cast the snapshot"):
        st.apply_changes(spark, table, DAYS[0], changes, "k")
    st.apply_changes(spark, table, DAYS[0], changes.selectExpr("int(k) k", "v"), "k")
    assert table.read(spark).filter("is_active and v = 'b'").count() == 50


def test_what_cannot_be_applied_is_refused(spark, tmp_path):
    table = started(spark, tmp_path / "t", [(1, "a")])
    rows = frame(spark, [(1, "b")])
    both = spark.createDataFrame([(1, "b", False), (1, None, True)], SCHEMA + ", gone boolean")
    with pytest.raises(ValueError, match="both deleted"):
        st.apply_changes(spark, table, DAYS[0], both, "k", deleted="gone")
    with pytest.raises(ValueError, match="parts of"):
        st.apply_changes(spark, st.HistoryTable(str(tmp_path / "u")), DAYS[0], rows, "k")
    st.apply_changes(spark, table, DAYS[1], rows, "k")
    with pytest.raises(ValueError, match="older"):
        st.apply_changes(spark, table, DAYS[0], rows, "k")
    with pytest.raises(ValueError, match="parts need a key"):
        st.HistoryTable("x", parts=3)
    with pytest.raises(ValueError, match="named like"):
        table.write(rows.withColumn("part", F.lit(1)).withColumn("is_active", F.lit(True)), DAYS[2])
