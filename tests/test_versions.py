"""Versions of some columns, versions rebuilt from the log, tables replaced as a whole."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F, types as T

import snaptrack as st
from snaptrack.registry.scenarios import RUN_DATE, SCENARIOS, frames
from snaptrack.sources import pointer
from tests.conftest import SMALL

BASE = dt.date(2024, 1, 1)
DAYS = [BASE + dt.timedelta(days=30 * i) for i in range(1, 5)]
SCHEMA = "k int, a string, b double, m map<string,int>"


def texts(frame):
    return sorted(map(str, frame.collect()))


def drawn(rng):
    values = [("x", 1.0, {"p": 1}), ("x", 1.0, {"p": 2}), ("y", None, None), ("x", float("nan"), {}), ('"q,[', 0.1, {"p": 1})]
    return [(k, *rng.choice(values)) for k in range(15) if rng.random() < 0.8]


def replayed(spark, path, base, series, columns):
    table = st.HistoryTable(str(path))
    snapshots = [(d, spark.createDataFrame(rows, SCHEMA).select("k", *columns)) for d, rows in zip(DAYS, series)]
    first = spark.createDataFrame(base, SCHEMA).select("k", *columns)
    return st.replay(spark, snapshots, table, "k", first, BASE, missing="close")


@pytest.mark.parametrize("columns", [["a"], ["m", "a"], ["b"]])
def test_some_columns_are_the_history_of_snapshots_of_them(spark, tmp_path, columns):
    rng = random.Random(len(columns))
    base, series = drawn(rng), [drawn(rng) for _ in DAYS]
    whole = replayed(spark, tmp_path / "whole", base, series, ["a", "b", "m"])
    alone = replayed(spark, tmp_path / "alone", base, series, columns)
    found = st.coalesce_versions(whole, "k", columns)
    assert found.columns == ["k", *columns, *st.MetaColumns().names]
    assert texts(found) == texts(alone.select(*found.columns))


def test_versions_do_not_join_over_a_gap_or_without_key(spark):
    rows = [
        (1, "x", False, "2024-01-01", "2024-01-05"), (1, "x", False, "2024-01-05", "2024-01-09"),
        (1, "x", True, "2024-01-10", None), (None, "x", True, "2024-01-01", None),
        (None, "x", True, "2024-01-01", None),
    ]
    history = spark.createDataFrame(rows, "k int, v string, is_active boolean, f string, t string").selectExpr(
        "k", "v", "is_active", "cast(f as date) valid_from", "cast(t as date) valid_to", "cast(null as string) changes"
    )
    found = st.coalesce_versions(history, "k", ["v"])
    spans = sorted((r.k, str(r.valid_from), str(r.valid_to)) for r in found.filter("k is not null").collect())
    assert spans == [(1, "2024-01-01", "2024-01-09"), (1, "2024-01-10", "None")]
    assert found.filter("k is null").count() == 2
    # Without any column only the days on which a key was there are left.
    assert st.coalesce_versions(history, "k", []).filter("k = 1").count() == 2
    with pytest.raises(ValueError, match="no value columns"):
        st.coalesce_versions(history, "k", ["nope"])
    assert st.coalesce_versions(history.limit(0), "k", ["v"]).count() == 0


@pytest.mark.parametrize("name", sorted(SCENARIOS))
def test_edited_versions_come_back_from_the_log(spark, name):
    scenario = SCENARIOS[name]
    recent, history = frames(spark, SMALL, scenario)
    built = st.build_history(recent, st.active_rows(history), scenario.key, RUN_DATE, missing="close")
    thin = st.thin_versions(built, scenario.key)
    value = scenario.values[0]
    edited = thin.filter("not is_active and changes is not null")
    assert edited.count() > 0 and edited.filter(F.col(value).isNotNull()).count() == 0
    assert texts(st.rebuild_versions(thin, scenario.key)) == texts(built)


def test_rebuilt_over_many_runs_and_types(spark, tmp_path):
    kind = T.StructType.fromDDL(
        "k int, i int, d decimal(12,3), t timestamp_ntz, z date, bin binary, s struct<x:int,y:array<string>>, "
        "n map<int,double>, w variant"
    )
    rng = random.Random(3)

    def value():
        return (
            rng.choice([None, 1, -7]), rng.choice([None, "1.500"]), rng.choice([None, "2024-05-01 01:02:03.000456"]),
            rng.choice([None, "1999-12-31"]), rng.choice([None, "AP8="]), rng.choice([None, '{"x":null,"y":["a",null,"\\""]}']),
            rng.choice([None, '{"3":0.1}']), rng.choice([None, '{"a":[1,2]}']),
        )

    def snapshot():
        rows = [(k, *value()) for k in range(20) if rng.random() < 0.85]
        raw = spark.createDataFrame(rows, "k int, i int, d string, t string, z string, bin string, s string, n string, w string")
        return raw.selectExpr(
            "k", "i", "cast(d as decimal(12,3)) d", "cast(t as timestamp_ntz) t", "cast(z as date) z", "unbase64(bin) bin",
            "from_json(s, 'struct<x:int,y:array<string>>') s",
            "transform_keys(from_json(n, 'map<string,double>'), (k, v) -> int(k)) n", "parse_json(w) w",
        )

    table = st.HistoryTable(str(tmp_path / "t"))
    st.replay(spark, [(d, snapshot()) for d in DAYS], table, "k", snapshot(), BASE, missing="close")
    history = table.read(spark)
    assert history.schema["n"].dataType == kind["n"].dataType
    printed = ["k", "valid_from", "valid_to", "is_active", "i", "d", "t", "z", "hex(bin) b", "to_json(s) s", "cast(n as string) n", "to_json(w) w"]
    found = st.rebuild_versions(st.thin_versions(history, "k"), "k")
    assert texts(found.selectExpr(*printed)) == texts(history.selectExpr(*printed))


# ---- tables replaced as a whole


def test_readers_see_the_old_table_or_the_new_one(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.range(10).withColumn("v", F.lit("old"))
    st.replace_parquet(first, path)
    open_reader = st.read_parquet(spark, path)
    st.replace_parquet(open_reader.filter("id > 3").withColumn("v", F.lit("new")), path, partition_by=["v"])
    assert open_reader.filter("v = 'old'").count() == 10  # began before, and ends with what it began with
    assert {r.v for r in st.read_parquet(spark, path).collect()} == {"new"}
    broken = st.read_parquet(spark, path).withColumn("id", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        st.replace_parquet(broken, path)
    assert st.read_parquet(spark, path).count() == 6


def test_every_moment_of_a_replacement_is_whole(spark, tmp_path, monkeypatch):
    """Between its two writes the new folder is whole and not yet the table."""
    path, seen, pointers = str(tmp_path / "t"), [], pointer._pointers
    st.replace_parquet(spark.range(3), path)

    def watched(session, where):
        if not seen:
            seen.append(None)
            seen[0] = st.read_parquet(session, path).count()
        return pointers(session, where)

    monkeypatch.setattr(pointer, "_pointers", watched)
    st.replace_parquet(spark.range(8), path)
    assert seen == [3] and st.read_parquet(spark, path).count() == 8


def test_replaced_and_failed_folders_can_be_freed(spark, tmp_path):
    path = str(tmp_path / "t")
    assert st.free_replaced(spark, path) == []
    for size in (2, 3, 4):
        st.replace_parquet(spark.range(size), path)
    lost = spark.range(9)
    lost.write.parquet(f"{path}/_data/{'f' * 32}")  # a job that died before its pointer
    assert st.free_replaced(spark, path) == []  # too young
    freed = st.free_replaced(spark, path, keep=2, older_than=dt.timedelta(0))
    assert len(freed) == 2 and "f" * 32 in freed
    assert st.read_parquet(spark, path).count() == 4
    held = {name: sum(f.endswith(".parquet") for f in os.listdir(f"{path}/_data/{name}")) for name in freed}
    assert all(spark.read.parquet(f"{path}/_data/{name}").count() == 0 for name in held)
    with pytest.raises(ValueError):
        st.free_replaced(spark, path, keep=0)


def test_plain_tables_are_read_as_before(spark, tmp_path):
    path = str(tmp_path / "t")
    st.write_parquet(spark.range(5), path)
    assert st.read_parquet(spark, path).count() == 5
    st.replace_parquet(spark.range(6), path)
    assert st.read_parquet(spark, path).count() == 6
    st.write_parquet(spark.range(7), path)  # plain files again
    assert st.read_parquet(spark, path).count() == 7


# ---- the landing


def test_old_days_are_listed_and_not_opened(spark, tmp_path):
    """Files of days before the last run may be unreadable: nothing opens them."""
    table, landing, landed = st.HistoryTable(f"{tmp_path}/h"), f"{tmp_path}/landing", f"{tmp_path}/landed"
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    table.write(st.ensure_history(rows, BASE), BASE)

    def pick_up(day, frame):
        frame.selectExpr("*", f"date '{day}' as day").write.mode("append").parquet(landing)
        return st.stream_history(
            spark, landing, "k int, v string, day date", "day", landed, table, "k", complete_until=DAYS[-1],
        )

    pick_up(DAYS[0], rows.withColumn("v", F.lit("c")))
    folder = f"{landed}/rows/day={DAYS[0]}"
    for name in os.listdir(folder):
        with open(f"{folder}/{name}", "wb") as file:
            file.write(b"not a table")
    history = pick_up(DAYS[1], rows.withColumn("v", F.lit("d")))
    assert table.runs(spark) == [BASE, *DAYS[:2]]
    assert {r.v for r in history.filter("is_active").collect()} == {"d"}
    with pytest.raises(ValueError, match="applied already"):
        pick_up(DAYS[0], rows)
