"""Readers, sinks, the history table and replays."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

import snaptrack as st
from snaptrack.sources import workspace

RUN, SECOND, BASE = "2024-06-01", "2024-07-01", "2024-01-01"
DAYS = [dt.date.fromisoformat(d) for d in (BASE, RUN, SECOND)]


def rows(frame):
    return sorted(map(str, frame.collect()))


@pytest.fixture
def frame(spark):
    return spark.createDataFrame([(1, "a"), (2, None), (3, "c,d")], "k int, v string")


def test_csv_and_json(spark, frame, tmp_path):
    frame.write.option("header", True).csv(str(tmp_path / "csv"))
    frame.write.json(str(tmp_path / "json"))
    assert rows(st.read_csv(spark, str(tmp_path / "csv"), frame.schema)) == rows(frame)
    assert rows(st.read_csv(spark, str(tmp_path / "csv"))) == rows(frame)
    assert rows(st.read_json(spark, str(tmp_path / "json"), frame.schema)) == rows(frame)
    inferred = st.read_json(spark, str(tmp_path / "json"))
    assert dict(inferred.dtypes) == {"k": "bigint", "v": "string"}


def test_ingest(spark, frame, tmp_path):
    for name in ("one", "two"):
        frame.write.json(str(tmp_path / name))
    sources = {name: str(tmp_path / name) for name in ("one", "two")}
    paths = st.ingest(spark, sources, str(tmp_path / "lake"), "k int, v string", format="json")
    assert paths["two"] == f"{tmp_path}/lake/two"
    assert rows(st.read_parquet(spark, paths["two"])) == rows(frame)
    with pytest.raises(ValueError):
        st.ingest(spark, sources, str(tmp_path), format="xml")


def test_write_parquet(spark, frame, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    st.write_parquet(frame, path)
    st.write_parquet(frame.filter("k > 1"), path)
    stored = st.read_parquet(spark, path)
    assert stored.count() == 2
    st.write_parquet(stored, f"{path}_2", partition_by=["k"])
    for target in (path, f"file:{path}/", f"file://{path}"):
        st.write_parquet(st.read_parquet(spark, path).withColumn("v", F.lit(target)), target)
        assert {row["v"] for row in st.read_parquet(spark, path).collect()} == {target}
    monkeypatch.chdir(tmp_path)
    relative = os.path.relpath(path, spark.sparkContext._jvm.java.lang.System.getProperty("user.dir"))
    st.write_parquet(st.read_parquet(spark, path).filter("k > 2"), relative)
    assert [row["k"] for row in st.read_parquet(spark, path).collect()] == [3]
    broken = st.read_parquet(spark, path).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        st.write_parquet(broken, path)
    assert st.read_parquet(spark, path).count() == 1
    assert (tmp_path / "t_2" / "k=3").is_dir()


def test_paths_and_store_settings():
    assert st.table_path("s3a://gold/", "orders") == "s3a://gold/orders"
    conf = st.s3a_conf("http://store:9000", "id", "secret")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert conf["spark.hadoop.fs.s3a.access.key"] == "id"
    assert not any("key" in name for name in st.s3a_conf("https://store", ssl=True))


def test_session_conf():
    assert "spark.sql.shuffle.partitions" not in st.session_conf()
    medium = st.session_conf(shuffle_bytes=10**12, cores=400)
    assert medium["spark.sql.shuffle.partitions"] == "4769"
    assert medium["spark.sql.files.maxPartitionBytes"] == str(128 * 1024 * 1024)
    large = st.session_conf(shuffle_bytes=10**14, cores=4000)
    assert large["spark.sql.shuffle.partitions"] == "476838"
    larger = st.session_conf(shuffle_bytes=10**14, partition_bytes=10**9, scan_bytes=10**9)
    assert larger["spark.sql.shuffle.partitions"] == "100000"
    assert larger["spark.sql.files.maxPartitionBytes"] == str(10**9)
    assert st.session_conf(cores=8)["spark.sql.shuffle.partitions"] == "16"


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert workspace.new_folder(spark, "x").startswith(f"{root}/x-")
    assert workspace.new_folder(spark, "x") != workspace.new_folder(spark, "x")


@pytest.fixture
def series(spark):
    schema = "k int, v string"
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], schema)
    first = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], schema)
    second = spark.createDataFrame([(1, "A"), (2, "B"), (3, "c")], schema)
    return base, first, second


def expected(series, missing="close"):
    base, first, second = series
    history = st.ensure_history(base, BASE)
    after = st.build_history(first, history, "k", RUN, missing=missing)
    return after, st.build_history(second, after, "k", SECOND, missing=missing)


def test_replay(spark, series, tmp_path):
    base, first, second = series
    table = st.HistoryTable(str(tmp_path / "h"))
    assert table.runs(spark) == []
    with pytest.raises(ValueError, match="no finished run"):
        table.read(spark)
    with pytest.raises(ValueError, match="base"):
        st.replay(spark, [(RUN, first)], table, "k")
    snapshots = [(SECOND, second), (RUN, first)]
    result = st.replay(spark, snapshots, table, "k", base, BASE, missing="close")
    after, last = expected(series)
    assert table.runs(spark) == DAYS
    assert rows(result) == rows(last)
    assert rows(table.read(spark, RUN)) == rows(after)
    assert rows(table.read(spark, "2024-06-20")) == rows(after)
    # The same series once more: every date is done already.
    again = st.replay(spark, snapshots, table, "k", missing="close")
    assert rows(again) == rows(last)
    for day in (BASE, "2024-03-01", RUN, "2024-06-20", SECOND):
        assert rows(table.as_of(spark, day)) == rows(st.as_of(last, day))


def test_replay_goes_on_where_it_stopped(spark, series, tmp_path):
    base, first, second = series
    table = st.HistoryTable(str(tmp_path / "h"))
    st.replay(spark, [(RUN, first)], table, "k", base, BASE, missing="close")
    # A run that died before it was logged leaves files that do not count.
    second.limit(1).withColumns({}).write.parquet(f"{table.root}/rows/run_date={SECOND}/is_active=true")
    assert rows(table.read(spark)) == rows(expected(series)[0])
    result = st.replay(spark, [(RUN, first), (SECOND, second)], table, "k", missing="close")
    assert rows(result) == rows(expected(series)[1])


def test_newest_run_can_be_repeated(spark, series, tmp_path):
    base, first, second = series
    table = st.HistoryTable(str(tmp_path / "h"))
    st.replay(spark, [(RUN, first), (SECOND, base)], table, "k", base, BASE, missing="close")
    for _ in range(2):
        st.apply_snapshot(spark, table, SECOND, second, "k", missing="close")
        assert rows(table.read(spark)) == rows(expected(series)[1])
    with pytest.raises(ValueError, match="older than the newest run"):
        st.apply_snapshot(spark, table, RUN, first, "k")
    with pytest.raises(ValueError, match="no state before"):
        st.apply_snapshot(spark, st.HistoryTable(str(tmp_path / "x")), RUN, first, "k")


def test_a_repeat_that_dies_does_not_count(spark, series, tmp_path):
    base, first, second = series
    table = st.HistoryTable(str(tmp_path / "h"))
    snapshots = [(RUN, first), (SECOND, second)]
    st.replay(spark, snapshots, table, "k", base, BASE, missing="close")
    broken = st.ensure_history(second, SECOND).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        table.write(broken, SECOND)
    # The run it would have replaced is still the newest.
    assert table.runs(spark) == DAYS
    assert rows(table.read(spark)) == rows(expected(series)[1])
    result = st.replay(spark, snapshots, table, "k", missing="close")
    assert rows(result) == rows(expected(series)[1])


def test_what_a_dead_run_left_is_never_read(spark, series, tmp_path):
    base, first, second = series
    table = st.HistoryTable(str(tmp_path / "h"))
    st.replay(spark, [(RUN, first)], table, "k", base, BASE, missing="close")
    left = table.read(spark).limit(1).drop("is_active")
    for flag in ("true", "false"):
        left.write.parquet(f"{table.root}/rows/run_date=2024-06-15/is_active={flag}")
    result = st.replay(spark, [(SECOND, second)], table, "k", missing="close")
    assert rows(result) == rows(expected(series)[1])
    assert rows(table.as_of(spark, "2024-06-20")) == rows(first)


def test_stored_types_do_not_drift(spark, series, tmp_path):
    base, first, _ = series
    table = st.HistoryTable(str(tmp_path / "h"))
    st.replay(spark, [(RUN, first)], table, "k", base, BASE)
    added = first.selectExpr("k", "v", "k * 2 as n")
    st.apply_snapshot(spark, table, SECOND, added, "k")
    assert "n" in table.read(spark).columns
    assert table.read(spark).filter("not is_active and n is not null").count() == 0
    with pytest.raises(ValueError, match="is stored as int"):
        st.apply_snapshot(spark, table, "2024-08-01", added.selectExpr("k", "v", "'x' as n"), "k")


def test_empty_first_history(spark, series, tmp_path):
    base, first, _ = series
    table = st.HistoryTable(str(tmp_path / "h"))
    result = st.replay(spark, [(RUN, first)], table, "k", base.limit(0), BASE)
    assert result.count() == 3


def test_renamed_metadata(spark, series, tmp_path):
    base, first, second = series
    meta = st.MetaColumns("ativo", "criado_em", "editado_em", "json_alteracoes")
    table = st.HistoryTable(str(tmp_path / "h"), meta)
    result = st.replay(spark, [(RUN, first), (SECOND, second)], table, "k", base, BASE, missing="close")
    assert sorted(map(tuple, result.collect()), key=repr) == sorted(
        map(tuple, expected(series)[1].collect()), key=repr
    )


def test_stream_picks_up_what_lands(spark, series, tmp_path):
    base, first, second = series
    table = st.HistoryTable(str(tmp_path / "h"))
    table.write(st.ensure_history(base, BASE), BASE)
    landing = str(tmp_path / "landing")

    def land(day, snapshot):
        snapshot.selectExpr("*", f"date '{day}' as day").write.mode("append").parquet(landing)

    def pick_up():
        return st.stream_history(
            spark, landing, "k int, v string, day date", "day", str(tmp_path / "landed"),
            table, "k", missing="close", complete_until=SECOND,
        )

    after, last = expected(series)
    land(RUN, first)
    assert rows(pick_up()) == rows(after)
    assert rows(pick_up()) == rows(after)
    land(SECOND, second)
    assert rows(pick_up()) == rows(last)
    assert table.runs(spark) == DAYS


def test_superseded_active_rows_can_go(spark, series, tmp_path):
    base, first, second = series
    table = st.HistoryTable(str(tmp_path / "h"))
    snapshots = [(RUN, first), (SECOND, second)]
    st.replay(spark, snapshots, table, "k", base, BASE, missing="close")
    for _ in range(2):
        table.drop_superseded(spark)
        assert rows(table.read(spark)) == rows(expected(series)[1])
    with pytest.raises(ValueError, match="use as_of"):
        table.read(spark, BASE)
    assert rows(table.as_of(spark, BASE)) == rows(base)
    assert rows(table.as_of(spark, RUN)) == rows(first)
    st.apply_snapshot(spark, table, SECOND, second, "k", missing="close")
    assert rows(table.read(spark)) == rows(expected(series)[1])
    left = spark.read.parquet(f"{table.root}/rows/run_date={BASE}")
    assert left.filter("is_active = 'true'").count() == 0
    with pytest.raises(ValueError):
        table.drop_superseded(spark, keep=0)


def test_rows_without_key_or_flag_survive_runs(spark, series, tmp_path):
    schema = "k int, v string, is_active boolean, valid_from date"
    day = DAYS[0]
    odd = spark.createDataFrame(
        [(None, "x", True, day), (9, "y", None, day), (1, "a", True, day)], schema
    )
    table = st.HistoryTable(str(tmp_path / "h"))
    snapshots = [(RUN, series[1]), (SECOND, series[2])]
    result = st.replay(spark, snapshots, table, "k", odd, BASE, missing="close")
    assert result.filter("k is null or v = 'y'").count() == 2


def test_stored_history_has_no_mode_and_no_drop(spark, series, tmp_path):
    base, first, _ = series
    table = st.HistoryTable(str(tmp_path / "h"))
    for options in ({"mode": "delta"}, {"missing": "drop"}):
        with pytest.raises(ValueError, match="stored history"):
            st.replay(spark, [(RUN, first)], table, "k", base, BASE, **options)
        with pytest.raises(ValueError, match="stored history"):
            st.apply_snapshot(spark, table, RUN, first, "k", **options)


def test_one_state_per_date(spark, series, tmp_path):
    base, first, second = series
    table = st.HistoryTable(str(tmp_path / "h"))
    for same in (RUN, dt.date(2024, 6, 1), dt.datetime(2024, 6, 1, 12)):
        with pytest.raises(ValueError, match="several snapshots"):
            st.replay(spark, [(RUN, first), (same, second)], table, "k", base, BASE)


def test_names_of_the_folders_are_refused(spark, series, tmp_path):
    table = st.HistoryTable(str(tmp_path / "h"))
    for name in ("run_date", "Attempt"):
        with pytest.raises(ValueError, match="rename them"):
            table.write(st.ensure_history(series[0].withColumn(name, F.lit(1)), BASE), BASE)
    with pytest.raises(ValueError, match="ensure_history"):
        table.write(series[0], BASE)
    assert table.runs(spark) == []


def test_points_in_time_are_dates(spark, series, tmp_path):
    base, first, _ = series
    table = st.HistoryTable(str(tmp_path / "h"))
    table.write(st.ensure_history(base, dt.datetime(2024, 1, 1)), dt.datetime(2024, 1, 1, 8))
    table.write(st.ensure_history(base, BASE), BASE)
    assert table.runs(spark) == DAYS[:1] and table.read(spark).count() == 3
    st.apply_snapshot(spark, table, dt.datetime(2024, 6, 1, 23), first, "k")
    assert table.runs(spark) == DAYS[:2]


def test_a_state_can_be_written_over_its_own_run(spark, series, tmp_path):
    base, first, _ = series
    table = st.HistoryTable(str(tmp_path / "h"))
    st.replay(spark, [(RUN, first)], table, "k", base, BASE, missing="close")
    before = rows(table.read(spark))
    table.write(table.read(spark), RUN)
    assert rows(table.read(spark, RUN)) and set(rows(table.read(spark))) == set(before)


def test_only_checked_runs_are_trusted(spark, series, tmp_path):
    base, first, _ = series
    table = st.HistoryTable(str(tmp_path / "h"))
    table.write(st.ensure_history(base, BASE), BASE)
    table.write(st.ensure_history(base.union(base), BASE), "2024-02-01")
    with pytest.raises(Exception, match="duplicate keys"):
        st.apply_snapshot(spark, table, RUN, first, "k")


def stream(spark, tmp_path, table, landed="landed", complete_until=SECOND, schema="k int, v string, day date"):
    return st.stream_history(
        spark, str(tmp_path / "landing"), schema, "day", landed and str(tmp_path / landed), table,
        "k", missing="close", complete_until=complete_until,
    )


def land(tmp_path, day, snapshot, kind="date"):
    text = f"{kind} '{day}'" if day else f"cast(null as {kind})"
    snapshot.selectExpr("*", f"{text} as day").write.mode("append").parquet(str(tmp_path / "landing"))


def test_a_snapshot_in_parts_waits(spark, series, tmp_path):
    base, first, _ = series
    table = st.HistoryTable(str(tmp_path / "h"))
    with pytest.raises(ValueError, match="first history"):
        stream(spark, tmp_path, table)
    table.write(st.ensure_history(base, BASE), BASE)
    land(tmp_path, RUN, first.filter("k < 3"))
    stream(spark, tmp_path, table, complete_until="2024-05-31")
    assert table.runs(spark) == DAYS[:1]
    land(tmp_path, RUN, first.filter("k >= 3"))
    assert rows(stream(spark, tmp_path, table)) == rows(expected(series)[0])
    land(tmp_path, RUN, first.limit(1))
    with pytest.raises(ValueError, match="applied already"):
        stream(spark, tmp_path, table)


def test_rows_without_a_date_are_an_error(spark, series, tmp_path):
    table = st.HistoryTable(str(tmp_path / "h"))
    table.write(st.ensure_history(series[0], BASE), BASE)
    land(tmp_path, None, series[1])
    with pytest.raises(ValueError, match="have no day"):
        stream(spark, tmp_path, table)


def test_landing_by_date_is_not_copied_and_instants_are_dates(spark, series, tmp_path):
    base, first, second = series
    for landed, kind in ((None, "date"), ("landed", "timestamp")):
        folder = tmp_path / kind
        table = st.HistoryTable(str(folder / "h"))
        table.write(st.ensure_history(base, BASE), BASE)
        for day, snapshot in ((RUN, first), (SECOND, second)):
            land(folder, day + (" 07:30:00" if kind == "timestamp" else ""), snapshot, kind)
        result = stream(spark, folder, table, landed, schema=f"k int, v string, day {kind}")
        assert rows(result) == rows(expected(series)[1])
        assert (folder / "landed").exists() == bool(landed)


def test_parsing_faults_fail_and_are_listed(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("k,v\n1,a\nx,b\n")
    (tmp_path / "swapped.csv").write_text("v,k\na,1\n")
    (tmp_path / "bad.json").write_text('{"k": 1, "v": "a"}\n{"k": \n')
    for name in ("bad.csv", "swapped.csv"):
        with pytest.raises(Exception):
            st.read_csv(spark, str(tmp_path / name), "k int, v string").collect()
    with pytest.raises(Exception):
        st.read_json(spark, str(tmp_path / "bad.json"), "k int, v string").collect()
    rejected = st.rejected_rows(spark, str(tmp_path / "bad.csv"), "k int, v string")
    assert [row["rejected"] for row in rejected.collect()] == ["x,b"]
    rejected = st.rejected_rows(spark, str(tmp_path / "bad.json"), "k int, v string", "json")
    assert [row["rejected"] for row in rejected.collect()] == ['{"k": ']


def test_line_breaks_in_values(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a\nb,\"c\"\n\nd"), (2, "e")], "k int, v string")
    frame.write.options(header=True, escape='"').csv(str(tmp_path / "csv"))
    read = st.read_csv(spark, str(tmp_path / "csv"), frame.schema, multi_line=True, escape='"')
    assert rows(read) == rows(frame)
