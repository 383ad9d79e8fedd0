"""The jobs from raw files to a history."""

import snaptrack as st
from snaptrack import jobs


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_seed_build_and_extend(spark, tmp_path):
    (tmp_path / "now.csv").write_text("id,name\n1,a\n2,B\n4,d\n")
    (tmp_path / "base.csv").write_text("id,name\n1,a\n2,b\n3,c\n")
    lake = str(tmp_path / "lake")
    jobs.run(
        spark,
        ["ingest", "--root", lake, "--schema", "id int, name string",
         f"now={tmp_path}/now.csv", f"base={tmp_path}/base.csv"],
    )
    now, base = (st.read_parquet(spark, f"{lake}/{name}") for name in ("now", "base"))

    diff = ["--recent", f"{lake}/now", "--key", "id", "--run-date", "2024-06-01"]
    names = ["--meta", "ativo", "criado_em", "editado_em", "json_alteracoes"]
    jobs.run(
        spark, ["history", *diff, *names, "--history", f"{lake}/base", "--out", f"{lake}/history"]
    )
    meta = st.MetaColumns("ativo", "criado_em", "editado_em", "json_alteracoes")
    expected = st.build_history(now, base, "id", "2024-06-01", meta)
    assert rows(st.read_parquet(spark, f"{lake}/history")) == rows(expected)

    daily = ["daily", "--table", f"{lake}/table", "--base", f"{lake}/base", "--missing", "close"]
    for _ in range(2):
        jobs.run(spark, [*daily, *diff])
    table = st.HistoryTable(f"{lake}/table")
    history = st.ensure_history(base, "2024-05-31")
    expected = st.build_history(now, history, "id", "2024-06-01", missing="close")
    assert rows(table.read(spark)) == rows(expected)
    assert rows(table.as_of(spark, "2024-05-31")) == rows(base)
    assert rows(table.read(spark, "2024-05-31")) == rows(history)  # nothing is freed unasked
    jobs.run(spark, [*daily, *diff, "--free-superseded", "1"])
    assert rows(table.as_of(spark, "2024-05-31")) == rows(base)
