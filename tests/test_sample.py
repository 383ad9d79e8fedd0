"""The small sample: 13 snapshot rows against 10 history rows, with Portuguese names."""

import datetime as dt

import pytest

import snaptrack as st

META = st.MetaColumns("ativo", "criado_em", "editado_em", "json_alteracoes")
SCHEMA = "id int, categoria string, data timestamp, valor double"

# The sample tables.
RECENT = """id,categoria,data,valor
1,A,2023-01-01,0.1
2,A,2023-05-02,100.0
3,A,2023-01-03,300.0
4,B,2023-01-04,400.0
5,W,2023-01-05,500.0
6,W,2023-01-06,150.0
7,C,2023-01-07,100.0
8,AA,2023-08-08,800.0
9,C,2023-01-09,300.0
10,C,2023-01-10,100.0
11,D,2023-01-20,300.0
12,D,2023-01-20,400.0
13,D,2023-01-20,500.0
"""
HISTORY = """id,categoria,data,valor
1,A,2023-01-01,100
2,A,2023-01-02,200
3,A,2023-01-03,300
4,B,2023-01-04,400
5,B,2023-01-05,500
6,B,2023-01-06,100
7,C,2023-01-07,100
8,C,2023-01-08,200
9,C,2023-01-09,300
10,C,2023-01-10,100
"""
LOGS = {
    1: '{"valor":["0.1","100.0"]}',
    2: '{"data":["2023-05-02 00:00:00","2023-01-02 00:00:00"],"valor":["100.0","200.0"]}',
    5: '{"categoria":["W","B"]}',
    6: '{"categoria":["W","B"],"valor":["150.0","100.0"]}',
    8: '{"categoria":["AA","C"],"data":["2023-08-08 00:00:00","2023-01-08 00:00:00"],'
    '"valor":["800.0","200.0"]}',
}
FIRST, RUN = dt.date(2024, 1, 1), dt.date(2024, 6, 1)


@pytest.fixture(scope="module")
def sample(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sample")
    for name, text in (("atual", RECENT), ("historico", HISTORY)):
        (folder / f"{name}.csv").write_text(text)
    paths = st.ingest(
        spark,
        {name: str(folder / f"{name}.csv") for name in ("atual", "historico")},
        str(folder / "gold"),
        SCHEMA,
    )
    recent, history = (st.read_parquet(spark, paths[n]) for n in ("atual", "historico"))
    return recent, st.ensure_history(history, FIRST, META)


def expected(mode):
    rows = []
    for line in HISTORY.splitlines()[1:]:
        key, category, day, value = line.split(",")
        values = (int(key), category, dt.datetime.fromisoformat(day), float(value))
        if values[0] in LOGS:
            rows.append((*values, False, FIRST, RUN, LOGS[values[0]]))
        elif mode == "full":
            rows.append((*values, True, FIRST, None, None))
    for line in RECENT.splitlines()[1:]:
        key, category, day, value = line.split(",")
        values = (int(key), category, dt.datetime.fromisoformat(day), float(value))
        if values[0] in LOGS or values[0] > 10:
            rows.append((*values, True, RUN, None, None))
    return sorted(rows, key=lambda row: (row[0], row[5]))


@pytest.mark.parametrize("mode, count", [("full", 18), ("delta", 13)])
def test_history_of_the_sample(sample, mode, count):
    result = st.build_history(*sample, "id", RUN, META, mode=mode, sort=True)
    rows = [tuple(row) for row in result.collect()]
    assert len(rows) == count
    assert rows == expected(mode)


def test_pieces_make_the_delta(sample):
    recent, history = sample
    pieces = st.union_all(
        [
            st.closed_rows(history, META),
            st.closed_edited_rows(recent, history, "id", RUN, META),
            st.edited_rows(recent, history, "id", RUN, META),
            st.new_rows(recent, history, "id", RUN, META),
        ],
        order_by=["id", "criado_em"],
    )
    assert [tuple(row) for row in pieces.collect()] == expected("delta")


def test_raw_history_is_opened_on_the_run_date(sample):
    recent, history = sample
    raw = history.drop(*META.names)
    rows = st.build_history(recent, raw, "id", RUN, META).collect()
    assert len(rows) == 18
    assert {row.criado_em for row in rows} == {RUN}
