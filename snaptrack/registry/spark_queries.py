"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import snaptrack as st
from snaptrack.registry.scenarios import (
    BASE_DATE,
    CONVERSATIONS,
    CUSTOMER,
    CUSTOMER_JANUARY,
    CUSTOMER_RENUMBERED,
    DOCUMENTS,
    EMBEDDINGS,
    EVENTS,
    JANUARY_RUNS,
    LINEITEM,
    ORDERS,
    PAGES,
    PART,
    PERIODS,
    RUN_DATE,
    SCENARIOS,
    SECOND_DATE,
    Scenario,
    frames,
    second_frame,
    table,
)
from snaptrack.sources.workspace import new_folder

Query = Callable[[SparkSession, str], DataFrame]


def on_orders(operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """A query over the orders snapshot and the history before it."""
    return lambda spark, sf_dir: operator(*frames(spark, sf_dir, ORDERS))


def on_history(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(frames(spark, sf_dir, ORDERS)[1])


def after_run(operator: Callable[[DataFrame], DataFrame]) -> Query:
    """A query over the history after the run."""
    return on_orders(lambda new, old: operator(st.build_history(new, old, ORDERS.key, RUN_DATE)))


def classified(scenario: Scenario) -> Query:
    return lambda spark, sf_dir: st.classify(*frames(spark, sf_dir, scenario), scenario.key)


def built(scenario: Scenario, **options) -> Query:
    return lambda spark, sf_dir: st.build_history(
        *frames(spark, sf_dir, scenario), scenario.key, RUN_DATE, **options
    )


def read_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.read_parquet(spark, st.table_path(sf_dir, "orders.parquet"))


def read_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = table(spark, sf_dir, "customer"), new_folder(spark, "csv")
    rows.write.option("header", True).csv(path)
    return st.read_csv(spark, path, rows.schema)


def read_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = table(spark, sf_dir, "events"), new_folder(spark, "json")
    # The default format keeps milliseconds only.
    rows.write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
    return st.read_json(spark, path, rows.schema)


def ingest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = table(spark, sf_dir, "part"), new_folder(spark, "raw")
    rows.write.option("header", True).csv(path)
    paths = st.ingest(spark, {"part": path}, new_folder(spark, "lake"), rows.schema)
    return st.read_parquet(spark, paths["part"])


def write_parquet_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "partitioned")
    st.write_parquet(table(spark, sf_dir, "supplier"), path, partition_by=["s_nationkey"])
    return st.read_parquet(spark, path)


def rows_with_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, history = frames(spark, sf_dir, ORDERS)
    returned = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    ids = returned.select(F.col("l_orderkey").alias("o_orderkey"))
    return st.rows_with_keys(history, ids, "o_orderkey")


def fingerprint(recent: DataFrame, history: DataFrame) -> DataFrame:
    new = st.fingerprint(recent, ORDERS.values, "new_print")
    old = st.fingerprint(st.active_rows(history), ORDERS.values, "old_print")
    pairs = new.select(*ORDERS.key, "new_print").join(
        old.select(*ORDERS.key, "old_print"), list(ORDERS.key)
    )
    differing = F.count_if(F.col("new_print") != F.col("old_print"))
    return pairs.agg(differing.alias("differing_rows"))


def union_all(order_by: str | None) -> Query:
    return on_orders(
        lambda new, old: st.union_all(
            [st.closed_rows(old), st.new_rows(new, old, ORDERS.key, RUN_DATE)], order_by
        )
    )


def build_history_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent, history = frames(spark, sf_dir, ORDERS)
    folder = new_folder(spark, "bucketed")
    label = folder.rsplit("-", 1)[-1]
    buckets = st.buckets_for(table(spark, sf_dir, "orders"))
    names = [f"snaptrack_{side}_{label}" for side in ("recent", "active")]
    for name, rows in zip(names, (recent, st.active_rows(history))):
        st.write_bucketed(rows, name, ORDERS.key, buckets, path=f"{folder}/{name}")
    run = st.run_rows(*map(spark.table, names), ORDERS.key, RUN_DATE)
    run.write.parquet(f"{folder}/run")
    for name in names:
        spark.sql(f"drop table {name}")
    return st.union_all([st.closed_rows(history), st.read_parquet(spark, f"{folder}/run")])


def replayed_table(spark: SparkSession, sf_dir: str) -> st.HistoryTable:
    recent, history = frames(spark, sf_dir, ORDERS)
    store = st.HistoryTable(new_folder(spark, "replay"))
    snapshots = [(RUN_DATE, recent), (SECOND_DATE, second_frame(spark, sf_dir, ORDERS))]
    st.replay(spark, snapshots, store, ORDERS.key, history, BASE_DATE, missing="close")
    return store


def replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replayed_table(spark, sf_dir).read(spark)


def as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.as_of(replayed_table(spark, sf_dir).read(spark), "2024-06-15")


def as_of_history_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replayed_table(spark, sf_dir).as_of(spark, "2024-03-01")


def stream_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent, history = frames(spark, sf_dir, ORDERS)
    folder = new_folder(spark, "stream")
    store = st.HistoryTable(f"{folder}/history")
    store.write(st.ensure_history(history, BASE_DATE), BASE_DATE)
    second = second_frame(spark, sf_dir, ORDERS)
    arrivals = ((RUN_DATE, recent), (SECOND_DATE, second))
    for day, rows in arrivals:
        dated = rows.withColumn("snapshot_date", F.lit(day).cast("date"))
        dated.write.mode("append").parquet(f"{folder}/landing")
    return st.stream_history(
        spark, f"{folder}/landing", dated.schema, "snapshot_date", f"{folder}/landed",
        store, ORDERS.key, missing="close", complete_until=SECOND_DATE,
    )


def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over a stored history: the operator reads its input twice."""
    store = st.HistoryTable(new_folder(spark, "timeline"))
    store.write(built(ORDERS)(spark, sf_dir), RUN_DATE)
    return st.timeline(store.read(spark), ORDERS.key)


def read_csv_whole(name: str, **options) -> Query:
    """A table written as CSV and read back."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows, path = table(spark, sf_dir, name), new_folder(spark, "csv")
        rows.write.options(header=True, escape='"').csv(path)
        return st.read_csv(spark, path, rows.schema, escape='"', **options)

    return query


def read_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = table(spark, sf_dir, "part"), new_folder(spark, "csv")
    rows.write.option("header", True).csv(path)
    return st.read_csv(spark, path)


def read_json_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = table(spark, sf_dir, "customer"), new_folder(spark, "json")
    rows.write.json(path)
    return st.read_json(spark, path)


def replay_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over a table with a timestamp and text, the last one repeated."""
    recent, history = frames(spark, sf_dir, EVENTS)
    store = st.HistoryTable(new_folder(spark, "events"))
    days = (RUN_DATE, SECOND_DATE, "2024-08-01")
    st.replay(spark, [(day, recent) for day in days], store, EVENTS.key, history, BASE_DATE)
    st.apply_snapshot(spark, store, days[-1], recent, EVENTS.key)
    return store.read(spark)


def replay_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replay over a history stored in buckets of the key."""
    recent, history = frames(spark, sf_dir, ORDERS)
    buckets = st.buckets_for(table(spark, sf_dir, "orders"))
    store = st.HistoryTable(new_folder(spark, "bucketed"), key=ORDERS.key, buckets=buckets)
    snapshots = [(RUN_DATE, recent), (SECOND_DATE, second_frame(spark, sf_dir, ORDERS))]
    return st.replay(spark, snapshots, store, ORDERS.key, history, BASE_DATE, missing="close")


def started(spark: SparkSession, sf_dir: str) -> tuple[st.HistoryTable, DataFrame, DataFrame]:
    """A stored history of one run and two snapshots to follow."""
    recent, history = frames(spark, sf_dir, ORDERS)
    store = st.HistoryTable(new_folder(spark, "started"))
    store.write(st.ensure_history(history, BASE_DATE), BASE_DATE, checked=True)
    return store, recent, second_frame(spark, sf_dir, ORDERS)


def overlapping_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily jobs at once: the later one has read its state before the earlier is finished.
    It is refused and run again."""
    store, recent, second = started(spark, sf_dir)
    base = store.base(spark, SECOND_DATE)
    with store.active_rows(spark, base["run_date"]) as before:
        rows = st.run_rows(second, before, ORDERS.key, SECOND_DATE, missing="close")
        st.apply_snapshot(spark, store, RUN_DATE, recent, ORDERS.key, missing="close")
        try:
            store.write(rows, SECOND_DATE, checked=True, base=base, missing="close")
        except st.StaleRun:
            st.apply_snapshot(spark, store, SECOND_DATE, second, ORDERS.key, missing="close")
    return store.read(spark)


def replay_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs on what has changed alone, the second one with the keys that are gone."""
    recent, history = frames(spark, sf_dir, ORDERS)
    second, key = second_frame(spark, sf_dir, ORDERS), list(ORDERS.key)
    store = st.HistoryTable(new_folder(spark, "changes"), key=ORDERS.key, parts=8)
    store.write(st.ensure_history(history, BASE_DATE), BASE_DATE, checked=True)
    for day, rows in ((RUN_DATE, recent), (SECOND_DATE, second)):
        events = st.classify(rows, store.read(spark), key).filter("event <> 'unchanged'")
        changes = events.join(rows, key, "left").withColumn("gone", F.col("event") == "missing").drop("event")
        st.apply_changes(spark, store, day, changes, key, deleted="gone")
    return store.read(spark)


def replay_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot of the first date arrives after that of the second."""
    store, recent, second = started(spark, sf_dir)
    for day, rows in ((SECOND_DATE, second), (RUN_DATE, recent)):
        st.apply_snapshot(spark, store, day, rows, ORDERS.key, missing="close", late=True)
    return store.read(spark)


def replay_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first date is applied with the wrong snapshot, and corrected after the second."""
    store, recent, second = started(spark, sf_dir)
    for day, rows in ((RUN_DATE, second), (SECOND_DATE, second), (RUN_DATE, recent)):
        st.apply_snapshot(spark, store, day, rows, ORDERS.key, missing="close", late=True)
    return store.read(spark)


def customers_of_january(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent, history = frames(spark, sf_dir, CUSTOMER_JANUARY)
    store = st.HistoryTable(new_folder(spark, "january"))
    second = second_frame(spark, sf_dir, CUSTOMER_JANUARY)
    return st.replay(
        spark, zip(JANUARY_RUNS, (second, recent)), store, CUSTOMER_JANUARY.key, history, BASE_DATE,
        missing="close",
    )


def join_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with its user's customer row as it was on that day."""
    facts = table(spark, sf_dir, "events").withColumnRenamed("user_id", "c_custkey")
    return st.join_as_of(facts, customers_of_january(spark, sf_dir), "c_custkey", "ts")


def history_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    periods = spark.sql(PERIODS, table=table(spark, sf_dir, "events"))
    return st.history_violations(periods, ["user_id", "event_type"])


def history_violations_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    periods = spark.sql(PERIODS, table=table(spark, sf_dir, "events"))
    return st.history_violations(periods, "user_id")


def replaced_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced twice, the second time by rows computed from its own."""
    rows, path = table(spark, sf_dir, "supplier"), new_folder(spark, "replaced")
    st.replace_parquet(rows.withColumn("s_acctbal", F.lit(0.0)), path, partition_by=["s_nationkey"])
    balances = rows.select("s_suppkey", "s_acctbal")
    own = st.read_parquet(spark, path).drop("s_acctbal").join(balances, "s_suppkey")
    st.replace_parquet(own, path, partition_by=["s_nationkey"])
    st.free_replaced(spark, path, keep=1)
    return st.read_parquet(spark, path)


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose segment is written where a number is due."""
    rows, path = table(spark, sf_dir, "customer"), new_folder(spark, "raw")
    number = F.when(F.col("c_acctbal") < 0, F.col("c_mktsegment")).otherwise(F.col("c_nationkey").cast("string"))
    raw = rows.select("c_custkey", number.alias("c_nationkey"), "c_name")
    raw.write.option("header", True).csv(path)
    schema = "c_custkey bigint, c_nationkey int, c_name string"
    return st.rejected_rows(spark, path, schema).select("c_custkey", "c_nationkey", "c_name", "rejected")


def versions_without_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = [name for name in ORDERS.values if name != "o_orderpriority"]
    return st.coalesce_versions(replayed_table(spark, sf_dir).read(spark), ORDERS.key, kept)


def rebuilt(scenario: Scenario) -> Query:
    """A history of which the edited versions have lost their values, put together from its log."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        recent, history = frames(spark, sf_dir, scenario)
        built_ = st.build_history(recent, st.active_rows(history), scenario.key, RUN_DATE, missing="close")
        path = new_folder(spark, "thin")
        st.thin_versions(built_, scenario.key).write.parquet(path)
        return st.rebuild_versions(spark.read.schema(built_.schema).parquet(path), scenario.key)

    return query


def moved_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.moved_keys(*frames(spark, sf_dir, CUSTOMER_RENUMBERED), CUSTOMER_RENUMBERED.key)


def classify_with_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.classify_with_moves(*frames(spark, sf_dir, CUSTOMER_RENUMBERED), CUSTOMER_RENUMBERED.key)


def merged_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries stored by run and merged for a range; the estimates are held against exact counts
    of the same history, and must lie within three standard errors."""
    history, path = replayed_table(spark, sf_dir).read(spark), new_folder(spark, "summaries")
    st.run_summaries(history, ORDERS.key).write.partitionBy("run_date").parquet(path)
    merged = st.merge_summaries(st.read_parquet(spark, path), RUN_DATE, SECOND_DATE, quantiles=[0.5])
    cells = st.explode_changes(history, ORDERS.key).filter(F.col("valid_to") >= F.lit(RUN_DATE).cast("date"))
    exact = cells.groupBy("column_name").agg(F.countDistinct(*ORDERS.key).alias("exact"))
    difference = F.expr("try_cast(new_value as double) - try_cast(old_value as double)")
    middle = merged.select("column_name", F.col("differences")[0].alias("median"))
    ranks = cells.join(middle, "column_name").groupBy("column_name").agg(
        F.avg((difference < F.col("median")).cast("double")).alias("below"),
        F.avg((difference <= F.col("median")).cast("double")).alias("upto"),
    )
    near = F.abs(F.col("key_count") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.05 * F.col("exact"))
    return merged.join(exact, "column_name").join(ranks, "column_name").select(
        "column_name", "edit_count", near.alias("keys_near"),
        ((F.col("below") <= 0.55) & (F.col("upto") >= 0.45)).alias("median_near"),
    )


def pieces_equal_delta(scenario: Scenario) -> Query:
    """The delta put together from its four operators."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        new, old = frames(spark, sf_dir, scenario)
        pieces = (st.closed_edited_rows, st.edited_rows, st.new_rows)
        return st.union_all(
            [st.closed_rows(old), *[piece(new, old, scenario.key, RUN_DATE) for piece in pieces]]
        )

    return query


def fingerprint_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secure hashes that differ between the snapshot and the active rows."""
    recent, history = frames(spark, sf_dir, EMBEDDINGS)
    sides = [
        st.fingerprint(rows, EMBEDDINGS.values, name, secure=True).select(*EMBEDDINGS.key, name)
        for rows, name in ((recent, "new_print"), (st.active_rows(history), "old_print"))
    ]
    differing = F.count_if(F.col("new_print") != F.col("old_print"))
    return sides[0].join(sides[1], list(EMBEDDINGS.key)).agg(differing.alias("differing_rows"))


def queries() -> dict[str, Query]:
    key = ORDERS.key
    result = {
        "read_parquet": read_parquet,
        "read_csv": read_csv,
        "read_json": read_json,
        "read_csv_documents": read_csv_whole("documents", multi_line=True),
        "read_csv_pages": read_csv_whole("pages", multi_line=True),
        "read_csv_inferred": read_csv_inferred,
        "read_json_inferred": read_json_inferred,
        "ingest_roundtrip": ingest_roundtrip,
        "write_parquet_partitioned": write_parquet_partitioned,
        "active_rows": on_history(st.active_rows),
        "closed_rows": on_history(st.closed_rows),
        "open_rows": lambda spark, sf_dir: st.open_rows(table(spark, sf_dir, "orders"), RUN_DATE),
        "close_rows": on_history(lambda old: st.close_rows(st.active_rows(old), RUN_DATE)),
        "ensure_history": lambda spark, sf_dir: st.ensure_history(
            table(spark, sf_dir, "orders"), RUN_DATE
        ),
        "value_columns": on_history(lambda old: old.select(*st.value_columns(old, key))),
        "rows_with_keys": rows_with_keys,
        "fingerprint": on_orders(fingerprint),
        "union_all": union_all(None),
        "union_all_sorted": union_all("o_orderkey"),
        "new_keys": on_orders(lambda new, old: st.new_keys(new, old, key)),
        "new_rows": on_orders(lambda new, old: st.new_rows(new, old, key, RUN_DATE)),
        "edited_keys": on_orders(lambda new, old: st.edited_keys(new, old, key)),
        "edited_rows": on_orders(lambda new, old: st.edited_rows(new, old, key, RUN_DATE)),
        "closed_edited_rows": on_orders(
            lambda new, old: st.closed_edited_rows(new, old, key, RUN_DATE, log=False)
        ),
        "closed_edited_rows_log": on_orders(
            lambda new, old: st.closed_edited_rows(new, old, key, RUN_DATE)
        ),
        "change_log": on_orders(lambda new, old: st.change_log(new, old, key)),
        "change_summary": on_orders(lambda new, old: st.change_summary(new, old, key)),
        "build_history_full": built(ORDERS),
        "run_rows": on_orders(lambda new, old: st.run_rows(new, old, key, RUN_DATE)),
        "build_history_delta": built(ORDERS, mode="delta"),
        "build_history_missing_close": built(ORDERS, missing="close"),
        "build_history_missing_drop": built(ORDERS, missing="drop"),
        "build_history_bucketed": build_history_bucketed,
        "build_history_keep_first": built(
            LINEITEM, on_duplicate="keep_first", order_by="l_shipdate"
        ),
        "replay": replay,
        "replay_events": replay_events,
        "replay_bucketed": replay_bucketed,
        "pieces_equal_delta": pieces_equal_delta(ORDERS),
        "pieces_equal_delta_customer": pieces_equal_delta(CUSTOMER),
        "fingerprint_embeddings": fingerprint_embeddings,
        "replaced_parquet": replaced_parquet,
        "rejected_rows": rejected_rows,
        "versions_without_priority": versions_without_priority,
        "rebuild_versions": rebuilt(ORDERS),
        "rebuild_versions_events": rebuilt(EVENTS),
        # Text of floating-point lists is each engine's own; the values are not.
        "rebuild_versions_embeddings": lambda spark, sf_dir: rebuilt(EMBEDDINGS)(spark, sf_dir).drop("changes"),
        "moved_keys": moved_keys,
        "classify_with_moves": classify_with_moves,
        "merged_summaries": merged_summaries,
        "overlapping_runs": overlapping_runs,
        "replay_changes": replay_changes,
        "replay_late": replay_late,
        "replay_corrected": replay_corrected,
        "join_as_of": join_as_of,
        "history_violations": history_violations,
        "history_violations_user": history_violations_user,
        "stream_history": stream_history,
        "history_table_after_first_run": lambda spark, sf_dir: replayed_table(
            spark, sf_dir
        ).read(spark, RUN_DATE),
        "as_of": as_of,
        "as_of_history_table": as_of_history_table,
        "timeline": timeline,
        "explode_changes": after_run(lambda history: st.explode_changes(history, key)),
        "column_change_counts": after_run(st.column_change_counts),
        "key_violations": lambda spark, sf_dir: st.key_violations(
            table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
        ),
        "key_violations_null": lambda spark, sf_dir: st.key_violations(
            table(spark, sf_dir, "orders").withColumn(
                "o_orderpriority", F.expr("nullif(o_orderpriority, '5-LOW')")
            ),
            ["o_orderpriority", "o_orderstatus"],
        ),
        "edited_rows_embeddings": lambda spark, sf_dir: st.edited_rows(
            *frames(spark, sf_dir, EMBEDDINGS), EMBEDDINGS.key, RUN_DATE
        ),
    }
    for name, scenario in SCENARIOS.items():
        result["classify" if name == "orders" else f"classify_{name}"] = classified(scenario)
    for scenario in (CUSTOMER, PART, DOCUMENTS, PAGES, CONVERSATIONS, EVENTS):
        result[f"build_history_{scenario.table}"] = built(scenario)
    return result


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built(ORDERS)(spark, sf_dir)
