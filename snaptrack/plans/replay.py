"""Apply a series of dated snapshots to a stored history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from snaptrack.meta import KeySpec, as_day, key_list
from snaptrack.operators.history import run_rows
from snaptrack.operators.rows import ensure_history
from snaptrack.plans.align import same_types
from snaptrack.plans.late import insert_snapshot
from snaptrack.sources.history_table import HistoryTable
from snaptrack.sources.run_log import RUN


def apply_snapshot(
    spark: SparkSession,
    table: HistoryTable,
    run_date: dt.date | str,
    recent: DataFrame,
    key: KeySpec,
    missing: str = "keep",
    late: bool = False,
    **options,
) -> None:
    """Run one snapshot against the state before its date and store the result.

    Running the newest date again replaces that run, so the same snapshot and date change
    nothing, and a corrected snapshot corrects the run. The stored state is always whole: there
    is no ``mode``, and rows that are gone are kept or closed, as a dropped row could not be
    found ``as_of`` an earlier date.

    A date older than the newest run is an error, unless ``late`` allows to insert the snapshot,
    see ``insert_snapshot``. A run that another job has overtaken raises ``StaleRun``; nothing is
    lost by running it again.
    """
    if "mode" in options:
        raise ValueError("a stored history is always built in full; mode cannot be chosen")
    if missing == "drop":
        raise ValueError("a stored history keeps or closes missing rows; drop would lose the past")
    day, log = as_day(run_date), table.log(spark)
    runs = [entry[RUN] for entry in log.chain()]
    if late and runs and runs[0] < day < runs[-1]:
        insert_snapshot(spark, table, day, recent, key, missing, **options)
        return
    if runs and runs[-1] > day:
        raise ValueError(f"run date {day} is older than the newest run, {runs[-1]}")
    base = table.base(spark, day, log)
    if base is None:
        raise ValueError(f"{table.root} has no state before {day}; write a first history")
    if table.key is not None and key_list(table.key) != key_list(key):
        raise ValueError(f"the table is bucketed by {key_list(table.key)}, the run has {key}")
    with table.active_rows(spark, base[RUN], log) as before:
        # What run_rows wrote has one active row per key; what a caller wrote may not.
        trusted = bool(base.checked)
        rows = run_rows(
            recent, before, key, day, table.meta, missing=missing, trusted_history=trusted, **options
        )
        same_types(before, rows)
        table.write(rows, day, checked=True, base=base, missing=missing)


def replay(
    spark: SparkSession,
    snapshots: Iterable[tuple[dt.date | str, DataFrame]],
    table: HistoryTable,
    key: KeySpec,
    base: DataFrame | None = None,
    base_date: dt.date | str | None = None,
    missing: str = "keep",
    **options,
) -> DataFrame:
    """Apply snapshots in order of their dates and return the history after the last.

    ``base`` is the history to start from, raw or with metadata, and ``base_date`` the date
    it was taken; both are needed only while the table is empty. Each step reads the files
    the step before wrote, so plans do not grow with the number of snapshots. Dates that are
    already in the table are skipped: a replay that was cut off goes on where it stopped. With
    ``late=True`` dates between runs that are in the table are inserted.
    """
    series = sorted(((as_day(day), recent) for day, recent in snapshots), key=lambda item: item[0])
    days = [day for day, _ in series]
    repeated = sorted({str(day) for day in days if days.count(day) > 1})
    if repeated:
        raise ValueError(f"several snapshots are dated {repeated}; a date has one state")
    if not table.runs(spark):
        if base is None or base_date is None:
            raise ValueError("an empty history table needs base and base_date")
        table.write(ensure_history(base, base_date, table.meta), base_date)
    finished = set(table.runs(spark))
    for day, recent in series:
        if day not in finished:
            apply_snapshot(spark, table, day, recent, key, missing, **options)
    return table.read(spark)
