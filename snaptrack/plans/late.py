"""A snapshot that arrives late, or again, for a date between two runs of a stored history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snaptrack.functions.compare import Pair, any_differs, change_text
from snaptrack.meta import KeySpec, as_day, date_of, date_text, quoted, ref, refs
from snaptrack.operators.diff import Matched, match
from snaptrack.operators.reads import as_of
from snaptrack.plans.align import same_types
from snaptrack.plans.pairing import NEW, key_guard, pair_versions, with_key
from snaptrack.sources.history_table import HistoryTable
from snaptrack.sources.run_log import DROPPED, FINISHED, RUN, StaleRun
from snaptrack.sources.workspace import new_folder


def insert_snapshot(
    spark: SparkSession,
    table: HistoryTable,
    run_date: dt.date | str,
    recent: DataFrame,
    key: KeySpec,
    missing: str = "keep",
    **options,
) -> None:
    """Store the history as if the snapshot had been applied in the order of dates.

    Only what the table held from ``run_date`` up to the next run changes. So the snapshot is
    compared with the state on its date, and for the keys that differ the versions before, on and
    after it are put together anew: the one before ends on the date, the new one ends at the next
    run, the one after begins there, and versions that now hold the same values become one. All
    other versions stay as they are.

    The runs from the date on get new attempts, which hold the rows that they closed, and a log
    that leads through them; until its last entry is made, readers see the history as it was. Runs
    before the last two keep no active rows, as after ``drop_superseded``; ``as_of`` reaches them.

    The next run must have closed what its snapshot lacked (``missing="close"``): what a run kept
    is not told apart from what its snapshot held, so nothing could be said about those keys.
    """
    if "mode" in options or missing == "drop":
        raise ValueError("a stored history keeps or closes missing rows, and is built in full")
    day, log = as_day(run_date), table.log(spark)
    chain = log.chain()
    earlier = [entry for entry in chain if entry[RUN] < day]
    later = [entry for entry in chain if entry[RUN] > day]
    if not earlier or not later:
        raise ValueError(f"{day} is not between two runs of {table.root}")
    if later[0].missing != "close" or not all(entry.missing for entry in later):
        raise ValueError(
            f"the run of {later[0][RUN]} may have kept rows that its snapshot lacked, so what it "
            "held is not known; a late snapshot needs later runs with missing='close'"
        )
    before, after = earlier[-1][RUN], later[0][RUN]
    stored = table.open_after(spark, before)
    matched = match(recent, stored, key, table.meta, run_date=day, **options)
    touched = _touched(matched, day, missing, day in [entry[RUN] for entry in chain])
    touched = _written(touched, "touched")
    versions = _rewritten(matched, touched, before, day, after, missing)
    same_types(stored, versions)
    # Versions of touched keys that were open between the run before and the run after give way.
    met = [ref(name) == F.col(f"_t{i}") for i, name in enumerate(matched.keys)]
    gone = touched.select(*[ref(name).alias(f"_t{i}") for i, name in enumerate(matched.keys)])
    overlapping = ref(table.meta.created) <= date_of(after)
    kept = matched.history.join(gone, [*met, overlapping], "left_anti")
    history = _written(kept.unionByName(versions), "history")

    if table.log(spark).head() != chain[-1]:
        raise StaleRun(f"another run was finished while that of {day} was inserted; try again")
    dates = sorted({day, *(entry[RUN] for entry in later)})
    policies = {entry[RUN]: entry.missing for entry in later} | {day: missing}
    checked = all(entry.checked for entry in later)
    attempts = {}
    for date in dates:
        rows = _rows_of_run(history, table, date, date == dates[-1], date in dates[-2:])
        attempts[date] = table.store(rows, date, checked)
    base = earlier[-1]
    for date in dates:
        state = FINISHED if date in dates[-2:] else DROPPED
        table.enter(
            spark, date, attempts[date], history, checked, base, policies[date], state
        )
        base = table.log(spark).entry(date, attempts[date])


def _written(rows: DataFrame, label: str) -> DataFrame:
    path = new_folder(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _state(matched: Matched, day: dt.date) -> DataFrame:
    return with_key(as_of(matched.history, day, matched.meta, keep_meta=True), matched.keys)


def _touched(matched: Matched, day: dt.date, missing: str, is_known: bool) -> DataFrame:
    """Keys whose content on the date changes, and the snapshot's values ``_at``, null if it has
    none."""
    state = _state(matched, day)
    pairs = pair_versions(matched.recent, state, matched.keys, matched.values, "full", matched.meta)
    guard = key_guard(
        matched.recent if matched.check_recent else None,
        state if matched.check_history else None,
        matched.keys, matched.meta, day,
    )
    changed = pairs.df.filter(guard).filter(f"{pairs.event} <> 'unchanged'")
    if missing == "keep" and not is_known:
        changed = changed.filter(f"{pairs.event} <> 'missing'")
    values = F.struct(*[F.expr(pairs.new(name)).alias(name) for name in matched.values])
    return changed.select(*refs(matched.keys), F.when(ref(NEW), values).alias("_at"))


def _side(matched: Matched, day: dt.date, name: str) -> DataFrame:
    """The version of each key on a date as one struct."""
    columns = refs([*matched.values, *matched.meta.names])
    return _state(matched, day).select(*refs(matched.keys), F.struct(*columns).alias(name))


def _rewritten(
    matched: Matched,
    touched: DataFrame,
    before: dt.date,
    day: dt.date,
    after: dt.date,
    missing: str,
) -> DataFrame:
    """The versions of touched keys from the run before to the run after."""
    meta, keys = matched.meta, matched.keys
    rows = touched.join(_side(matched, before, "_before"), keys, "left")
    rows = rows.join(_side(matched, after, "_after"), keys, "left")
    if missing == "keep":
        held = F.struct(*[_cell("_before", name).alias(name) for name in matched.values])
        rows = rows.withColumn("_at", F.coalesce("_at", F.when(F.col("_before").isNotNull(), held)))

    def pairs(new: str, old: str) -> list[Pair]:
        schema = matched.recent.schema
        return [
            Pair(n, f"{new}.{quoted(n)}", f"{old}.{quoted(n)}", schema[n].dataType)
            for n in matched.values
        ]

    back, ahead = pairs("_at", "_before"), pairs("_after", "_at")
    both = "_{0} is not null and _at is not null and not ({1})"
    rows = rows.selectExpr(
        "*",
        f"{both.format('before', any_differs(back))} as _as_before",
        f"{both.format('after', any_differs(ahead))} as _as_after",
    ).selectExpr(
        "*",
        "explode_outer(filter(array("
        "if(_before is not null and not _as_before, 'before', null), "
        "if(_at is not null, 'at', null), "
        "if(_after is not null and not _as_after, 'after', null)), x -> x is not null)) as _row",
    )
    on, then = date_text(day), date_text(after)
    old = {name: f"_before.{quoted(name)}" for name in meta.names}
    new = {name: f"_after.{quoted(name)}" for name in meta.names}
    stamps = {
        meta.active: f"case _row when 'at' then _as_after and {new[meta.active]} "
        f"when 'after' then {new[meta.active]} else false end",
        meta.created: f"case _row when 'before' then {old[meta.created]} when 'after' then {then} "
        f"else if(_as_before, {old[meta.created]}, {on}) end",
        meta.edited: f"case _row when 'before' then {on} when 'after' then {new[meta.edited]} "
        f"else if(_as_after, {new[meta.edited]}, {then}) end",
        meta.changes: f"case when _row = 'before' and _at is not null then {change_text(back)} "
        f"when _row = 'after' or _row = 'at' and _as_after then {new[meta.changes]} "
        f"when _row = 'at' and _after is not null then {change_text(ahead)} end",
    }
    picked = [
        f"case _row when 'before' then _before.{quoted(n)} when 'after' then _after.{quoted(n)} "
        f"else _at.{quoted(n)} end as {quoted(n)}"
        for n in matched.values
    ]
    return rows.filter("_row is not null").selectExpr(
        *refs(keys), *picked, *[f"{text} as {quoted(name)}" for name, text in stamps.items()]
    )


def _cell(struct: str, name: str) -> Column:
    return F.col(f"{struct}.{quoted(name)}")


def _rows_of_run(
    history: DataFrame, table: HistoryTable, date: dt.date, newest: bool, active: bool
) -> DataFrame:
    """The rows that a run closed and, where they are kept, those that were active after it."""
    meta = table.meta
    is_active = F.coalesce(ref(meta.active), F.lit(False))
    closed = history.filter(~is_active & (ref(meta.edited) == date_of(date)))
    if newest:
        return closed.unionByName(history.filter(is_active))
    if not active:
        return closed
    opened = as_of(history, date, meta, keep_meta=True).withColumns(
        {
            meta.active: F.lit(True),
            meta.edited: F.lit(None).cast("date"),
            meta.changes: F.lit(None).cast("string"),
        }
    )
    return closed.unionByName(opened)
