"""Build the next state of a history from a snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from snaptrack.meta import DEFAULT_META, KeySpec, MetaColumns, date_text, quoted, ref, refs
from snaptrack.operators.checks import any_null
from snaptrack.operators.diff import Matched, match
from snaptrack.operators.rows import active_rows, sort_rows, union_all

MODES = ("full", "delta")
MISSING = ("keep", "close", "drop")


def build_history(
    recent: DataFrame,
    history: DataFrame,
    key: KeySpec,
    run_date: dt.date | str | None = None,
    meta: MetaColumns = DEFAULT_META,
    *,
    mode: str = "full",
    missing: str = "keep",
    sort: bool = False,
    **options,
) -> DataFrame:
    """History after the snapshot of ``run_date``.

    New keys are opened; edited rows are closed with their change log and opened again with
    the new values; versions closed earlier are carried over as they are.

    ``mode``      ``full`` also keeps unchanged rows, ``delta`` leaves out what this run did
                  not touch
    ``missing``   what becomes of active rows whose key the snapshot lacks: ``keep`` them
                  active, ``close`` them, or ``drop`` them
    ``sort``      order the result by key, created date and flag
    ``options``   ``strict``, ``on_duplicate``, ``order_by``, see ``match``

    Snapshot rows with a null key cannot be matched and are left out; ``key_violations``
    reports them. History rows without a key or a flag are carried over.
    """
    matched = match(recent, history, key, meta, run_date=run_date, **options)
    result = union_all([carried_rows(matched), _run(matched, mode, missing)])
    return sort_rows(result, [*matched.keys, meta.created, meta.active]) if sort else result


def run_rows(
    recent: DataFrame,
    history: DataFrame,
    key: KeySpec,
    run_date: dt.date | str | None = None,
    meta: MetaColumns = DEFAULT_META,
    *,
    mode: str = "full",
    missing: str = "keep",
    **options,
) -> DataFrame:
    """``build_history`` without the rows carried over from earlier runs."""
    matched = match(recent, history, key, meta, run_date=run_date, **options)
    return _run(matched, mode, missing)


def carried_rows(matched: Matched) -> DataFrame:
    """History rows that are not active, unchanged, whatever the snapshot holds."""
    flag = F.coalesce(ref(matched.meta.active), F.lit(False))
    return matched.history.filter(~flag).select(*_columns(matched))


def keyless_rows(matched: Matched) -> DataFrame:
    """Active history rows without a key: no snapshot row can match them, so they stay.

    A scan of its own and not part of the join: Parquet skips row groups without null keys,
    and null keys would all go to one task of the join.
    """
    rows = active_rows(matched.history, matched.meta).filter(any_null(matched.keys))
    return rows.select(*_columns(matched))


def _columns(matched: Matched):
    return refs([*matched.keys, *matched.values, *matched.meta.names])


def _run(matched: Matched, mode: str, missing: str) -> DataFrame:
    """Rows that are active after the run or closed by it: one join, no second pass over it.

    Each pair yields none, one or two rows. Only a short array of constants is exploded; the
    wide values are picked afterwards, so they are not copied into arrays.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if missing not in MISSING:
        raise ValueError(f"missing must be one of {MISSING}")
    meta, today = matched.meta, date_text(matched.run_date)
    # A delta that does not close missing rows has none that only the history holds.
    how = "left" if mode == "delta" and missing != "close" else "full"
    pairs = matched.pairs(how)

    kept = ["kept"] if mode == "full" else []
    rows_of = {
        "insert": ["opened"],
        "update": ["closed", "opened"],
        "unchanged": kept,
        "missing": {"keep": kept, "close": ["ended"], "drop": []}[missing],
    }
    branches = " ".join(
        f"when '{event}' then array({', '.join(map(repr, kinds))})"
        for event, kinds in rows_of.items()
        if kinds
    )
    # explode_outer and a filter: plain explode makes the optimizer push a copy of the whole
    # comparison below, once per use of the event.
    rows = pairs.df.selectExpr("*", f"{pairs.event} as _event").selectExpr(
        "*", f"explode_outer(case _event {branches} end) as _row"
    )
    if not all(rows_of.values()):
        rows = rows.filter("_row is not null")

    created, edited, changes = (
        pairs.old(name) for name in (meta.created, meta.edited, meta.changes)
    )
    stamps = {
        meta.active: "_row not in ('closed', 'ended')",
        meta.created: f"if(_row = 'opened', {today}, {created})",
        meta.edited: f"case when _row in ('closed', 'ended') then {today} "
        f"when _row = 'kept' then {edited} end",
        meta.changes: f"case when _row = 'closed' then {pairs.log} "
        f"when _row <> 'opened' then {changes} end",
    }
    written = rows.selectExpr(
        *refs(matched.keys),
        *[
            f"if(_row = 'opened', {pair.new}, {pair.old}) as {quoted(pair.name)}"
            for pair in pairs.values
        ],
        *[f"{text} as {quoted(name)}" for name, text in stamps.items()],
    )
    return written.unionByName(keyless_rows(matched)) if mode == "full" else written
