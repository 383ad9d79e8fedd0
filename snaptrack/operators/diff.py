"""Compare a snapshot with the active versions of a history."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from snaptrack.meta import DEFAULT_META, KeySpec, MetaColumns, key_list, quoted, refs, spelled_as
from snaptrack.operators.rows import active_rows, close_rows, ensure_history, open_rows
from snaptrack.plans.align import align
from snaptrack.plans.pairing import Pairs, key_guard, pair_versions, prepare_recent, with_key


@dataclass(frozen=True)
class Matched:
    """Aligned sides of a diff, ready to be joined."""

    recent: DataFrame
    active: DataFrame
    history: DataFrame
    keys: list[str]
    values: list[str]
    meta: MetaColumns
    run_date: dt.date | str | None
    check_recent: bool
    check_history: bool

    def pairs(self, how: str) -> Pairs:
        pairs = pair_versions(self.recent, self.active, self.keys, self.values, how, self.meta)
        if not (self.check_recent or self.check_history):
            return pairs
        guard = key_guard(
            self.recent if self.check_recent else None,
            self.active if self.check_history else None,
            self.keys,
            self.meta,
            self.run_date,
        )
        return replace(pairs, df=pairs.df.filter(guard))


def match(
    recent: DataFrame,
    history: DataFrame,
    key: KeySpec,
    meta: MetaColumns = DEFAULT_META,
    *,
    run_date: dt.date | str | None = None,
    strict: bool = False,
    on_duplicate: str = "error",
    order_by: KeySpec | None = None,
    trusted_history: bool = False,
) -> Matched:
    """Align both sides; the options are those of every operator that pairs versions.

    ``strict``           columns on one side only are an error instead of null
    ``on_duplicate``     a snapshot key that occurs twice: ``error`` fails the query,
                         ``keep_first`` takes its first row by ``order_by``, ``trust`` leaves
                         out all checks because the caller knows the keys are unique
    ``trusted_history``  leave out the check of the history, as for one this package wrote
    """
    keys = key_list(key)
    recent = spelled_as(recent, [*keys, *meta.names])
    history = spelled_as(history, [*recent.columns, *meta.names])
    history = ensure_history(history, run_date, meta)
    recent, history, values = align(recent, history, keys, meta, strict)
    order = None if order_by is None else key_list(order_by)
    return Matched(
        recent=prepare_recent(recent, keys, on_duplicate, order),
        active=with_key(active_rows(history, meta), keys),
        history=history,
        keys=keys,
        values=values,
        meta=meta,
        run_date=run_date,
        check_recent=on_duplicate == "error",
        check_history=on_duplicate != "trust" and not trusted_history,
    )


def new_keys(
    recent: DataFrame,
    history: DataFrame,
    key: KeySpec,
    meta: MetaColumns = DEFAULT_META,
    **options,
) -> DataFrame:
    """Keys of the snapshot that have no active version."""
    pairs = match(recent, history, key, meta, **options).pairs("left")
    return pairs.inserted().select(*refs(pairs.keys))


def new_rows(
    recent: DataFrame,
    history: DataFrame,
    key: KeySpec,
    run_date: dt.date | str | None = None,
    meta: MetaColumns = DEFAULT_META,
    **options,
) -> DataFrame:
    """Snapshot rows without an active version, stamped as open.

    They take the way of every other pair: types are aligned and keys checked, so the pieces of
    a delta put together are the delta.
    """
    pairs = match(recent, history, key, meta, run_date=run_date, **options).pairs("left")
    rows = pairs.inserted().selectExpr(*refs(pairs.keys), *pairs.new_values())
    return open_rows(rows, run_date, meta)


def edited_keys(
    recent: DataFrame,
    history: DataFrame,
    key: KeySpec,
    meta: MetaColumns = DEFAULT_META,
    **options,
) -> DataFrame:
    """Keys whose snapshot row differs from the active version in some value column."""
    pairs = match(recent, history, key, meta, **options).pairs("inner")
    return pairs.edited().select(*refs(pairs.keys))


def edited_rows(
    recent: DataFrame,
    history: DataFrame,
    key: KeySpec,
    run_date: dt.date | str | None = None,
    meta: MetaColumns = DEFAULT_META,
    **options,
) -> DataFrame:
    """The new version of each edited row, stamped as open."""
    pairs = match(recent, history, key, meta, run_date=run_date, **options).pairs("inner")
    rows = pairs.edited().selectExpr(*refs(pairs.keys), *pairs.new_values())
    return open_rows(rows, run_date, meta)


def closed_edited_rows(
    recent: DataFrame,
    history: DataFrame,
    key: KeySpec,
    run_date: dt.date | str | None = None,
    meta: MetaColumns = DEFAULT_META,
    log: bool = True,
    **options,
) -> DataFrame:
    """The active version of each edited row, closed; with ``log`` what changed in it."""
    pairs = match(recent, history, key, meta, run_date=run_date, **options).pairs("inner")
    rows = pairs.edited().selectExpr(
        *refs(pairs.keys),
        *pairs.old_values(),
        f"{pairs.old(meta.created)} as {quoted(meta.created)}",
        *([f"{pairs.log} as {quoted(meta.changes)}"] if log else []),
    )
    tail = meta.names if log else meta.names[:3]
    columns = [*pairs.keys, *[field.name for field in pairs.fields], *tail]
    return close_rows(rows, run_date, meta).select(*refs(columns))


def change_log(
    recent: DataFrame,
    history: DataFrame,
    key: KeySpec,
    meta: MetaColumns = DEFAULT_META,
    **options,
) -> DataFrame:
    """Key and JSON change log of each edited row."""
    pairs = match(recent, history, key, meta, **options).pairs("inner")
    return pairs.edited().selectExpr(
        *refs(pairs.keys), f"{pairs.log} as {quoted(meta.changes)}"
    )


def classify(
    recent: DataFrame,
    history: DataFrame,
    key: KeySpec,
    meta: MetaColumns = DEFAULT_META,
    **options,
) -> DataFrame:
    """One row per key and its event: insert, update, unchanged or missing."""
    pairs = match(recent, history, key, meta, **options).pairs("full")
    return pairs.df.selectExpr(*refs(pairs.keys), f"{pairs.event} as event")
