"""Row-level operators: flags, stamps, key filters and unions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from snaptrack.meta import DEFAULT_META, KeySpec, MetaColumns, date_of, key_list, ref, refs


ID_COPIES = 16


def active_rows(df: DataFrame, meta: MetaColumns = DEFAULT_META) -> DataFrame:
    """Current versions. A frame without the flag holds only current rows."""
    return df.filter(ref(meta.active)) if meta.active in df.columns else df


def closed_rows(df: DataFrame, meta: MetaColumns = DEFAULT_META) -> DataFrame:
    """Versions that are no longer current. A frame without the flag has none."""
    return df.filter(~ref(meta.active)) if meta.active in df.columns else df.filter(F.lit(False))


def open_rows(
    df: DataFrame, run_date: dt.date | str | None = None, meta: MetaColumns = DEFAULT_META
) -> DataFrame:
    """Stamp rows as current from ``run_date`` on."""
    return df.withColumns(
        {
            meta.active: F.lit(True),
            meta.created: date_of(run_date),
            meta.edited: F.lit(None).cast("date"),
        }
    )


def close_rows(
    df: DataFrame, run_date: dt.date | str | None = None, meta: MetaColumns = DEFAULT_META
) -> DataFrame:
    """Stamp rows as ended on ``run_date``; the created date stays."""
    return df.withColumns({meta.active: F.lit(False), meta.edited: date_of(run_date)})


def value_columns(df: DataFrame, key: KeySpec, meta: MetaColumns = DEFAULT_META) -> list[str]:
    """Columns that carry data: all but the key and the metadata."""
    skip = {*key_list(key), *meta.names}
    return [name for name in df.columns if name not in skip]


def ensure_history(
    df: DataFrame, run_date: dt.date | str | None = None, meta: MetaColumns = DEFAULT_META
) -> DataFrame:
    """Give a raw table its metadata; a table that has the flag keeps what it stores."""
    if meta.active not in df.columns:
        taken = [name for name in meta.names if name in df.columns]
        if taken:
            raise ValueError(f"columns {taken} are named like metadata but {meta.active} is absent")
        df = open_rows(df, run_date, meta)
    types = {meta.created: "date", meta.edited: "date", meta.changes: "string"}
    absent = {name: F.lit(None).cast(t) for name, t in types.items() if name not in df.columns}
    return df.withColumns(absent) if absent else df


def rows_with_keys(df: DataFrame, ids: DataFrame, key: KeySpec) -> DataFrame:
    """Rows whose key is listed in ``ids``; repeated ids do not multiply rows.

    An id that fills much of ``ids`` is thinned out before the join: copies of an id that
    share the remainder of their task number become one. That leaves up to ``ID_COPIES`` rows
    per id, and as they are not grouped by the key alone, the join shuffles them itself. AQE
    can then split a key that holds much of ``df``, which it does not do for grouped input.
    """
    names = key_list(key)
    remainder = F.pmod(F.spark_partition_id(), F.lit(ID_COPIES))
    listed = ids.select(*refs(names), remainder.alias("_task")).distinct().drop("_task")
    return df.join(listed, names, "left_semi").select(*refs(df.columns))


def union_all(frames: Sequence[DataFrame], order_by: KeySpec | None = None) -> DataFrame:
    """Union by column name, null where a frame lacks a column; sorted only on request."""
    if not frames:
        raise ValueError("union_all needs at least one DataFrame")
    result = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return result if order_by is None else sort_rows(result, key_list(order_by))


def sort_rows(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Global ascending sort. Rows that tie are told apart by a running number, so that the
    range partitions can split a value that holds much of the table."""
    return df.orderBy(*refs(names), F.monotonically_increasing_id())
