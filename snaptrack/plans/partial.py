"""A run on a partial snapshot: the rows that are new or edited, and the keys that are gone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from snaptrack.meta import KeySpec, as_day, key_list, ref, refs
from snaptrack.operators.checks import any_null
from snaptrack.operators.history import run_rows
from snaptrack.operators.rows import close_rows
from snaptrack.plans.align import same_types
from snaptrack.sources.history_table import HistoryTable


def apply_changes(
    spark: SparkSession,
    table: HistoryTable,
    run_date: dt.date | str,
    changes: DataFrame,
    key: KeySpec,
    deleted: str | None = None,
    **options,
) -> None:
    """Run a partial snapshot against the state before its date and store the result.

    Keys that ``changes`` does not name stay as they are. With ``deleted``, a column of booleans,
    the keys of rows where it is true are closed and their other values are not read.

    ``table`` is stored in parts of the key: only the parts that the keys fall into are read and
    written, so the run costs what it touches. At most ``table.parts`` numbers are collected.
    """
    keys, day = key_list(key), as_day(run_date)
    if table.parts is None or key_list(table.key) != keys:
        raise ValueError(f"apply_changes needs a table that is stored in parts of {keys}")
    runs, base = table.runs(spark), table.base(spark, day)
    if runs and runs[-1] > day:
        raise ValueError(f"run date {day} is older than the newest run, {runs[-1]}")
    if base is None:
        raise ValueError(f"{table.root} has no state before {day}; write a first history")
    known = changes.filter(~any_null(keys))
    stored = table.read(spark, base["run_date"])
    # The hash of a key depends on its type: it is that of the stored key.
    placed = known.select(*[ref(name).cast(stored.schema[name].dataType).alias(name) for name in keys])
    touched = sorted(row[0] for row in placed.select(table.part_of()).distinct().collect())
    before = table.parts_of(spark, base, touched)
    gone, recent = None, known
    if deleted is not None:
        is_gone = F.coalesce(ref(deleted), F.lit(False))
        gone = known.filter(is_gone).select(*refs(keys)).distinct()
        recent = known.filter(~is_gone).drop(deleted)
        both = recent.join(gone, keys, "left_semi").limit(1).count()
        if both:
            raise ValueError("a key is both deleted and given values")
    staying = before if gone is None else before.join(gone, keys, "left_anti")
    rows = run_rows(
        recent, staying, key, day, table.meta, missing="keep", trusted_history=bool(base.checked), **options
    )
    if gone is not None:
        closed = close_rows(before.join(gone, keys, "left_semi"), day, table.meta)
        rows = rows.unionByName(closed, allowMissingColumns=True)
    same_types(before, rows)
    table.write(rows, day, checked=True, base=base, missing="keep", touched=touched)
