"""Bring a snapshot and a history to one set of columns and types."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F, types as T

from snaptrack.meta import KeySpec, MetaColumns, key_list, quoted, ref, refs
from snaptrack.operators.rows import value_columns


NO_PLAIN_TEXT = (T.ArrayType, T.MapType, T.StructType, T.VariantType, T.BinaryType)


def shared_type(df: DataFrame, name: str, left: T.DataType, right: T.DataType) -> T.DataType:
    """A type that holds the values of both; text when one side is text.

    No stored value turns into null or loses digits: where no such type exists, it is an
    error.
    """
    if left == right:
        return left
    sides = (left, right)
    problem = ValueError(
        f"column {name!r} is {left.simpleString()} in the snapshot and "
        f"{right.simpleString()} in the history; cast one of them first"
    )
    if any(isinstance(side, T.StringType) for side in sides):
        if any(isinstance(side, NO_PLAIN_TEXT) for side in sides):
            raise problem
        return T.StringType()
    if {type(left), type(right)} == {T.IntegerType, T.FloatType}:
        return T.DoubleType()  # a float cannot hold every int, whatever the session widens to
    exact = any(isinstance(side, (T.LongType, T.DecimalType)) for side in sides)
    if exact and any(isinstance(side, (T.FloatType, T.DoubleType)) for side in sides):
        raise problem
    try:
        probe = F.coalesce(F.lit(None).cast(left), F.lit(None).cast(right))
        return df.select(probe.alias(name)).schema[name].dataType
    except AnalysisException as error:
        raise problem from error


def align(
    recent: DataFrame,
    history: DataFrame,
    key: KeySpec,
    meta: MetaColumns,
    strict: bool = False,
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Return both frames with the same value columns and types, and the column names.

    Columns follow the snapshot, then those only the history has. A column one side lacks is
    null there; with ``strict=True`` it is an error. A snapshot that carries the metadata
    columns is compared without them: the history owns them.
    """
    keys = key_list(key)
    for side, frame in (("snapshot", recent), ("history", history)):
        absent = [name for name in keys if name not in frame.columns]
        if absent:
            raise ValueError(f"key columns {absent} are not in the {side}")
    named = [name for name in meta.names if name in recent.columns]
    if named and not {meta.active, meta.created, meta.edited} <= set(named):
        raise ValueError(f"snapshot columns {named} are named like metadata; rename the metadata")
    new_values, old_values = value_columns(recent, keys, meta), value_columns(history, keys, meta)
    values = new_values + [name for name in old_values if name not in new_values]
    if strict and set(new_values) != set(old_values):
        differing = sorted(set(new_values) ^ set(old_values))
        raise ValueError(f"columns {differing} are on one side only")

    new_types = {field.name: field.dataType for field in recent.schema}
    old_types = {field.name: field.dataType for field in history.schema}
    new_columns, old_columns = [], []
    for name in keys + values:
        left, right = new_types.get(name), old_types.get(name)
        target = shared_type(recent, name, left or right, right or left)
        new_columns.append(_as(name, left, target))
        old_columns.append(_as(name, right, target))
    kept_meta = refs(name for name in meta.names if name in old_types)
    return recent.select(*new_columns), history.select(*old_columns, *kept_meta), values


def _as(name: str, current: T.DataType | None, target: T.DataType) -> str | Column:
    if current is None:
        return F.lit(None).cast(target).alias(name)
    return quoted(name) if current == target else ref(name).cast(target).alias(name)


def same_types(before: DataFrame, after: DataFrame) -> None:
    """Files of all runs are read with one schema: columns may be added, not change type."""
    types = {field.name: field.dataType for field in after.schema}
    for field in before.schema:
        if types[field.name] != field.dataType:
            raise ValueError(
                f"column {field.name!r} is stored as {field.dataType.simpleString()} but the "
                f"snapshot makes it {types[field.name].simpleString()}; cast the snapshot"
            )
