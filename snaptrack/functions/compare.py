"""SQL expressions to compare, print and fingerprint values of any type.

Everything here is a built-in expression, so a diff runs without Python workers. The
expressions are text: a plan over hundreds of columns is then built with one call per select
and not with dozens per column.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F, types as T

from snaptrack.meta import quoted

KEEP_NULLS = "map('ignoreNullFields', 'false')"
DROP_NULLS = "map('ignoreNullFields', 'true')"


class Pair(NamedTuple):
    """New and old value of a column, as SQL text."""

    name: str
    new: str
    old: str
    data_type: T.DataType


def has_unordered_part(data_type: T.DataType) -> bool:
    """True for types ``<=>`` does not accept: maps and variants, at any depth."""
    if isinstance(data_type, (T.MapType, T.VariantType)):
        return True
    if isinstance(data_type, T.ArrayType):
        return has_unordered_part(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return any(has_unordered_part(field.dataType) for field in data_type)
    return False


def comparable(value: str, data_type: T.DataType, depth: int = 0) -> str:
    """A form of ``value`` that ``<=>`` accepts; equal values have equal forms.

    Maps become arrays of their entries in key order, so the order in which entries were
    put into the map does not count.
    """
    if not has_unordered_part(data_type):
        return value
    item = f"x{depth}"
    if isinstance(data_type, T.MapType):
        key = comparable(f"{item}.key", data_type.keyType, depth + 1)
        entry = comparable(f"{item}.value", data_type.valueType, depth + 1)
        entries = f"transform(map_entries({value}), {item} -> struct({key} as k, {entry} as v))"
        return f"array_sort({entries})"
    if isinstance(data_type, T.ArrayType):
        return f"transform({value}, {item} -> {comparable(item, data_type.elementType, depth + 1)})"
    if isinstance(data_type, T.StructType):
        fields = [
            f"{comparable(f'{value}.{quoted(field.name)}', field.dataType, depth)} "
            f"as {quoted(field.name)}"
            for field in data_type
        ]
        return f"if({value} is null, null, struct({', '.join(fields)}))"
    return f"to_json({value})"


def same_value(pair: Pair) -> str:
    """Null-safe equality: null equals null, NaN equals NaN, 0.0 equals -0.0."""
    new, old = (comparable(value, pair.data_type) for value in (pair.new, pair.old))
    return f"({new} <=> {old})"


def any_differs(pairs: Sequence[Pair]) -> str:
    return " or ".join(f"not {same_value(pair)}" for pair in pairs) or "false"


def value_text(value: str, data_type: T.DataType) -> str:
    """Text of a value for the change log; null stays null."""
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return f"to_json({value}, {KEEP_NULLS})"
    if isinstance(data_type, T.BinaryType):
        return f"base64({value})"
    return f"cast({value} as string)"


def change_text(pairs: Sequence[Pair]) -> str:
    """JSON of the pairs that differ, ``{"name": ["new", "old"]}``, in the order given."""
    parts = []
    for pair in pairs:
        texts = [value_text(value, pair.data_type) for value in (pair.new, pair.old)]
        changed = f"if({same_value(pair)}, null, array({', '.join(texts)}))"
        parts.append(f"{changed} as {quoted(pair.name)}")
    # Equal values are null here, and their fields are left out whatever the session says.
    return f"to_json(struct({', '.join(parts)}), {DROP_NULLS})" if parts else "cast(null as string)"


def fingerprint(
    df: DataFrame, columns: Sequence[str], name: str = "fingerprint", secure: bool = False
) -> DataFrame:
    """Add one hash over ``columns``; equal rows have equal hashes.

    The 64-bit hash can tell rows apart, not prove them equal, so no diff in this package
    decides by it. ``secure=True`` gives SHA-256 over the JSON of the row.
    """
    values = []
    for column in columns:
        data_type, value = df.schema[column].dataType, quoted(column)
        # Nulls leave a running hash as it is: the flag keeps (a, null) and (null, a) apart.
        values += [f"{value} is null", hashable(value, data_type)]
    if secure:
        fields = ", ".join(f"{value} as c{i}" for i, value in enumerate(values))
        return df.withColumn(name, F.expr(f"sha2(to_json(struct({fields}), {KEEP_NULLS}), 256)"))
    return df.withColumn(name, F.expr(f"xxhash64({', '.join(values)})"))


def hashable(value: str, data_type: T.DataType, depth: int = 0) -> str:
    """``comparable`` with one zero at any depth: -0.0 and 0.0 are equal but print differently."""
    item = f"z{depth}"
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return f"if({value} = 0, cast(0 as {data_type.simpleString()}), {value})"
    if isinstance(data_type, T.ArrayType):
        return f"transform({value}, {item} -> {hashable(item, data_type.elementType, depth + 1)})"
    if isinstance(data_type, T.MapType):
        key = hashable(f"{item}.key", data_type.keyType, depth + 1)
        entry = hashable(f"{item}.value", data_type.valueType, depth + 1)
        entries = f"transform(map_entries({value}), {item} -> struct({key} as k, {entry} as v))"
        return f"array_sort({entries})"
    if isinstance(data_type, T.StructType):
        fields = [
            f"{hashable(f'{value}.{quoted(field.name)}', field.dataType, depth)} "
            f"as {quoted(field.name)}"
            for field in data_type
        ]
        return f"if({value} is null, null, struct({', '.join(fields)}))"
    return comparable(value, data_type, depth)
