"""Versions seen through some of their columns, and versions rebuilt from the log alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from snaptrack.functions.compare import Pair, same_value
from snaptrack.meta import DEFAULT_META, KeySpec, MetaColumns, key_list, quoted, ref, refs
from snaptrack.operators.checks import any_null
from snaptrack.operators.reads import LOG_TYPE
from snaptrack.operators.rows import value_columns


def coalesce_versions(
    history: DataFrame,
    key: KeySpec,
    columns: Sequence[str],
    meta: MetaColumns = DEFAULT_META,
) -> DataFrame:
    """The history of some value columns: versions that differ in none of them become one.

    Versions of a key follow each other if one begins on the day the other ends. Those that follow
    each other with equal values are one version, from the first's created to the last's edited
    date; its log is that of the last, without the columns left out. So the result is the history
    that snapshots without these columns would have given. Values are compared as in the diff.

    The scan orders the versions of a key, of which a sound history has one a day at most. Rows
    without a key, which nothing orders, are kept as they are.
    """
    keys = key_list(key)
    unknown = [name for name in columns if name not in value_columns(history, keys, meta)]
    if unknown:
        raise ValueError(f"{unknown} are no value columns of the history")
    names = [*keys, *columns, *meta.names]
    log = F.from_json(ref(meta.changes), LOG_TYPE)
    rows = history.select(*refs(names)).withColumn("_log", log)
    rest = [F.try_element_at("_log", F.lit(name)).alias(name) for name in columns]
    text = F.to_json(F.struct(*rest), {"ignoreNullFields": "true"}) if rest else F.lit("{}")
    rows = rows.withColumn(meta.changes, F.when(F.col("_log").isNotNull(), F.nullif(text, F.lit("{}"))))
    rows = rows.drop("_log")
    order = Window.partitionBy(*refs(keys)).orderBy(
        ref(meta.created), F.asc_nulls_last(quoted(meta.edited))
    )
    before = rows.filter(~any_null(keys)).withColumns(
        {
            "_ended": F.lag(ref(meta.edited)).over(order),
            **{f"_v{i}": F.lag(ref(name)).over(order) for i, name in enumerate(columns)},
        }
    )
    equal = " and ".join(
        same_value(Pair(name, quoted(name), f"_v{i}", history.schema[name].dataType))
        for i, name in enumerate(columns)
    )
    follows = F.coalesce(F.col("_ended") == ref(meta.created), F.lit(False))
    starts = ~(follows & F.expr(equal or "true"))
    islands = before.withColumn("_starts", starts.cast("int")).withColumn(
        "_island", F.sum("_starts").over(order)
    )
    place = F.struct(ref(meta.created), F.coalesce(ref(meta.edited), F.lit("9999-12-31").cast("date")))
    last = {name: F.max_by(ref(name), place).alias(name) for name in (meta.active, meta.edited, meta.changes)}
    first = F.struct(*refs(columns)) if columns else F.struct(F.lit(1))
    merged = islands.groupBy(*refs(keys), "_island").agg(
        F.min_by(first, place).alias("_first"), F.min(ref(meta.created)).alias(meta.created), *last.values()
    )
    merged = merged.select(
        *refs(keys), *[F.col(f"_first.{quoted(name)}").alias(name) for name in columns], *refs(meta.names)
    )
    return merged.unionByName(rows.filter(any_null(keys)))


def thin_versions(history: DataFrame, key: KeySpec, meta: MetaColumns = DEFAULT_META) -> DataFrame:
    """The history with nulls for the values of versions that their log can bring back."""
    values = value_columns(history, key_list(key), meta)
    logged = _is_logged(key_list(key), meta)
    return history.withColumns({name: F.when(~logged, ref(name)) for name in values})


def rebuild_versions(
    history: DataFrame, key: KeySpec, meta: MetaColumns = DEFAULT_META
) -> DataFrame:
    """The history with the values of edited versions rebuilt from the log, newest first.

    A version that was closed by an edit takes, for each column, the old value of its own log or,
    where that does not name the column, the value of the version after it. Values that stand
    without a log, of current versions and of those whose key went missing, are where that begins.
    The stored values of edited versions are not read, so they may be nulls (``thin_versions``).

    Text is cast back to the column's type; JSON of nested values is parsed. Exact but for instants
    inside nested values, which the log holds to the millisecond. The scan orders the versions of a
    key, of which a sound history has one a day at most.
    """
    keys = key_list(key)
    fields = [history.schema[name] for name in value_columns(history, keys, meta)]
    versions = Window.partitionBy(*refs(keys)).orderBy(
        ref(meta.created), F.asc_nulls_last(quoted(meta.edited))
    )
    later = versions.rowsBetween(0, Window.unboundedFollowing)
    rows = history.filter(~any_null(keys)).withColumn("_log", F.from_json(ref(meta.changes), LOG_TYPE))
    logged = _is_logged(keys, meta)
    values = {}
    for field in fields:
        pair = F.try_element_at("_log", F.lit(field.name))
        old = F.when(pair.isNotNull(), F.struct(_parsed(F.get(pair, F.lit(1)), field).alias("value")))
        known = F.when(logged, old).otherwise(F.struct(ref(field.name).alias("value")))
        values[field.name] = F.first(known, ignorenulls=True).over(later)["value"]
    rebuilt = rows.select(
        *[
            values[name].alias(name) if name in values else ref(name)
            for name in history.columns
        ]
    )
    return rebuilt.unionByName(history.filter(any_null(keys)))


def _is_logged(keys: list[str], meta: MetaColumns):
    active = F.coalesce(ref(meta.active), F.lit(False))
    return ~active & ref(meta.changes).isNotNull() & ~any_null(keys)


def _parsed(text, field: T.StructField):
    """The value that ``value_text`` has printed."""
    kind = field.dataType
    if isinstance(kind, T.BinaryType):
        return F.unbase64(text)
    if isinstance(kind, T.VariantType):
        return F.parse_json(text)
    if isinstance(kind, T.MapType) and not isinstance(kind.keyType, T.StringType):
        entries = F.from_json(text, T.MapType(T.StringType(), kind.valueType))
        return F.transform_keys(entries, lambda name, _: name.cast(kind.keyType))
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.from_json(text, kind)
    return text.cast(kind)
