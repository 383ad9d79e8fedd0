"""Read a history: state on a date, versions of a key, what changed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from snaptrack.meta import DEFAULT_META, KeySpec, MetaColumns, date_of, key_list, ref, refs
from snaptrack.operators.diff import classify

LOG_TYPE = "map<string,array<string>>"


def as_of(
    history: DataFrame,
    day: dt.date | str,
    meta: MetaColumns = DEFAULT_META,
    keep_meta: bool = False,
) -> DataFrame:
    """The table as it was on ``day``: versions with created <= day < edited."""
    on = date_of(day)
    valid = (ref(meta.created) <= on) & (ref(meta.edited).isNull() | (ref(meta.edited) > on))
    rows = history.filter(valid)
    return rows if keep_meta else rows.drop(*meta.names)


def join_as_of(
    facts: DataFrame,
    history: DataFrame,
    key: KeySpec,
    on: str,
    meta: MetaColumns = DEFAULT_META,
) -> DataFrame:
    """Each fact with the values its key had on the day of the column ``on``.

    Adds the values of the version that was valid on that day and its created and edited dates;
    they are null where there was none, and for facts without a key or a day. Facts and history
    have the key columns in common and no others. Where versions overlap, which is an error of the
    history (see ``history_violations``), the one that began last counts.

    There is no join on a range. The distinct days of a key's facts, which the calendar bounds,
    are put among its versions in order of time, and the last version before each day is carried
    down to it. The facts then join on key and day, so a key that holds much of them spreads over
    tasks: that join has one row per key and day on its other side, and AQE splits the facts.
    """
    keys = key_list(key)
    values = [name for name in history.columns if name not in (*keys, *meta.names)]
    added = [*values, meta.created, meta.edited]
    clash = sorted(set(facts.columns) & set(added))
    if clash:
        raise ValueError(f"columns {clash} are in the facts and in the history; rename them")
    names = [f"_k{i}" for i in range(len(keys))]
    day = F.to_date(ref(on))

    def known(rows: DataFrame) -> DataFrame:
        return rows.filter(" and ".join(f"{name} is not null" for name in [*names, "_day"]))

    renamed = [ref(key).alias(name) for key, name in zip(keys, names)]
    days = known(facts.select(*renamed, day.alias("_day"))).distinct()
    version = F.struct(*[ref(name).alias(f"_v{i}") for i, name in enumerate(added)])
    versions = known(history.select(*renamed, ref(meta.created).alias("_day"), version.alias("_version")))
    both = days.select("*", F.lit(None).cast(versions.schema["_version"].dataType).alias("_version"))
    # Versions of a day come before the facts of that day.
    order = Window.partitionBy(*names).orderBy(
        "_day", F.col("_version").isNull(), F.asc_nulls_last(f"_version._v{len(added) - 1}")
    )
    last = F.last("_version", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    carried = (
        both.unionByName(versions)
        .withColumns({"_last": last, "_is_day": F.col("_version").isNull()})
        .filter("_is_day")
    )
    ended = F.col(f"_last._v{len(added) - 1}")
    valid = carried.filter(ended.isNull() | (ended > F.col("_day"))).select(*names, "_day", "_last")
    same = [ref(key) == F.col(name) for key, name in zip(keys, names)]
    return facts.join(valid, [*same, day == F.col("_day")], "left").select(
        *refs(facts.columns), *[F.col(f"_last._v{i}").alias(name) for i, name in enumerate(added)]
    )


def timeline(history: DataFrame, key: KeySpec, meta: MetaColumns = DEFAULT_META) -> DataFrame:
    """Add version_number, previous_from, next_from and days_valid to each version.

    Versions of a key are ordered by created date, then edited date with the current one
    last; rows with the same two dates share a version number. days_valid is null for
    versions that are still open.

    The window runs over the distinct dates of a key, which the calendar bounds, and not
    over its rows. The numbers are then joined to the rows on key and dates, so that the
    rows of a key with very many versions spread over tasks.
    """
    keys = key_list(key)
    aliases = {name: f"_p{i}" for i, name in enumerate([*keys, meta.created, meta.edited])}
    created, edited = F.col(aliases[meta.created]), F.col(aliases[meta.edited])
    versions = Window.partitionBy(*[aliases[name] for name in keys]).orderBy(
        created, edited.asc_nulls_last()
    )
    periods = (
        history.select(*[ref(name).alias(alias) for name, alias in aliases.items()])
        .distinct()
        .withColumns(
            {
                "version_number": F.row_number().over(versions),
                "previous_from": F.lag(created).over(versions),
                "next_from": F.lead(created).over(versions),
            }
        )
    )
    same = [ref(name).eqNullSafe(F.col(alias)) for name, alias in aliases.items()]
    return (
        history.join(periods, same, "left")
        .drop(*aliases.values())
        .withColumn("days_valid", F.datediff(ref(meta.edited), ref(meta.created)))
    )


def change_summary(
    recent: DataFrame,
    history: DataFrame,
    key: KeySpec,
    meta: MetaColumns = DEFAULT_META,
    **options,
) -> DataFrame:
    """Number of keys per event."""
    events = classify(recent, history, key, meta, **options)
    return events.groupBy("event").agg(F.count(F.lit(1)).alias("key_count"))


def explode_changes(
    history: DataFrame, key: KeySpec, meta: MetaColumns = DEFAULT_META
) -> DataFrame:
    """One row per changed cell: key, edit date, column_name, new_value, old_value."""
    names = refs(key_list(key))
    cells = F.explode_outer(F.from_json(ref(meta.changes), LOG_TYPE))
    return (
        _logged(history, meta)
        .select(*names, ref(meta.edited), cells.alias("column_name", "_pair"))
        .filter(F.col("column_name").isNotNull())
        .select(
            *names,
            ref(meta.edited),
            "column_name",
            F.col("_pair")[0].alias("new_value"),
            F.col("_pair")[1].alias("old_value"),
        )
    )


def column_change_counts(history: DataFrame, meta: MetaColumns = DEFAULT_META) -> DataFrame:
    """Number of edits per column over the whole history."""
    names = F.explode_outer(F.json_object_keys(ref(meta.changes)))
    return (
        _logged(history, meta)
        .select(names.alias("column_name"))
        .filter(F.col("column_name").isNotNull())
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("edit_count"))
    )


def _logged(history: DataFrame, meta: MetaColumns) -> DataFrame:
    """Versions with a change log; the filter reaches the Parquet scan.

    Their logs are read with explode_outer: for plain explode the optimizer adds a filter that
    parses each log once more.
    """
    return history.filter(ref(meta.changes).isNotNull())
