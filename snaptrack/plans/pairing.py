"""One join that sets each row of a snapshot beside its active history version."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from snaptrack.functions.compare import Pair, any_differs, change_text, comparable
from snaptrack.meta import MetaColumns, date_of, quoted, ref, refs
from snaptrack.operators.checks import any_null

NEW, OLD = "_new_", "_old_"
DUPLICATE_POLICIES = ("error", "keep_first", "trust")


@dataclass(frozen=True)
class Pairs:
    """Snapshot rows beside history rows: key, ``_new_*`` and ``_old_*`` columns.

    The values stay flat columns: packed into structs they made the join about a third slower.
    The properties are SQL text over ``df``.
    """

    df: DataFrame
    keys: list[str]
    fields: list[T.StructField]
    meta: MetaColumns

    def new(self, name: str) -> str:
        return quoted(NEW + name)

    def old(self, name: str) -> str:
        return quoted(OLD + name)

    @property
    def values(self) -> list[Pair]:
        return [Pair(f.name, self.new(f.name), self.old(f.name), f.dataType) for f in self.fields]

    @property
    def event(self) -> str:
        return (
            f"case when {OLD} is null then 'insert' when {NEW} is null then 'missing' "
            f"when {any_differs(self.values)} then 'update' else 'unchanged' end"
        )

    @property
    def log(self) -> str:
        """JSON of the values that differ."""
        return change_text(self.values)

    def new_values(self) -> list[str]:
        return [f"{pair.new} as {quoted(pair.name)}" for pair in self.values]

    def old_values(self) -> list[str]:
        return [f"{pair.old} as {quoted(pair.name)}" for pair in self.values]

    def inserted(self) -> DataFrame:
        """Snapshot rows of a left join that have no active version."""
        return self.df.filter(f"{OLD} is null")

    def edited(self) -> DataFrame:
        """Pairs with both sides in which some value differs."""
        return self.df.filter(any_differs(self.values))


def pair_versions(
    recent: DataFrame,
    active: DataFrame,
    keys: list[str],
    values: list[str],
    how: str,
    meta: MetaColumns,
) -> Pairs:
    """Join aligned sides without null keys; whether keys repeat is not checked here."""
    stamps = [name for name in meta.names if name in active.columns]
    sides = [
        frame.selectExpr(
            *refs(keys),
            f"true as {prefix}",
            *[f"{quoted(name)} as {quoted(prefix + name)}" for name in names],
        )
        for frame, prefix, names in ((recent, NEW, values), (active, OLD, [*values, *stamps]))
    ]
    schema = recent.schema
    return Pairs(sides[0].join(sides[1], keys, how), keys, [schema[name] for name in values], meta)


def with_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that can be matched: a null key equals nothing."""
    return df.filter(~any_null(keys))


def first_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The first row of each key in the given order.

    Spark keeps the first row of a key in each task before the shuffle (window group
    limit), so copies of one key do not pile up in one task. Rows that tie in ``order_by``
    are ordered by their other columns, maps and variants by their comparable form.
    """
    others = [
        F.expr(comparable(quoted(field.name), field.dataType))
        for field in df.schema
        if field.name not in (*keys, *order_by)
    ]
    window = Window.partitionBy(*refs(keys)).orderBy(*refs(order_by), *others)
    return df.withColumn("_place", F.row_number().over(window)).filter("_place = 1").drop("_place")


def prepare_recent(
    recent: DataFrame,
    keys: list[str],
    on_duplicate: str,
    order_by: list[str] | None,
) -> DataFrame:
    """Snapshot rows to match, one per key if the policy says so."""
    if on_duplicate not in DUPLICATE_POLICIES:
        raise ValueError(f"on_duplicate must be one of {DUPLICATE_POLICIES}")
    matched = with_key(recent, keys)
    if on_duplicate != "keep_first":
        return matched
    if not order_by:
        raise ValueError("on_duplicate='keep_first' needs order_by columns")
    return first_per_key(matched, keys, order_by)


def key_guard(
    recent: DataFrame | None,
    active: DataFrame | None,
    keys: list[str],
    meta: MetaColumns,
    run_date: dt.date | str | None = None,
) -> Column:
    """A condition that is true, or fails the query if a key occurs twice on a given side.

    It is a scalar subquery over the key columns alone. The subquery ends before the stage
    that joins starts, and counts are combined before its shuffle, so a key that holds a
    third of the rows fails the query early instead of multiplying in one task. The same pass
    over the history refuses a run date older than the newest version.
    """
    keys_of = []
    if recent is not None:
        stamps = [F.lit(1), F.lit(0), F.lit(None).cast("date")]
        keys_of.append((recent, stamps))
    if active is not None:
        stamps = [F.lit(0), F.lit(1), ref(meta.created)]
        keys_of.append((active, stamps))
    names = ("_recent", "_active", "_newest")
    sides = [
        frame.select(*refs(keys), *[column.alias(name) for column, name in zip(stamps, names)])
        for frame, stamps in keys_of
    ]
    per_key = (
        reduce(DataFrame.union, sides)
        .groupBy(*refs(keys))
        .agg(
            F.sum("_recent").alias("recent"),
            F.sum("_active").alias("active"),
            F.max("_newest").alias("newest"),
        )
    )
    found = per_key.groupBy().agg(
        F.count_if(F.col("recent") > 1).alias("recent"),
        F.count_if(F.col("active") > 1).alias("active"),
        F.max("newest").alias("newest"),
    )
    repeated = F.concat(
        F.lit("duplicate keys: "),
        F.col("recent").cast("string"),
        F.lit(" in the snapshot, "),
        F.col("active").cast("string"),
        F.lit(" among the active history rows; see key_violations"),
    )
    verdict = F.when(F.col("recent") + F.col("active") > 0, _fail(repeated))
    if run_date is not None:
        late = F.concat(
            F.lit(f"run date {run_date} is older than the newest version, "),
            F.col("newest").cast("string"),
        )
        verdict = verdict.when(F.col("newest") > date_of(run_date), _fail(late))
    return found.select(verdict.otherwise(F.lit(True)).alias("ok")).scalar()


def _fail(message: Column) -> Column:
    return F.raise_error(message).cast("boolean")
