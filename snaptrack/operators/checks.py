"""Key checks."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from snaptrack.meta import DEFAULT_META, KeySpec, MetaColumns, key_list, ref, refs
from snaptrack.operators.rows import active_rows


def any_null(names: list[str]) -> Column:
    return reduce(or_, [ref(name).isNull() for name in names])


def key_violations(
    df: DataFrame, key: KeySpec, meta: MetaColumns = DEFAULT_META
) -> DataFrame:
    """Keys that break the model: (key, violation, row_count), none when all is well.

    ``null_key``       part of the key is null
    ``duplicate_key``  more than one row, or in a history more than one active row

    Counts are combined before the shuffle, so a key that holds much of the table costs
    no more than any other.
    """
    names = key_list(key)
    null_key = any_null(names)
    return (
        active_rows(df, meta)
        .groupBy(*refs(names))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(null_key | (F.col("row_count") > 1))
        .select(
            *refs(names),
            F.when(null_key, "null_key").otherwise("duplicate_key").alias("violation"),
            "row_count",
        )
    )


FOREVER = "9999-12-31"


def history_violations(
    history: DataFrame, key: KeySpec, meta: MetaColumns = DEFAULT_META
) -> DataFrame:
    """Periods that break the version model: (key, created, edited, violation, until, row_count).

    ``no_start``           the created date is null
    ``reversed``           the edited date is before the created one
    ``active_with_end``    the flag says current, the edited date says ended
    ``closed_without_end`` the flag says ended and there is no edited date
    ``overlap``            begins before an earlier version of the key has ended, on ``until``
                           (null: it never ends); equal periods overlap too
    ``gap``                begins after ``until``, when all earlier versions had ended

    A gap is lawful where rows may go and come back. Periods are scanned in order of created, then
    edited date; those without a start or reversed are reported and not scanned, and rows without
    a key are those of ``key_violations``.

    Equal periods are counted before the shuffle. The scan runs within a key and a month; what
    earlier months of the key leave open is one date per month, carried into the next. So a key
    with very many versions spreads over tasks.
    """
    keys = key_list(key)
    names = [f"_k{i}" for i in range(len(keys))]
    periods = (
        history.filter(~any_null(keys))
        .groupBy(
            *[ref(key).alias(name) for key, name in zip(keys, names)],
            ref(meta.created).alias("_from"),
            ref(meta.edited).alias("_to"),
            F.coalesce(ref(meta.active), F.lit(False)).alias("_active"),
        )
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    null_date = F.lit(None).cast("date")
    wrong = F.filter(
        F.array(
            F.when(F.col("_from").isNull(), "no_start"),
            F.when(F.col("_to") < F.col("_from"), "reversed"),
            F.when(F.col("_active") & F.col("_to").isNotNull(), "active_with_end"),
            F.when(~F.col("_active") & F.col("_to").isNull(), "closed_without_end"),
        ),
        lambda x: x.isNotNull(),
    )
    flags = periods.select(
        *names, "_from", "_to", F.explode(wrong).alias("violation"), null_date.alias("until"), "row_count"
    )

    end = F.coalesce("_to", F.lit(FOREVER).cast("date"))
    scanned = periods.filter("_from is not null and (_to is null or _to >= _from)")
    scanned = scanned.groupBy(*names, "_from", "_to").agg(F.sum("row_count").alias("row_count"))
    scanned = scanned.withColumn("_month", F.trunc("_from", "month"))
    months = scanned.groupBy(*names, "_month").agg(F.max(end).alias("_last"))
    earlier = Window.partitionBy(*names).orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    carried = months.select(*names, "_month", F.max("_last").over(earlier).alias("_carried"))
    inside = (
        Window.partitionBy(*names, "_month")
        .orderBy("_from", F.asc_nulls_last("_to"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    known = scanned.withColumn("_inside", F.max(end).over(inside)).join(carried, [*names, "_month"])
    until = F.greatest("_carried", "_inside", F.when(F.col("row_count") > 1, end))
    found = known.withColumn("until", until)
    violation = F.when(F.col("_from") < F.col("until"), "overlap").when(
        F.col("_from") > F.col("until"), "gap"
    )
    breaks = found.withColumn("violation", violation).filter("violation is not null").select(
        *names, "_from", "_to", "violation",
        F.when(F.col("until") < F.lit(FOREVER).cast("date"), F.col("until")).alias("until"),
        "row_count",
    )
    renamed = zip([*names, "_from", "_to"], [*keys, meta.created, meta.edited])
    return flags.unionByName(breaks).withColumnsRenamed(dict(renamed))
