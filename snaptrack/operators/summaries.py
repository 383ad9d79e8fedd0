"""Summaries of runs that can be put together for any range of runs without reading them again."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from snaptrack.meta import DEFAULT_META, KeySpec, MetaColumns, date_of, key_list, ref
from snaptrack.operators.reads import explode_changes

LOG_SIZE = 12  # HyperLogLog of 4096 registers: a standard error of 1.04 / 64, or 1.6 %
RANK_SIZE = 200  # KLL: ranks are off by less than 1.7 % in 99 of 100 cases


def run_summaries(
    history: DataFrame, key: KeySpec, meta: MetaColumns = DEFAULT_META
) -> DataFrame:
    """``run_date, column_name, edit_count, keys, differences``: one row per run and edited column.

    ``keys`` is a sketch of the distinct keys edited, ``differences`` one of new less old value for
    columns of numbers, null for others. Both have a fixed size, so the summary of a run is small
    whatever the run: keep it with the run, and read runs no more to answer questions on ranges.
    """
    keys = key_list(key)
    numbers = [f.name for f in history.schema if isinstance(f.dataType, T.NumericType)]
    cells = explode_changes(history, keys, meta)
    is_number = F.col("column_name").isin(numbers) if numbers else F.lit(False)
    difference = F.expr("try_cast(new_value as double) - try_cast(old_value as double)")
    usable = F.when(is_number & ~F.isnan(difference), difference)
    rows = cells.select(
        ref(meta.edited).alias("run_date"), "column_name",
        F.xxhash64(*[ref(name) for name in keys]).alias("_key"), usable.alias("_difference"),
    )
    found = rows.groupBy("run_date", "column_name").agg(
        F.count(F.lit(1)).alias("edit_count"),
        F.hll_sketch_agg("_key", LOG_SIZE).alias("keys"),
        F.count("_difference").alias("_numbers"),
        F.kll_sketch_agg_double("_difference", RANK_SIZE).alias("differences"),
    )
    return found.withColumn("differences", F.when(F.col("_numbers") > 0, F.col("differences"))).drop("_numbers")


def merge_summaries(
    summaries: DataFrame,
    since: dt.date | str | None = None,
    until: dt.date | str | None = None,
    quantiles: Sequence[float] = (0.1, 0.5, 0.9),
) -> DataFrame:
    """``column_name, edit_count, key_count, differences``: the runs of a range, both ends
    included, as one. ``edit_count`` is exact, ``key_count`` an estimate of the distinct keys
    edited, and ``differences`` estimates of the quantiles, null where a column has none."""
    rows = summaries
    if since is not None:
        rows = rows.filter(F.col("run_date") >= date_of(since))
    if until is not None:
        rows = rows.filter(F.col("run_date") <= date_of(until))
    merged = rows.groupBy("column_name").agg(
        F.sum("edit_count").alias("edit_count"),
        F.hll_sketch_estimate(F.hll_union_agg("keys")).alias("key_count"),
        F.count("differences").alias("_numbers"),
        F.kll_merge_agg_double("differences").alias("_merged"),
    )
    ranks = F.array(*[F.lit(float(q)) for q in quantiles])
    asked = F.when(F.col("_numbers") > 0, F.kll_sketch_get_quantile_double("_merged", ranks))
    return merged.select("column_name", "edit_count", "key_count", asked.alias("differences"))
