"""Rows that were given another key: a missing and a new row with the same values."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from snaptrack.functions.compare import Pair, fingerprint, same_value
from snaptrack.meta import DEFAULT_META, KeySpec, MetaColumns, quoted, ref, refs
from snaptrack.operators.diff import classify, match
from snaptrack.plans.pairing import NEW, OLD
from snaptrack.sources.workspace import new_folder

PREVIOUS = "previous_"


def moved_keys(
    recent: DataFrame,
    history: DataFrame,
    key: KeySpec,
    meta: MetaColumns = DEFAULT_META,
    **options,
) -> DataFrame:
    """New keys beside the keys that their rows had before, as ``previous_<key>``.

    A row without an active version and an active version that the snapshot lacks are one row that
    moved if all their values are equal. Each takes part in one move at most: of several rows with
    the same values the first by key goes with the first, the second with the second, and so on.

    Values are looked up by SHA-256 and compared again in the end. Rows with the same values may be
    very many, so they are not numbered by a window over them: a sort by values and key spreads
    them over tasks, and a row's number is its place in the sort less that of the first of its
    kind. Both sides then join on values and number, which no two rows of a side share.
    """
    matched = match(recent, history, key, meta, **options)
    pairs = matched.pairs("full")
    loose = pairs.df.filter(f"{NEW} is null or {OLD} is null").selectExpr(
        *refs(pairs.keys),
        f"{NEW} is not null as _is_new",
        *[f"if({NEW} is null, {pair.old}, {pair.new}) as {quoted(pair.name)}" for pair in pairs.values],
    )
    names = [pair.name for pair in pairs.values]
    loose = _written(fingerprint(loose, names, "_print", secure=True), "loose")
    # Few values stand on both sides; the others need no sort.
    both = loose.groupBy("_print").agg(
        F.bool_or("_is_new").alias("_new"), F.bool_and("_is_new").alias("_all")
    )
    both = both.filter("_new and not _all").select("_print")
    rows = _numbered(loose.join(both, "_print", "left_semi"), ["_print", "_is_new", *refs(pairs.keys)])
    firsts = rows.groupBy("_print", "_is_new").agg(F.min("_place").alias("_first"))
    rows = rows.join(firsts, ["_print", "_is_new"]).withColumn("_rank", F.col("_place") - F.col("_first"))
    rows = _written(rows.drop("_place", "_first"), "ranked")

    def side(is_new: bool, mark: str) -> DataFrame:
        columns = [ref(n).alias(f"_{mark}{i}") for i, n in enumerate([*pairs.keys, *names])]
        chosen = rows.filter(F.col("_is_new") if is_new else ~F.col("_is_new"))
        return chosen.select("_print", "_rank", *columns)

    count = len(pairs.keys)
    equal = [
        F.expr(same_value(Pair(n, f"_n{i}", f"_o{i}", pairs.fields[i - count].dataType)))
        for i, n in enumerate(names, count)
    ]
    moved = side(True, "n").join(side(False, "o"), ["_print", "_rank"])
    for test in equal:
        moved = moved.filter(test)
    return moved.select(
        *[F.col(f"_n{i}").alias(name) for i, name in enumerate(pairs.keys)],
        *[F.col(f"_o{i}").alias(PREVIOUS + name) for i, name in enumerate(pairs.keys)],
    )


def classify_with_moves(
    recent: DataFrame,
    history: DataFrame,
    key: KeySpec,
    meta: MetaColumns = DEFAULT_META,
    **options,
) -> DataFrame:
    """``classify`` with the event ``moved``: one row for the new key, which names the previous
    one, in place of an insert and a missing row."""
    events = classify(recent, history, key, meta, **options)
    keys = [name for name in events.columns if name != "event"]
    moved = _written(moved_keys(recent, history, key, meta, **options), "moved")
    gone = moved.select(*[ref(PREVIOUS + name).alias(name) for name in keys], F.lit("missing").alias("event"))
    stayed = events.join(gone, [*keys, "event"], "left_anti")
    came = moved.withColumn("_moved", F.lit(True))
    return stayed.join(came, keys, "left").select(
        *refs(keys),
        F.when(F.col("_moved"), F.lit("moved")).otherwise(F.col("event")).alias("event"),
        *refs([PREVIOUS + name for name in keys]),
    )


def _written(rows: DataFrame, label: str) -> DataFrame:
    path = new_folder(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``_place``, the number of the row in the whole sort. What is collected is one number
    per task of the sort."""
    place = F.monotonically_increasing_id()
    placed = _written(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place), "sorted"
    )
    task = F.shiftright("_place", 33)
    counts = sorted((r[0], r[1]) for r in placed.groupBy(task).count().collect())
    starts, before = [], 0
    for number, count in counts:
        starts.append((number, before))
        before += count
    offsets = rows.sparkSession.createDataFrame(starts, "_task long, _start long")
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_task", task)
        .join(F.broadcast(offsets), "_task")  # one row per task
        .withColumn("_place", F.col("_start") + inside)
        .drop("_task", "_start")
    )
