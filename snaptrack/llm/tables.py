"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from snaptrack.sources.workspace import new_folder

RANK_BUCKETS = 4096
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back: later steps never recompute it.

    The files of its shuffles go as soon as it is written, not when the driver happens to collect
    garbage: nothing reads them again.
    """
    spark = df.sparkSession
    path, before = new_folder(spark, label), spark.conf.get(FREED, "false")
    spark.conf.set(FREED, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FREED, before)
    return spark.read.schema(df.schema).parquet(path)


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that later filters and projections read and never compute again.

    The optimizer copies a plain column's expression into every filter above it; the output of a
    generator it leaves where it is.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def first_ids(docs: DataFrame, count: int) -> DataFrame:
    """The first ``count`` ids in the order of a hash.

    Where there are many more, only hashes low enough to be among the first leave the scan, so
    that the one task which orders them reads a few times ``count`` rows at any size.
    """
    ids, place = docs.select("doc_id"), F.xxhash64("doc_id")
    rows = ids.count()
    if rows > 4 * count:
        low = ids.filter(place < -(1 << 63) + (1 << 64) * 4 * count // rows)
        if low.limit(count).count() == count:
            ids = low
    return ids.orderBy(place, "doc_id").limit(count)


def lowest(rows: DataFrame, key: str, count: int) -> DataFrame:
    """The first ``count`` rows in the order of a hash of ``key``, a unique number; see ``first_ids``."""
    place, total = F.xxhash64(key), rows.count()
    if total > 4 * count:
        low = rows.filter(place < -(1 << 63) + (1 << 64) * 4 * count // total)
        if low.limit(count).count() == count:
            rows = low
    return rows.orderBy(place, key).limit(count)


def told_apart(docs: DataFrame, name: str) -> DataFrame:
    """Adds a long that tells apart the rows of one ``doc_id``, null too.

    It is a hash of the text. Rows that agree in id and text are rare; where there are any, the
    rows are written once with their running numbers instead. Both stay the same however often
    the frame is read.
    """
    marked = docs.withColumn(name, F.xxhash64("text"))
    if not marked.groupBy("doc_id", name).count().filter("count > 1").limit(1).count():
        return marked
    return stored(docs.withColumn(name, F.monotonically_increasing_id()), "rows")


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` as an array; null text has none."""
    spaced = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.array_remove(F.split(spaced, " "), "")


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def has_word(line: Column) -> Column:
    return F.trim(F.translate(line, "\t\n\x0b\x0c\r", "     ")) != ""


def ranked(
    df: DataFrame, name: str, by: Sequence[str], order: Sequence[str], weight: str | None = None
) -> DataFrame:
    """Adds ``name``: the position of a row among the rows with equal ``by``, from 0.

    ``by`` has few values, each of which may hold most of the rows. Rows are ordered by a hash
    bucket of ``order``, then by ``order``; each bucket is numbered on its own and shifted by the
    rows of the buckets before it. The shifts are ``RANK_BUCKETS`` rows per value of ``by``
    whatever the size of the input. With ``weight`` the position counts that column's units.
    ``order`` must identify the rows, or ties are numbered in any order.
    """
    keys = list(by)
    bucket = F.pmod(F.xxhash64(*order), F.lit(RANK_BUCKETS)).cast("int")
    rows = df.withColumn("_bucket", bucket)
    one = F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")
    sizes = rows.groupBy(*keys, "_bucket").agg(F.sum(one).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shifts = sizes.select(
        *[F.col(key).alias(f"_k{i}") for i, key in enumerate(keys)],
        F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"),
    )
    own = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    within = F.coalesce(F.sum(one).over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    match = F.col("_bucket") == F.col("_b")
    for i, key in enumerate(keys):
        match &= F.col(key).eqNullSafe(F.col(f"_k{i}"))
    joined = rows.withColumn("_within", within).join(shifts, match)
    return joined.withColumn(name, F.col("_shift") + F.col("_within")).drop(
        "_bucket", "_b", "_shift", "_within", *[f"_k{i}" for i in range(len(keys))]
    )
