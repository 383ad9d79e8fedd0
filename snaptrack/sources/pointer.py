"""A Parquet table that is replaced as a whole, whoever reads it meanwhile.

Each replacement writes a folder of its own and then one small file that points to it. The newest
pointer counts. A pointer is a new file and no old one is touched, so this needs no rename and
holds on any store: a reader finds the old rows or the new ones, and a job that dies before its
pointer is written has changed nothing. Old folders stay until ``free_replaced``.

Both folders have names that plain readers skip: they find an empty table, never a mixture.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

DATA, POINTERS = "_data", "_pointers"
SCHEMA = "sequence int, written_at timestamp, folder string"


def _below(path: str, *names: str) -> str:
    return "/".join([path.rstrip("/"), *names])


def _pointers(spark: SparkSession, path: str) -> list[Row]:
    """All pointers, oldest first: one small row per replacement that was not freed."""
    try:
        found = spark.read.schema(SCHEMA).parquet(_below(path, POINTERS)).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(found, key=lambda row: (row.sequence, row.written_at, row.folder))


def current_folder(spark: SparkSession, path: str) -> str | None:
    """The folder with the table's rows, or none if the table is one of plain files."""
    found = _pointers(spark, path)
    return _below(path, DATA, found[-1].folder) if found else None


def replace_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Make ``df`` the content of the table; its rows may come from the table itself."""
    spark, folder = df.sparkSession, uuid.uuid4().hex
    df.write.partitionBy(*partition_by).parquet(_below(path, DATA, folder))
    found = _pointers(spark, path)
    pointer = spark.range(1, numPartitions=1).select(
        F.lit(found[-1].sequence + 1 if found else 1).alias("sequence"),
        F.current_timestamp().alias("written_at"),
        F.lit(folder).alias("folder"),
    )
    pointer.write.mode("append").parquet(_below(path, POINTERS))


def free_replaced(
    spark: SparkSession, path: str, keep: int = 2, older_than: dt.timedelta = dt.timedelta(days=1)
) -> list[str]:
    """Empty the folders that are not among the newest ``keep``, and those without a pointer that a
    failed job has left; names them. Readers that began before ``older_than`` must have ended.

    Only folders whose files are all older than that are emptied, so a job that is writing is safe.
    Files are listed by Spark and not read.
    """
    if keep < 1:
        raise ValueError("the current rows cannot be freed")
    kept = {row.folder for row in _pointers(spark, path)[-keep:]}
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        files = reader.load(_below(path, DATA))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    folder = F.regexp_extract("path", f"/{DATA}/([0-9a-f]{{32}})/", 1)
    before = F.current_timestamp() - F.lit(older_than)
    known = files.select(folder.alias("folder"), "modificationTime", "length").groupBy("folder").agg(
        F.max("modificationTime").alias("newest"), F.max("length").alias("largest")
    )
    old = known.filter((F.col("newest") < before) & F.col("folder").isin(list(kept)).eqNullSafe(False))
    freed = sorted(row.folder for row in old.select("folder").collect())  # one row per replacement
    for name in freed:
        spark.range(0).write.mode("overwrite").parquet(_below(path, DATA, name))
    return freed
