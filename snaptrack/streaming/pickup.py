"""Pick up snapshots as they land and add them to a history."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

from snaptrack.meta import KeySpec, as_day, date_of, ref
from snaptrack.plans.replay import apply_snapshot
from snaptrack.sources.files import table_path
from snaptrack.sources.history_table import HistoryTable

APPLIED = "day date, rows long, files int"


def land_files(
    spark: SparkSession,
    landing: str,
    schema: T.StructType | str,
    date_column: str,
    landed: str,
    format: str = "parquet",
) -> None:
    """Stream files that are new in ``landing`` into Parquet partitioned by snapshot date.

    The checkpoint makes each file count once, also when the job is started again. The query
    ends when all files present at its start are read.
    """
    files = spark.readStream.format(format).schema(schema)
    if format == "csv":
        files = files.options(header=True, enforceSchema=False)
    if format in ("csv", "json"):
        files = files.option("mode", "FAILFAST")
    query = (
        files.load(landing)
        .withColumn(date_column, ref(date_column).cast("date"))
        .writeStream.format("parquet")
        .partitionBy(date_column)
        .option("path", table_path(landed, "rows"))
        .option("checkpointLocation", table_path(landed, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_history(
    spark: SparkSession,
    landing: str,
    schema: T.StructType | str,
    date_column: str,
    landed: str | None,
    table: HistoryTable,
    key: KeySpec,
    format: str = "parquet",
    missing: str = "keep",
    *,
    complete_until: dt.date | str,
    **options,
) -> DataFrame:
    """Land new files, then apply each snapshot date newer than the last run, oldest first.

    A snapshot may arrive in parts, so only dates up to ``complete_until`` are applied; the
    caller says which snapshots are whole, later dates wait. Rows without a date, and rows that
    land for a date already applied, are an error: a part left out would close its keys.

    ``table`` holds its first history already. With ``landed=None`` the landing folder is
    partitioned by ``date_column`` already and is read where it is, without a copy; rows that
    land late are then not noticed.
    """
    runs = table.runs(spark)
    if not runs:
        raise ValueError(f"{table.root} has no state yet; write a first history")
    if landed is None:
        rows = spark.read.schema(schema).format(format).load(landing)
        rows = rows.withColumn(date_column, ref(date_column).cast("date"))
        files, applied = {}, {}
    else:
        land_files(spark, landing, schema, date_column, landed, format)
        rows = _landed_rows(spark, schema, date_column, landed)
        if rows is None:
            return table.read(spark)
        files, applied = _files_per_day(rows, date_column), _applied(spark, landed)
    late = sorted(str(day) for day, (_, n) in applied.items() if n is not None and files[str(day)] != n)
    if late:
        raise ValueError(f"rows landed for dates that are applied already: {late}")
    # Files of days before the last run are listed and not opened; a day that was applied by an
    # older version is counted once more, as its files were not noted.
    counted = ref(date_column).isNull() | (ref(date_column) > date_of(runs[-1]))
    unknown = [date_of(day) for day, (_, n) in applied.items() if n is None]
    if unknown:
        counted |= ref(date_column).isin(unknown)
    # One row per snapshot: the calendar bounds it.
    counts = {row[0]: row[1] for row in rows.filter(counted).groupBy(ref(date_column)).count().collect()}
    if None in counts:
        raise ValueError(f"{counts[None]} landed rows have no {date_column}")
    late = sorted(str(day) for day, (n, known) in applied.items() if known is None and counts.get(day, n) != n)
    if late:
        raise ValueError(f"rows landed for dates that are applied already: {late}")
    for day in sorted(counts):
        if runs[-1] < day <= as_day(complete_until):
            recent = rows.filter(ref(date_column) == date_of(day)).drop(date_column)
            apply_snapshot(spark, table, day, recent, key, missing, **options)
            if landed:
                entry = spark.createDataFrame([(day, counts[day], files[str(day)])], APPLIED)
                entry.coalesce(1).write.mode("append").parquet(table_path(landed, "applied"))
    return table.read(spark)


def _landed_rows(
    spark: SparkSession, schema: T.StructType | str, date_column: str, landed: str
) -> DataFrame | None:
    """What has landed so far, with the schema the caller states: no file is opened to find it."""
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    dated = [T.StructField(f.name, T.DateType() if f.name == date_column else f.dataType) for f in fields]
    try:
        rows = spark.read.schema(T.StructType(dated)).parquet(table_path(landed, "rows"))
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return rows


def _files_per_day(rows: DataFrame, date_column: str) -> Counter[str]:
    """How many files each day has, by the names of their folders."""
    mark = f"{date_column}="
    folders = [part for path in rows.inputFiles() for part in path.split("/") if part.startswith(mark)]
    return Counter(unquote(folder.removeprefix(mark)) for folder in folders)


def _applied(spark: SparkSession, landed: str) -> dict[dt.date, tuple[int, int | None]]:
    """How many rows and files each applied snapshot had."""
    try:
        found = spark.read.schema(APPLIED).parquet(table_path(landed, "applied")).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {row["day"]: (row["rows"], row["files"]) for row in found}
