"""Readers, the Parquet sink and store settings. Paths are any Hadoop path."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from snaptrack.meta import ref
from snaptrack.sources.pointer import current_folder

Schema = T.StructType | str


def table_path(root: str, name: str) -> str:
    """Path of a table: ``s3a://bucket`` and ``orders`` give ``s3a://bucket/orders``."""
    return f"{root.rstrip('/')}/{name.lstrip('/')}"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: Schema | None = None,
    multi_line: bool = False,
    **options: str,
) -> DataFrame:
    """CSV with a header row. Without a schema Spark reads the files once more to infer it.

    A cell that does not parse fails the query, and so does a header that names other columns
    than the schema: either would be taken for an edit by the next diff. ``rejected_rows`` lists
    such rows. Values with line breaks need ``multi_line``; files are then not split, so a task
    reads a whole file. ``options`` are those of Spark's reader.
    """
    reader = spark.read.options(header=True, mode="FAILFAST", multiLine=multi_line)
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.options(**options).csv(path)


def read_json(
    spark: SparkSession, path: str, schema: Schema | None = None, **options: str
) -> DataFrame:
    """One JSON object per line; a line that does not parse fails the query."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("mode", "FAILFAST").options(**options).json(path)


def rejected_rows(
    spark: SparkSession,
    path: str,
    schema: Schema,
    format: str = "csv",
    multi_line: bool = False,
    name: str = "rejected",
) -> DataFrame:
    """The CSV or JSON rows that do not parse with ``schema``: the cells that do, and as column
    ``name`` the raw text. Spark refuses a select of the raw text alone."""
    parsed = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = spark.read.schema(T.StructType([*parsed.fields, T.StructField(name, T.StringType())]))
    reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=name, multiLine=multi_line)
    rows = reader.option("header", True).csv(path) if format == "csv" else reader.json(path)
    return rows.filter(ref(name).isNotNull())


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table: plain files, or the folder that the table's newest pointer names."""
    current = current_folder(spark, path)
    return spark.read.parquet(current or path)


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Write ``df`` to ``path``, replacing what is there.

    An overwrite goes to a new folder beside the target and takes its place when it is whole, so
    the rows may come from the target itself and a job that fails leaves the target as it was.
    The exchange is a delete and a rename, which stores without renames carry out as a copy; who
    reads meanwhile may find nothing. ``replace_parquet`` has no such moment.
    """
    if mode != "overwrite":
        df.write.mode(mode).partitionBy(*partition_by).parquet(path)
        return
    spark = df.sparkSession
    fresh = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(fresh)
    paths = spark._jvm.org.apache.hadoop.fs.Path
    target, source = paths(path), paths(fresh)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(target, True)
    if not files.rename(source, target):
        raise OSError(f"{fresh} holds the rows; it could not be renamed to {path}")
    spark.catalog.refreshByPath(path)


def s3a_conf(
    endpoint: str, access_key: str | None = None, secret_key: str | None = None, ssl: bool = False
) -> dict[str, str]:
    """Settings for an S3-compatible store, for ``SparkSession.builder.config(map=...)``.

    Leave the keys out to use the cluster's own credential provider.
    """
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }
    if access_key is not None and secret_key is not None:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    return conf


def ingest(
    spark: SparkSession,
    tables: Mapping[str, str],
    root: str,
    schema: Schema | None = None,
    format: str = "csv",
    **options,
) -> dict[str, str]:
    """Seed Parquet tables from raw files: ``{name: source path}`` to ``root/name``.

    ``options`` go to the reader. Returns ``{name: written path}``.
    """
    readers = {"csv": read_csv, "json": read_json}
    if format not in readers:
        raise ValueError(f"format must be one of {sorted(readers)}")
    written = {}
    for name, source in tables.items():
        written[name] = table_path(root, name)
        write_parquet(readers[format](spark, source, schema, **options), written[name])
    return written
