"""Catalog tables bucketed by key, for diffs that need no shuffle of the history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from snaptrack.meta import KeySpec, key_list, ref, refs


# A task of a run holds some five times that: both sides with their stamps, sorted, and what it writes.
BUCKET_BYTES = 64 * 1024 * 1024


def row_bytes(schema: T.StructType) -> Column:
    """What a row takes where it is sorted: null bits, a word a column and what varies in length.

    Files are no measure of that, as columns that compress well are a tenth of it there.
    """
    varying = []
    for field in schema:
        if isinstance(field.dataType, (T.StringType, T.CharType, T.VarcharType, T.BinaryType)):
            varying.append(F.octet_length(ref(field.name)))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            varying.append(F.octet_length(F.to_json(F.struct(ref(field.name)))))
    size = F.lit(8 * (len(schema) + -(-len(schema) // 64))).cast("long")
    for length in varying:
        size += F.coalesce(F.ceil(length / 8) * 8, F.lit(0))
    return size


def buckets_for(df: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """How many buckets of about ``bucket_bytes`` in memory the rows fill.

    A task of a join sorts a bucket of either side, so its memory follows this size and not that
    of the table. It is added up over the rows, of which only columns that vary in length are read.
    """
    size = df.select(F.sum(row_bytes(df.schema)).alias("size")).first()["size"] or 0
    return max(1, -(-size // bucket_bytes))


def write_bucketed(
    df: DataFrame,
    name: str,
    key: KeySpec,
    buckets: int,
    path: str | None = None,
    colocated: bool = False,
) -> None:
    """Save ``df`` as table ``name``, bucketed and sorted by ``key``.

    For snapshots and active rows, which have one row per key. Closed rows stay out: a key with
    very many versions would make one bucket, and so one task, as large as they are.

    A join on the key then reads the table without an exchange; two such tables with the same
    number of buckets join without any. Rows are shuffled once so that each bucket is one
    file. ``colocated=True`` skips that for rows that come out of such a join and are in
    their buckets already.
    """
    keys = key_list(key)
    rows = df if colocated else df.repartition(buckets, *refs(keys))
    writer = rows.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
