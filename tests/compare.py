"""Compare a Spark result with a DuckDB result, row for row."""

import datetime as dt
import math


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(" ")
    if isinstance(value, (list, tuple)):
        return tuple(plain(item) for item in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, df.collect())


def duck_rows(connection, sql):
    cursor = connection.execute(sql)
    columns = [item[0] for item in cursor.description]
    return sorted(columns), rows_of(columns, cursor.fetchall())
