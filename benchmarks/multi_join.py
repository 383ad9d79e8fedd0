"""A textbook delta history as a yardstick: one full outer join, one union branch per event.

Values are compared column by column and the log is built-in JSON, so it computes what
``build_history(mode="delta")`` does. Each branch filters the join on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

import snaptrack as st


def build_history(recent: DataFrame, history: DataFrame, key: str, run_date: str) -> DataFrame:
    values = st.value_columns(recent, key)
    new = recent.select(key, F.struct(*values).alias("n"))
    old = st.active_rows(history).select(
        key, F.struct(*values).alias("o"), "valid_from", "valid_to"
    )
    pairs = new.join(old, key, "full_outer")
    inserts = pairs.filter("o is null").select(key, "n.*")
    edits = pairs.filter("n is not null and o is not null and not n <=> o")
    changed = [
        F.when(
            ~F.col(f"n.{name}").eqNullSafe(F.col(f"o.{name}")),
            F.array(F.col(f"n.{name}").cast("string"), F.col(f"o.{name}").cast("string")),
        ).alias(name)
        for name in values
    ]
    closed = edits.select(
        key, "o.*", "valid_from", "valid_to", F.to_json(F.struct(*changed)).alias("changes")
    )
    return st.union_all(
        [
            st.closed_rows(history),
            st.close_rows(closed, run_date),
            st.open_rows(edits.select(key, "n.*"), run_date),
            st.open_rows(inserts, run_date),
        ]
    )
