"""Names of the columns a history table carries next to its own data."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

KeySpec = str | Sequence[str]


@dataclass(frozen=True)
class MetaColumns:
    """Column names of the version model.

    ``active``   boolean, true for the current version of a key
    ``created``  date the version became valid
    ``edited``   date the version stopped being valid, null while it is current
    ``changes``  JSON text ``{"column": ["new", "old"]}`` on versions closed by an edit
    """

    active: str = "is_active"
    created: str = "valid_from"
    edited: str = "valid_to"
    changes: str = "changes"

    @property
    def names(self) -> tuple[str, str, str, str]:
        return (self.active, self.created, self.edited, self.changes)


DEFAULT_META = MetaColumns()


def key_list(key: KeySpec) -> list[str]:
    names = [key] if isinstance(key, str) else list(key)
    if not names:
        raise ValueError("a key needs at least one column")
    return names


def quoted(name: str) -> str:
    """The name as SQL text; also right for names holding dots or blanks."""
    return "`" + name.replace("`", "``") + "`"


def ref(name: str) -> Column:
    return F.col(quoted(name))


def refs(names: Iterable[str]) -> list[str]:
    """Column references for select, groupBy and the like."""
    return [quoted(name) for name in names]


def spelled_as(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Rename columns that differ from ``names`` in case only, unless case counts."""
    if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true":
        return df
    wanted = {name.lower(): name for name in names}
    renamed = {c: wanted[c.lower()] for c in df.columns if wanted.get(c.lower(), c) != c}
    return df.withColumnsRenamed(renamed) if renamed else df


def as_day(value: dt.date | str) -> dt.date:
    """A date from a date, a point in time or ISO text of either."""
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.datetime.fromisoformat(value).date()


def date_text(day: dt.date | str | None) -> str:
    """A date literal as SQL; the wall-clock date only when no date is given."""
    return "current_date()" if day is None else f"date '{as_day(day)}'"


def date_of(day: dt.date | str | None) -> Column:
    return F.expr(date_text(day))
