"""The log of runs of a stored history, and the chain of runs that a state is made of."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Row, SparkSession, functions as F

from snaptrack.meta import date_of

RUN, ATTEMPT = "run_date", "attempt"
LOG_SCHEMA = (
    f"{RUN} date, written_at timestamp, state string, columns string, {ATTEMPT} string, "
    "checked boolean, buckets int, sequence int, linked boolean, base_date date, "
    "base_attempt string, missing string, parts int, held string"
)
FINISHED, DROPPED = "finished", "dropped"
CURRENT, REPLACED, LEFT_OUT = "current", "replaced", "left_out"


class StaleRun(RuntimeError):
    """Another run was written between reading a state and storing what was built on it."""


@dataclass(frozen=True)
class RunLog:
    """Entries in the order in which they were made: a few small rows per run.

    An entry names the attempt it was built on. The newest attempt of the newest date is the head;
    the entries that it leads back to are its chain, and a state is made of the rows of one chain
    and of no other attempt. So two runs that have overlapped never close a version twice: the
    chain holds one of them, and the other is known to be left out.
    """

    entries: tuple[Row, ...]

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> RunLog:
        try:
            rows = spark.read.schema(LOG_SCHEMA).parquet(path).collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []
        # The clock decides between entries of equal number only: those of jobs that overlapped.
        return cls(tuple(sorted(rows, key=lambda e: (e.sequence or 0, e.written_at, e.attempt))))

    def write(self, spark: SparkSession, path: str, **entry) -> None:
        """Append an entry behind those that this log holds."""
        values = dict.fromkeys(("base_date", "base_attempt", "missing", "buckets", "parts", "held"))
        values |= {"state": FINISHED, "checked": False, "linked": True, **entry}
        values["sequence"] = 1 + max((e.sequence or 0 for e in self.entries), default=0)
        columns = []
        for field in spark.createDataFrame([], LOG_SCHEMA).schema:
            if field.name == "written_at":
                value = F.current_timestamp()
            elif field.name in (RUN, "base_date") and values[field.name] is not None:
                value = date_of(values[field.name])
            else:
                value = F.lit(values[field.name])
            columns.append(value.cast(field.dataType).alias(field.name))
        spark.range(1, numPartitions=1).select(*columns).write.mode("append").parquet(path)

    def entry(self, day: dt.date, attempt: str) -> Row:
        """The newest entry of an attempt: it may have been dropped since it was finished."""
        return [e for e in self.entries if (e[RUN], e[ATTEMPT]) == (day, attempt)][-1]

    def head(self) -> Row | None:
        if not self.entries:
            return None
        newest = max(e[RUN] for e in self.entries)
        return self._newest_attempt(newest)

    def _newest_attempt(self, day: dt.date) -> Row:
        """The attempt of a date that was entered last; dropping one enters no new attempt."""
        first_seen = [e for e in self.entries if e[RUN] == day and e.state == FINISHED]
        return self.entry(day, first_seen[-1][ATTEMPT])

    def before(self, entry: Row) -> Row | None:
        """The entry that a run was built on."""
        if entry.linked:
            return self.entry(entry.base_date, entry.base_attempt) if entry.base_date else None
        # Entries of older versions name no base: it was the newest run before them.
        earlier = [e[RUN] for e in self.entries if e[RUN] < entry[RUN]]
        return self._newest_attempt(max(earlier)) if earlier else None

    def chain(self, upto: dt.date | None = None) -> list[Row]:
        """The runs that the newest state is made of, oldest first, up to a date."""
        entry, found = self.head(), []
        while entry is not None:
            found.append(entry)
            entry = self.before(entry)
        return [e for e in reversed(found) if upto is None or e[RUN] <= upto]

    def holders(self, entry: Row) -> dict[int, tuple[dt.date, str]]:
        """The attempt that holds each part of the active rows of a run stored in parts."""
        own = (entry[RUN], entry[ATTEMPT])
        held = {int(k): (dt.date.fromisoformat(d), a) for k, (d, a) in json.loads(entry.held or "{}").items()}
        return {part: held.get(part, own) for part in range(entry.parts or 0)}

    def statuses(self) -> list[tuple[dt.date, str, dt.date | None, str]]:
        """``(date, attempt, base date, status)`` of every attempt: ``current`` ones make up the
        state, ``replaced`` ones gave way to another attempt of their date, and ``left_out`` ones
        are of a date that the state knows nothing of."""
        chain = {(e[RUN], e[ATTEMPT]) for e in self.chain()}
        dates, out, seen = {day for day, _ in chain}, [], set()
        for e in self.entries:
            name = (e[RUN], e[ATTEMPT])
            if name not in seen:
                seen.add(name)
                status = CURRENT if name in chain else REPLACED if e[RUN] in dates else LEFT_OUT
                out.append((*name, e.base_date, status))
        return out
