"""A history kept as Parquet, one directory per run."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Collection, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from snaptrack.meta import (
    DEFAULT_META,
    KeySpec,
    MetaColumns,
    as_day,
    date_of,
    key_list,
    ref,
    refs,
)
from snaptrack.operators.reads import as_of
from snaptrack.sources.files import table_path
from snaptrack.sources.run_log import ATTEMPT, DROPPED, FINISHED, LEFT_OUT, RUN, RunLog, StaleRun


PART = "part"


@dataclass(frozen=True)
class HistoryTable:
    """Layout ``root/rows/run_date=D/attempt=A/<active>=true|false`` plus a log of runs.

    A run writes the rows that are active after it and the rows it closed. Rows closed by
    earlier runs stay where they are and are never rewritten, so a daily run does not copy
    the whole past. The state after run D is the active rows of run D and the closed rows of
    all runs up to D; partition pruning reads those directories and no others.

    Every write goes to an attempt folder of its own and counts once the log names that folder,
    so rows may come from the run they replace, and what a write that died has left is never
    read. The folder that a repeated date replaces stays on disk unread.

    An entry also names the attempt it was built on, and a state is read along that chain. A run
    that was built on a state which is no longer the newest before its date is refused
    (``StaleRun``). Two jobs that pass that check at the same moment are found when they look
    again after their entries: the chain holds one, ``run_log`` names the other.

    With ``key`` and ``buckets`` every run is stored in that many buckets of the key. The next run
    then reads the active rows in their buckets and shuffles its snapshot alone. Take as many
    buckets as shuffle partitions or more, or Spark may prefer to shuffle both sides. The buckets
    are described to the session's own catalog for the time of a run; no metastore is needed.

    With ``key`` and ``parts`` the rows of a run lie in that many folders by a hash of the key. A run
    on a partial snapshot (``apply_changes``) then reads and writes the parts that its keys fall into;
    the other parts of the active rows stay where earlier runs have written them, and the log names
    who holds them. Shuffle partitions in a multiple of ``parts`` give one file a task.
    """

    root: str
    meta: MetaColumns = DEFAULT_META
    key: KeySpec | None = None
    buckets: int | None = None
    parts: int | None = None

    def __post_init__(self) -> None:
        if self.parts is not None and (self.key is None or self.buckets is not None):
            raise ValueError("parts need a key, and cannot be combined with buckets")

    def log(self, spark: SparkSession) -> RunLog:
        return RunLog.read(spark, self._log_path())

    def runs(self, spark: SparkSession) -> list[dt.date]:
        """Dates of the runs that the newest state is made of, oldest first."""
        return [entry[RUN] for entry in self.log(spark).chain()]

    def run_log(self, spark: SparkSession) -> DataFrame:
        """``run_date, attempt, base_date, status`` of every attempt, see ``RunLog.statuses``."""
        schema = f"{RUN} date, {ATTEMPT} string, base_date date, status string"
        return spark.createDataFrame(self.log(spark).statuses(), schema)

    def base(
        self, spark: SparkSession, run_date: dt.date | str, log: RunLog | None = None
    ) -> Row | None:
        """The run that one of ``run_date`` builds on; ``log`` spares reading it again."""
        chain = (log or self.log(spark)).chain()
        earlier = [e for e in chain if e[RUN] < as_day(run_date)]
        return earlier[-1] if earlier else None

    def write(
        self,
        rows: DataFrame,
        run_date: dt.date | str,
        checked: bool = False,
        base: Row | None = None,
        missing: str | None = None,
        touched: Collection[int] | None = None,
    ) -> None:
        """Store the rows of a run and enter it in the log.

        ``checked`` says that the rows hold one active version per key, as those of ``run_rows``
        do; a run on top of others checks the keys again. ``base`` is the entry of the state that
        the rows were built on, by default the newest before the date; ``missing`` is what was
        done with rows that the snapshot lacked, which a later correction must know. ``touched`` are
        the only parts that the rows are of; the base keeps the others.
        """
        spark, day = rows.sparkSession, as_day(run_date)
        base = base or self.base(spark, day)
        attempt = self.store(rows, day, checked)
        log = self.log(spark)
        self._refuse_stale(spark, day, base, log)
        held = None
        if touched is not None and base is not None:
            holders = log.holders(base)
            held = {part: holder for part, holder in holders.items() if part not in touched}
        self.enter(spark, day, attempt, rows, checked, base, missing, held=held, log=log)
        self._find_overlap(spark, day, attempt, base)

    def store(self, rows: DataFrame, day: dt.date, checked: bool) -> str:
        """Write rows to a new attempt of a run, which no state reads before it is entered."""
        taken = [name for name in rows.columns if name.lower() in (RUN, ATTEMPT, PART)]
        if taken:
            raise ValueError(f"columns {taken} are named like the table's folders; rename them")
        if self.meta.active not in rows.columns:
            raise ValueError(f"rows have no column {self.meta.active!r}; see ensure_history")
        spark, attempt = rows.sparkSession, uuid.uuid4().hex
        folder = self._folder(day, attempt)
        # Unchecked rows may hold very many versions of a key, too many for one bucket.
        buckets = self._buckets(checked)
        if self.parts is not None:
            placed = rows.withColumn(PART, self.part_of())
            placed.write.partitionBy(self.meta.active, PART).parquet(folder)
        elif buckets is None:
            rows.write.partitionBy(self.meta.active).parquet(folder)
        else:
            name, keys = f"snaptrack_{attempt}", key_list(self.key)
            writer = rows.write.partitionBy(self.meta.active).option("path", folder)
            writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
            spark.sql(f"drop table {name}")  # the files stay
        return attempt

    def enter(
        self,
        spark: SparkSession,
        day: dt.date,
        attempt: str,
        rows: DataFrame,
        checked: bool,
        base: Row | None,
        missing: str | None,
        state: str = FINISHED,
        held: dict[int, tuple[dt.date, str]] | None = None,
        log: RunLog | None = None,
    ) -> None:
        """Enter a stored attempt in the log, from which moment on it counts. ``held`` are the parts
        of the active rows that other attempts hold."""
        (log or self.log(spark)).write(
            spark,
            self._log_path(),
            run_date=day,
            attempt=attempt,
            state=state,
            columns=rows.schema.json(),
            checked=checked,
            buckets=self._buckets(checked),
            base_date=base and base[RUN],
            base_attempt=base and base[ATTEMPT],
            missing=missing,
            parts=self.parts,
            held=json.dumps({part: (str(d), a) for part, (d, a) in held.items()}) if held else None,
        )

    def part_of(self) -> Column:
        """The part that a row belongs to."""
        return F.pmod(F.hash(*refs(key_list(self.key))), F.lit(self.parts)).cast("int")

    def _buckets(self, checked: bool) -> int | None:
        return self.buckets if checked else None

    def _refuse_stale(
        self, spark: SparkSession, day: dt.date, base: Row | None, log: RunLog
    ) -> None:
        """What was stored is entered only if its base is still the newest state before it."""
        now = self.base(spark, day, log)
        if (now and now[ATTEMPT]) != (base and base[ATTEMPT]):
            raise StaleRun(
                f"the run of {day} was built on {_name(base)}, but the newest run before it is "
                f"now {_name(now)}; run it again"
            )
        newest = log.head()
        if newest is not None and newest[RUN] > day:
            raise StaleRun(f"a run of {newest[RUN]} was finished before that of {day}")

    def _find_overlap(
        self, spark: SparkSession, day: dt.date, attempt: str, base: Row | None
    ) -> None:
        """Two jobs may have passed ``_refuse_stale`` at once; the log now shows both."""
        log = self.log(spark)
        if all((e[RUN], e[ATTEMPT]) != (day, attempt) for e in log.chain()):
            raise StaleRun(f"the run of {day} was overtaken by another; see run_log")
        since = base[RUN] if base else None
        missed = [
            str(date)
            for date, _, _, status in log.statuses()
            if status == LEFT_OUT and date < day and (since is None or date > since)
        ]
        if missed:
            raise StaleRun(f"runs of {missed} overlapped that of {day} and are left out")

    @contextmanager
    def active_rows(
        self, spark: SparkSession, run_date: dt.date, log: RunLog | None = None
    ) -> Iterator[DataFrame]:
        """The active rows of a run, in their buckets if it was stored so."""
        log = log or self.log(spark)
        entry = log.chain(run_date)[-1]
        if entry.buckets is None or self.key is None:
            yield self._state(spark, run_date, log=log)
            return
        stored = T.StructType([f for f in _schema(entry) if f.name != self.meta.active])
        ddl = stored.toDDL()
        name = f"snaptrack_{entry.attempt}_{uuid.uuid4().hex[:8]}"
        keys = ", ".join(refs(key_list(self.key)))
        path = f"{self._folder(run_date, entry.attempt)}/{self.meta.active}=true"
        spark.sql(
            f"create table {name} ({ddl}) using parquet clustered by ({keys}) sorted by ({keys}) "
            f"into {entry.buckets} buckets location '{path}'"
        )
        try:
            rows = spark.table(name).withColumn(self.meta.active, F.lit(True))
            yield rows.select(*refs(_schema(entry).names))
        finally:
            spark.sql(f"drop table {name}")

    def _folder(self, day: dt.date, attempt: str) -> str:
        return table_path(self.root, f"rows/{RUN}={day}/{ATTEMPT}={attempt}")

    def _log_path(self) -> str:
        return table_path(self.root, "runs")

    def read(self, spark: SparkSession, run_date: dt.date | str | None = None) -> DataFrame:
        """The history after ``run_date``, or after the newest run."""
        return self._state(spark, run_date)

    def as_of(self, spark: SparkSession, day: dt.date | str) -> DataFrame:
        """The table as it was on ``day``.

        A version closed by run D was valid until D at most, so the directories of closed
        rows up to ``day`` are skipped.
        """
        return as_of(self._state(spark, closed_after=day), day, self.meta)

    def open_after(self, spark: SparkSession, day: dt.date | str) -> DataFrame:
        """Versions that were still valid after ``day``, those of later runs included."""
        return self._state(spark, closed_after=day)

    def drop_superseded(self, spark: SparkSession, keep: int = 2) -> None:
        """Free the active rows of all but the newest ``keep`` runs.

        Each run stores a whole set of active rows and only the newest is part of the state;
        the one before it is needed to run the newest date again. Closed rows stay, so
        ``as_of`` still reaches every date.
        """
        if keep < 1:
            raise ValueError("the newest run cannot be dropped")
        log = self.log(spark)
        whole = [entry for entry in log.chain() if entry.state == FINISHED]
        # A run that holds parts of a kept one keeps its rows.
        needed = {holder for entry in whole[-keep:] for holder in log.holders(entry).values()}
        for entry in whole[:-keep]:
            if (entry[RUN], entry[ATTEMPT]) in needed:
                continue
            # First the log: a run whose rows are going must not be read any more.
            values = entry.asDict() | {"state": DROPPED}
            self.log(spark).write(spark, self._log_path(), **values)
            nothing = spark.createDataFrame([], _schema(entry)).drop(self.meta.active)
            path = f"{self._folder(entry[RUN], entry[ATTEMPT])}/{self.meta.active}=true"
            for part in range(entry.parts or 0):
                nothing.write.mode("overwrite").parquet(f"{path}/{PART}={part}")
            if not entry.parts:
                nothing.write.mode("overwrite").parquet(path)

    def _state(
        self,
        spark: SparkSession,
        run_date: dt.date | str | None = None,
        closed_after: dt.date | str | None = None,
        log: RunLog | None = None,
    ) -> DataFrame:
        """The rows of a state, with the columns of its newest run."""
        rows = self._placed(spark, run_date, closed_after, log)
        return rows.drop(RUN, ATTEMPT, PART)

    def parts_of(self, spark: SparkSession, entry: Row, parts: Collection[int]) -> DataFrame:
        """The active rows of some parts of a run; no other folder is read."""
        rows = self._placed(spark, entry[RUN]).filter(ref(self.meta.active) & F.col(PART).isin(*parts))
        return rows.drop(RUN, ATTEMPT, PART)

    def _placed(
        self,
        spark: SparkSession,
        run_date: dt.date | str | None = None,
        closed_after: dt.date | str | None = None,
        log: RunLog | None = None,
    ) -> DataFrame:
        log = log or self.log(spark)
        chain = log.chain(as_day(run_date) if run_date is not None else None)
        if not chain:
            raise ValueError(f"{self.root} has no finished run up to {run_date or 'now'}")
        newest = chain[-1]
        if newest.state == DROPPED:
            raise ValueError(f"the active rows of run {newest[RUN]} were dropped; use as_of")
        columns = _schema(newest)
        # The schema comes from the log: no footer is read to find it.
        folders = [T.StructField(RUN, T.DateType()), T.StructField(ATTEMPT, T.StringType())]
        closing = [
            entry for entry in chain if closed_after is None or entry[RUN] > as_day(closed_after)
        ]
        current = (newest[RUN], newest[ATTEMPT])
        holders: dict[tuple[dt.date, str], list[int]] = {current: []}
        for part, holder in log.holders(newest).items():
            holders.setdefault(holder, []).append(part)
        if newest.parts:
            folders.append(T.StructField(PART, T.IntegerType()))
        # One folder per run that matters, and no other is listed.
        used = dict.fromkeys([*((entry[RUN], entry[ATTEMPT]) for entry in closing), *holders])
        reader = spark.read.schema(T.StructType([*columns.fields, *folders]))
        rows = reader.option("basePath", table_path(self.root, "rows")).parquet(
            *[self._folder(*attempt) for attempt in used]
        )
        active = F.coalesce(ref(self.meta.active), F.lit(False))
        state = ~active & F.col(RUN).isin([date_of(entry[RUN]) for entry in closing])
        for (day, _), parts in holders.items():
            own = F.col(RUN) == date_of(day)
            state |= active & (own & F.col(PART).isin(parts) if newest.parts else own)
        return rows.filter(state).select(*refs(columns.names), *[field.name for field in folders])


def _name(entry: Row | None) -> str:
    return f"that of {entry[RUN]} (attempt {entry[ATTEMPT][:8]})" if entry else "nothing"


def _schema(entry: Row) -> T.StructType:
    return T.StructType.fromJson(json.loads(entry.columns))
