"""Incremental runs: a batch moves through the layers as a change set of days and keys.

Every table is a series of snapshots. A table that holds events by day remembers which versions of its
inputs it was made from. On the next run the manifests of those inputs say which days have changed
since; windows and labels widen them, changed keys of a dimension add the days on which the keys occur.
Only these days are built again, from the slices of the inputs that they read, and published; the
other days keep their files. What a day's products say of the run itself (its clock, tenure to date)
stays what the run that built the day wrote.

A run that dies half-way leaves whole versions behind, and the next run starts from what the tables say
they were made from. Tables that are no events by day (dimensions, one row per entity) are built whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.context import RunContext
from tidemark.operators import quarantine
from tidemark.sources.bronze import DAMAGED
from tidemark.sources.snapshots import SnapshotTable

DAY = "_day"
LINEAGE = ("_batch_id", "_load_ts", "_source_file", "_source_system")
ALL = 36_500
Day = date | None


@dataclass(frozen=True)
class Reach:
    """An output day reads input days from ``back`` days before to ``ahead`` days after it."""

    back: int = 0
    ahead: int = 0


@dataclass(frozen=True)
class Calendar:
    """What a domain says of its tables that hold events by day."""

    #: The day of a row, as SQL.
    day: Mapping[str, str]
    #: Per table made from others: the tables it reads by day, the first one giving its rows.
    reads: Mapping[str, Mapping[str, Reach]] = field(default_factory=dict)
    #: Per table made from others: the tables it reads by key, and that key.
    keyed: Mapping[str, Mapping[str, str]] = field(default_factory=dict)


def dated(df: DataFrame, day: str) -> DataFrame:
    return df.withColumn(DAY, F.expr(f"try_cast({day} AS DATE)"))


def as_days(values: Iterable[str | None]) -> set[Day]:
    return {date.fromisoformat(v) if v else None for v in values}


def widened(days: Iterable[Day], reach: Reach) -> Callable[[Day], bool]:
    """Which output days a change on these input days can touch."""
    known = sorted(d for d in days if d is not None)
    none = None in set(days)
    runs: list[list[date]] = []
    for d in known:
        first = d - timedelta(min(reach.ahead, ALL))
        last = date.max if reach.back >= ALL else d + timedelta(reach.back)
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], last)
        else:
            runs.append([first, last])
    return lambda out: none if out is None else any(a <= out <= b for a, b in runs)


def days_in(table: SnapshotTable) -> set[Day]:
    """The days of the latest version, from its manifest."""
    if not table.latest():
        return set()
    return as_days(r.v for r in table.manifest().select(F.col("values")[DAY].alias("v")).distinct().collect())


def changed_days(table: SnapshotTable, before: int) -> set[Day]:
    gone, added = table.changed(before)
    both = gone.select("values").unionByName(added.select("values"))
    return as_days(r.v for r in both.select(F.col("values")[DAY].alias("v")).distinct().collect())


def changed_keys(table: SnapshotTable, before: int, key: str) -> DataFrame:
    """Keys whose rows differ between a version and the latest, lineage columns aside."""
    gone, added = (
        df.select(*[c for c in df.columns if c not in (*LINEAGE, DAY, "gold_created_ts")])
        for df in table.changed_rows(before)
    )
    return gone.exceptAll(added).unionByName(added.exceptAll(gone)).select(key).distinct()


def on_days(days: Iterable[Day], column: str = DAY) -> Column:
    """Rows on one of the days; consecutive days are one range."""
    known = sorted(d for d in days if d is not None)
    condition = F.col(column).isNull() if None in set(days) else F.lit(False)
    start = None
    for i, d in enumerate(known):
        start = start or d
        if i + 1 == len(known) or known[i + 1] - d > timedelta(1):
            condition = condition | F.col(column).between(F.lit(start), F.lit(d))
            start = None
    return condition


def read_days(days: Iterable[Day], reach: Reach, present: Iterable[Day]) -> set[Day]:
    """The input days that the output days read, of those present."""
    back, ahead = min(reach.back, ALL), min(reach.ahead, ALL)
    # An output day reads [day - back, day + ahead]: the same question with the sides exchanged.
    wanted = widened(days, Reach(ahead, back))
    return {d for d in present if wanted(d)}


class Lake:
    """The snapshot tables of a domain under one root."""

    def __init__(self, spark: SparkSession, root: str, calendar: Calendar):
        self.spark, self.root, self.calendar = spark, root.rstrip("/"), calendar
        #: Tables whose rows are held back until the parents they name are there.
        self.held: dict[str, list[quarantine.Parent]] = {}

    def table(self, name: str) -> SnapshotTable:
        layer = name.split("_")[0]
        return SnapshotTable(self.spark, f"{self.root}/{layer}/{name}")

    def read(self, name: str, days: Iterable[Day] | None = None) -> DataFrame:
        """A table as its plan wrote it, whole or for some days."""
        rows = self.table(name).read()
        if days is not None:
            rows = rows.filter(on_days(days))
        if name in self.held:
            rows = quarantine.screened(rows, {}, self.held[name])
            rows = rows.filter(F.size("reject_reasons") == 0).drop("reject_reasons")
        return rows.drop(DAY)

    def names(self, *layers: str) -> list[str]:
        files = SnapshotTable(self.spark, self.root).files
        return [n for layer in layers for n in files.names(f"{self.root}/{layer}") if self.table(n).latest()]

    def publish_batch(self, name: str, batch: DataFrame, run: RunContext, full: bool) -> None:
        """Add a batch to a bronze table; the same batch again replaces itself."""
        by = ["_batch_id"]
        if name in self.calendar.day:
            batch, by = dated(batch, self.calendar.day[name]), [DAY, "_batch_id"]
        again = None if full else F.col("values")["_batch_id"] == run.batch_id
        self.table(name).publish(batch, run, by, replace=again)

    def publish_whole(self, name: str, df: DataFrame, run: RunContext, inputs: Sequence[str] = ()) -> None:
        by: list[str] = []
        if name in self.calendar.day:
            df, by = dated(df, self.calendar.day[name]), [DAY]
        self.table(name).publish(df, run, by, inputs=self.versions(inputs))

    def versions(self, names: Iterable[str]) -> dict[str, int]:
        return {n: self.table(n).latest() for n in names}

    def touched(self, name: str, run: RunContext, extra: Iterable[Day] = ()) -> set[Day] | None:
        """The days of a table that its inputs have changed since it was made; None: all of them.

        The days between the clocks of the two runs count too: what was in the future is not any more.
        """
        table = self.table(name)
        if not table.latest():
            return None
        reads, keyed = self.calendar.reads[name], self.calendar.keyed.get(name, {})
        made_from = table.version().inputs
        for source in (*reads, *keyed):
            if made_from.get(source) not in self.table(source).versions():
                return None
        facts = next(iter(reads))
        present = days_in(self.table(facts)) | days_in(table)
        since = date.fromisoformat(table.version().as_of) - timedelta(1)
        found = set(extra) & present
        found |= {d for d in present if d is not None and since <= d <= run.as_of + timedelta(1)}
        for source, reach in reads.items():
            if made_from[source] != self.table(source).latest():
                hit = widened(changed_days(self.table(source), made_from[source]), reach)
                found |= {d for d in present if hit(d)}
        for source, key in keyed.items():
            if made_from[source] != self.table(source).latest():
                keys = changed_keys(self.table(source), made_from[source], key)
                rows = self.table(facts).read().select(DAY, key).join(keys, key, "left_semi")
                found |= {r[0] for r in rows.select(DAY).distinct().collect()}
        return found

    def refresh_days(
        self, name: str, tables: Mapping[str, DataFrame], build: Callable[[dict[str, DataFrame]], DataFrame],
        run: RunContext, extra: Iterable[Day] = (),
    ) -> set[Day] | None:
        """Build the touched days of a table again and publish them; returns the days, None for all."""
        reads = self.calendar.reads[name]
        sources = (*reads, *self.calendar.keyed.get(name, {}))
        days = self.touched(name, run, extra)
        inputs = self.versions(sources)
        if days is None:
            self.publish_whole(name, build(dict(tables)), run, sources)
        elif days or inputs != dict(self.table(name).version().inputs):
            sliced = dict(tables)
            for source, reach in reads.items():
                sliced[source] = self.read(source, read_days(days, reach, days_in(self.table(source))))
            rows = dated(build(sliced), self.calendar.day[name]).filter(on_days(days))
            text = [d.isoformat() if d else "" for d in days]
            self.table(name).publish(
                rows, run, [DAY], replace=F.col("values")[DAY].isin(text) if text else F.lit(False), inputs=inputs
            )
        return days


def keep_rejects(
    lake: Lake, name: str, batch: DataFrame, rules: Mapping[str, str], run: RunContext, full: bool,
    parents: Sequence[quarantine.Parent] = (), damaged: DataFrame | None = None,
) -> set[Day]:
    """Settle the ledger of a bronze table with a new batch; returns the days of replayed rows.

    ``damaged`` are lines of the batch that could not be read, which never reached bronze.
    """
    ledger = SnapshotTable(lake.spark, f"{lake.root}/quarantine/{name}")
    checks = {n: F.expr(rule) for n, rule in rules.items()}
    content = [c for c in batch.columns if c not in LINEAGE]
    day = F.expr(f"try_cast({lake.calendar.day[name]} AS DATE)") if name in lake.calendar.day else None
    entries = quarantine.rejects(quarantine.screened(batch, checks, parents), content, run, day)
    if damaged is not None:
        entries = entries.unionByName(quarantine.unreadable(damaged, DAMAGED, run))
    last = ledger.latest()
    if last and not full:
        # A batch that is loaded again brings its rejects again.
        former = ledger.read().filter(F.col("batch_id") != run.batch_id)
        entries = quarantine.settled(former, batch.schema, checks, parents, run).unionByName(entries)
    ledger.publish(entries, run)
    taken = quarantine.replayed(ledger.read(), run.batch_id).select("day").distinct().collect()
    return {r.day for r in taken}
