"""The clock and batch identity of one run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class RunContext:
    """Every "today" and "now" in the library comes from here, never from the wall clock.

    A rerun with the same context therefore gives the same rows, and a date filter on
    ``as_of`` is a literal that reaches the Parquet scan.
    """

    as_of: date
    batch_id: str = "19700101_000000"
    load_ts: datetime = datetime(1970, 1, 1)
    as_of_ts: datetime | None = None

    @classmethod
    def of(cls, as_of: str, load_ts: str | None = None, as_of_ts: str | None = None) -> RunContext:
        day = date.fromisoformat(as_of)
        loaded = datetime.fromisoformat(load_ts) if load_ts else datetime.combine(day, time())
        clock = datetime.fromisoformat(as_of_ts) if as_of_ts else None
        return cls(day, loaded.strftime("%Y%m%d_%H%M%S"), loaded, clock)

    @property
    def clock(self) -> datetime:
        """The moment that counts as now: given, else the load time, but never before ``as_of``."""
        return self.as_of_ts or max(self.load_ts, datetime.combine(self.as_of, time()))

    @property
    def today(self) -> Column:
        return F.lit(self.as_of.isoformat()).cast("date")

    @property
    def now(self) -> Column:
        """The clock of the run, without a zone."""
        return F.lit(self.clock.isoformat(sep=" ")).cast("timestamp_ntz")

    @property
    def loaded(self) -> Column:
        return F.lit(self.load_ts.isoformat(sep=" ")).cast("timestamp_ntz")

    def days_ago(self, n: int) -> Column:
        return F.date_sub(self.today, n)
