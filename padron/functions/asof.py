"""The moment an operator counts as "now"."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class AsOf:
    """Reference moment; ``AsOf()`` is the clock of the query, ``AsOf.at(x)`` a fixed one."""

    moment: datetime | None = None

    @classmethod
    def at(cls, value: AsOf | datetime | date | str | None) -> AsOf:
        if value is None or isinstance(value, AsOf):
            return value or cls()
        if isinstance(value, str):
            value = datetime.fromisoformat(value)
        if not isinstance(value, datetime):
            value = datetime(value.year, value.month, value.day)
        return cls(value)

    def pinned(self, spark: SparkSession) -> AsOf:
        """The same moment for every job: a clock is read once, in the session's zone."""
        if self.moment is not None:
            return self
        return AsOf(spark.range(1).select(self.now).first()[0])

    @property
    def today(self) -> Column:
        return F.current_date() if self.moment is None else F.lit(self.moment.date())

    @property
    def now(self) -> Column:
        if self.moment is None:
            return F.call_function("localtimestamp")
        return F.lit(self.moment.isoformat(sep=" ")).cast("timestamp_ntz")

    @property
    def iso(self) -> Column:
        """ISO text of the moment."""
        if self.moment is None:
            return F.date_format(self.now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        return F.lit(self.moment.isoformat())

    @property
    def timestamp(self) -> Column:
        """The moment as an instant, reading a fixed one in the session's zone."""
        return F.current_timestamp() if self.moment is None else self.now.cast("timestamp")

    def years_ago(self, years: int) -> Column:
        return F.add_months(self.today, -12 * years)
