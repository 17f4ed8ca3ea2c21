"""The clock that bars live on."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    """Bar length, the instant bar 0 opens, and the length of a part in days.

    A *part* is the unit in which tables are stored and rebuilt; the default is one calendar day of
    one-minute bars. Parts are named by the date they start on. Columns of type ``timestamp`` are read in the
    session time zone, ``timestamp_ntz`` as they stand.
    """

    bar: timedelta = timedelta(minutes=1)
    origin: datetime = datetime(1970, 1, 1)
    part_days: int = 1

    def __post_init__(self) -> None:
        if self.origin.time() != time(0):
            raise ValueError("origin must be a midnight")
        if self.bar.microseconds or timedelta(days=self.part_days) % self.bar:
            raise ValueError("a part must hold a whole number of bars of whole seconds")

    @property
    def bars_per_part(self) -> int:
        return timedelta(days=self.part_days) // self.bar

    def number(self, ts: Column) -> Column:
        """Whole bars between the origin and a timestamp."""
        days = F.datediff(F.to_date(ts), F.lit(self.origin.date()))
        seconds = (
            days.cast("long") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
        )
        return F.floor(seconds / int(self.bar.total_seconds()))

    def start(self, number: Column) -> Column:
        """Opening time of a bar."""
        return F.lit(self.origin.isoformat(" ")).cast("timestamp_ntz") + F.lit(self.bar) * number

    def part(self, number: Column) -> Column:
        """Name of the part a bar lies in."""
        index = F.floor(number / self.bars_per_part)
        return F.date_add(F.lit(self.origin.date()), (index * self.part_days).cast("int"))

    def position(self, number: Column) -> Column:
        """Place of a bar inside its part, from 0."""
        return F.pmod(number, F.lit(self.bars_per_part))

    def part_of(self, time: datetime) -> date:
        """Name of the part that holds a moment, outside of any frame."""
        days = (time.date() - self.origin.date()).days
        return self.origin.date() + timedelta(days=days // self.part_days * self.part_days)

    def first_bar(self, part: date) -> int:
        """Number of the bar that opens a part."""
        return (part - self.origin.date()).days // self.part_days * self.bars_per_part
