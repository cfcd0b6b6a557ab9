"""What a mart needs to know: where its tables are, which day it is for and which versions are pinned."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from daybook.functions.columns import as_date
from daybook.operators.staging import materialise


@dataclass
class Context:
    """Access to sealed inputs.

    ``read(name, version)`` returns a table, at a pinned version when one is given. ``marts`` holds
    marts that are already stored; a mart that is not there is planned when a report asks for it, which starts no job, so that
    only the columns the report needs are computed. ``stage`` names marts that several reports of one run read: those are written
    once. ``stored`` holds dimensions with one row per record (``sources.dimensions``). ``hot`` tells that some account, branch or file has more rows than one task should take.
    """

    spark: SparkSession
    business_date: str
    read: Callable[[str, int | None], DataFrame]
    pins: Mapping[str, int] = field(default_factory=dict)
    target_date: str | None = None
    report_year: int | None = None
    marts: dict[str, DataFrame] = field(default_factory=dict)
    history: Mapping[str, DataFrame] = field(default_factory=dict)
    stage: Collection[str] = ()
    stored: Mapping[str, DataFrame] = field(default_factory=dict)
    hot: bool = False

    @classmethod
    def of_frames(cls, spark: SparkSession, frames: Mapping[str, DataFrame], business_date: str, **more) -> Context:
        return cls(spark, business_date, lambda name, version: frames[name], **more)

    @property
    def day(self):
        return F.lit(self.business_date).cast("date")

    @property
    def load_day(self) -> str:
        """Date a report is loaded for: the target date, else the business date."""
        return self.target_date or self.business_date

    def dim(self, name: str) -> DataFrame:
        """Current-state table at its pinned version."""
        return self.read(name, self.pins.get(name))

    def versions(self, name: str) -> DataFrame:
        """Versions of a dimension's records: those of the table, or the newest ones only if they are ``stored``."""
        return self.stored[name] if name in self.stored else self.dim(name)

    def event(self, name: str, date_col: str) -> DataFrame:
        """Rows of an event table for the business date."""
        return self.dim(name).filter(as_date(date_col) == self.day)

    def pull(self, name: str) -> DataFrame:
        """Partition of a pulled table for the business date."""
        return self.read(name, None).filter(F.col("business_date") == self.day)

    def mart(self, name: str) -> DataFrame:
        if name not in self.marts:
            from daybook.plans import MARTS

            built = MARTS[name](self)
            self.marts[name] = materialise(built) if name in self.stage else built
        return self.marts[name]
