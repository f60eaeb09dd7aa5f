"""Report parameters become predicates on the driver; an unset parameter adds nothing to the plan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.dates import FIRST_DAY, LAST_DAY


def values_of(chosen: Any) -> list[Any]:
    if chosen is None:
        return []
    if isinstance(chosen, Iterable) and not isinstance(chosen, (str, bytes)):
        return [v for v in chosen if v is not None]
    return [chosen]


def optional_in(c: Column, chosen: Any) -> Column | None:
    """Nothing chosen keeps every row; a choice also drops rows whose value is NULL."""
    values = values_of(chosen)
    return c.isin(*values) if values else None


def optional_between(c: Column, low: dt.date | None, high: dt.date | None) -> Column:
    """Closed range with open defaults; rows without a date drop out in any case."""
    return c.between(F.lit(low or FIRST_DAY), F.lit(high or LAST_DAY))


@dataclass(frozen=True)
class Params:
    """``as_at`` is the run date or time; the rest are the report's own parameters by name."""

    as_at: dt.date | dt.datetime | None = None
    date_from: dt.date | None = None
    date_to: dt.date | None = None
    chosen: Mapping[str, Any] = field(default_factory=dict)

    def today(self) -> Column:
        day = self.as_at.date() if isinstance(self.as_at, dt.datetime) else self.as_at
        return F.lit(day) if day else F.current_date()

    def now(self) -> Column:
        """The run time; a run date alone is its midnight."""
        return F.lit(str(self.as_at)).cast("timestamp") if self.as_at else F.current_timestamp()

    def get(self, name: str) -> Any:
        return self.chosen.get(name)

    def narrow(self, df: DataFrame, **columns: str | Column) -> DataFrame:
        """Apply every chosen parameter to its column."""
        for name, c in columns.items():
            keep = optional_in(F.col(c) if isinstance(c, str) else c, self.get(name))
            if keep is not None:
                df = df.filter(keep)
        return df
