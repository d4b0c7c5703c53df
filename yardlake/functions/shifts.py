"""Working shifts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shift(ts: Column) -> Column:
    hour = F.hour(ts)
    return F.when(hour.between(6, 13), "MORNING").when(hour.between(14, 21), "AFTERNOON").when(hour.isNotNull(), "NIGHT")


def operational_date(ts: Column) -> Column:
    """The night belongs to the day it began on."""
    return F.when(F.hour(ts) < 6, F.date_sub(F.to_date(ts), 1)).otherwise(F.to_date(ts))
