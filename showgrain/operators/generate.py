"""Row generators: weekly slots, weekday rules, calendar months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def weekly(slots: DataFrame, first: Column, days: int) -> DataFrame:
    """Occurrences of weekly slots (``weekday`` 1 Sunday to 7 Saturday) over the next days: one row per date."""
    dates = F.explode(F.sequence(F.to_date(first), F.date_add(F.to_date(first), days - 1)))
    out = slots.withColumn("date", dates)
    return out.filter(F.dayofweek("date") == F.col("weekday"))


def on_weekdays(rules: DataFrame, first: Column, last: Column) -> DataFrame:
    """Dates on which each rule holds: within its validity and on its weekdays (none named: every day)."""
    lo = F.greatest(F.coalesce("valid_from", F.to_date(first)), F.to_date(first))
    hi = F.least(F.coalesce("valid_to", F.to_date(last)), F.to_date(last))
    dated = rules.filter(lo <= hi).withColumn("date", F.explode(F.sequence(lo, hi)))
    return dated.filter((F.size("days_of_week") == 0) | F.array_contains("days_of_week", (F.dayofweek("date") - 1).cast("smallint")))
