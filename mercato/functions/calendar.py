"""Calendar feature columns (pandas-style: weekday Monday=0)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The day-of-year span flagged as the Christmas season.
CHRISTMAS_FIRST_DAY, CHRISTMAS_LAST_DAY = 270, 355


def calendar_columns(date_col: str) -> list[Column]:
    d = F.col(date_col)
    return [F.weekofyear(d).cast("int").alias("week"), F.month(d).cast("int").alias("month"),
            F.quarter(d).cast("int").alias("quarter"), F.year(d).cast("int").alias("year"),
            F.dayofmonth(d).cast("int").alias("day"), F.weekday(d).cast("int").alias("weekday"),
            F.dayofyear(d).cast("int").alias("dayofyear"),
            F.dayofyear(d).between(CHRISTMAS_FIRST_DAY, CHRISTMAS_LAST_DAY).cast("int").alias("is_christmas"),
            (F.weekday(d) >= 5).cast("int").alias("is_weekend")]
