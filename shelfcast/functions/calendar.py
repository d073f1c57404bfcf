"""Calendar expressions (F1-F8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_columns(date: str = "date") -> dict[str, Column]:
    """Calendar features keyed by output name, Monday = 0 weekdays, ISO week."""
    d = F.col(date)
    dow = F.weekday(d)
    return {
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "day_of_week": dow,
        "day_of_year": F.dayofyear(d),
        "week_of_year": F.weekofyear(d),
        "is_weekend": (dow >= 5).cast("int"),
        "is_month_start": (F.dayofmonth(d) == 1).cast("int"),
        "is_month_end": (d == F.last_day(d)).cast("int"),
        "is_quarter_start": (F.trunc(d, "quarter") == d).cast("int"),
        "is_quarter_end": (F.trunc(F.date_add(d, 1), "quarter") == F.date_add(d, 1)).cast("int"),
    }


def with_calendar(df, date: str = "date"):
    return df.withColumns(calendar_columns(date))
