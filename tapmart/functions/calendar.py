"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_attributes(day: Column) -> dict[str, Column]:
    """Weeks are ISO weeks, weekdays run from Monday = 1 to Sunday = 7."""
    weekday = F.weekday(day) + 1
    return {
        "year": F.year(day).cast("smallint"),
        "quarter": F.quarter(day).cast("tinyint"),
        "month": F.month(day).cast("tinyint"),
        "month_name": F.date_format(day, "MMMM"),
        "week_of_year": F.weekofyear(day).cast("tinyint"),
        "day_of_month": F.dayofmonth(day).cast("tinyint"),
        "day_of_week": weekday.cast("tinyint"),
        "day_name": F.date_format(day, "EEEE"),
        "is_weekend": F.when(weekday >= 6, F.lit(1)).otherwise(F.lit(0)),
        "is_holiday": F.lit(0),
        "holiday_note": F.lit(None).cast("string"),
    }
