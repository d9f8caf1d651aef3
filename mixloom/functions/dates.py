"""Date column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two date layouts met in the input files.
DATE_LAYOUTS = ("yyyy-MM-dd", "dd-MM-yyyy")


def parse_date(column) -> Column:
    """Text to date under the known layouts; text that fits none becomes NULL."""
    text = F.col(column) if isinstance(column, str) else column
    return F.coalesce(*[F.try_to_date(text, layout) for layout in DATE_LAYOUTS])


def day_of_week(column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return (F.weekday(column) + F.lit(1)).cast("int")


def period_index(column, unit="week") -> Column:
    """Whole periods since a fixed Monday (week) or the epoch (day)."""
    if unit == "day":
        return F.datediff(F.to_date(column), F.lit("1970-01-01").cast("date"))
    if unit == "week":
        monday = F.to_date(F.date_trunc("week", F.col(column) if isinstance(column, str) else column))
        return (F.datediff(monday, F.lit("1969-12-29").cast("date")) / F.lit(7)).cast("int")
    raise ValueError(f"unknown period unit: {unit}")


def add_calendar(df, day):
    """Day of week, month, their names and the year-month of ``day``."""
    d = F.col(day)
    return df.withColumns(
        {
            "day_of_week": day_of_week(d),
            "day_name": F.date_format(d, "EEEE"),
            "month": F.month(d),
            "month_name": F.date_format(d, "MMMM"),
            "year_month": F.date_format(d, "yyyy-MM"),
        }
    )
