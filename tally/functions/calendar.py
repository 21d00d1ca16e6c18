"""Calendar columns derived from a DATE column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of_week_sunday0(d: Column) -> Column:
    """Day of week with Sunday = 0 (Spark's ``dayofweek`` is 1-based)."""
    return (F.dayofweek(d) - 1).cast("long")


def month_label(d: Column) -> Column:
    """``Jan 2024`` style label."""
    return F.date_format(d, "MMM yyyy")


def calendar_columns(date_col: str = "transaction_date") -> dict[str, Column]:
    d = F.col(date_col)
    return {
        "transaction_month": F.trunc(d, "month"),
        "transaction_year": F.trunc(d, "year"),
        "month_number": F.month(d).cast("long"),
        "year_number": F.year(d).cast("long"),
        "day_of_week": day_of_week_sunday0(d),
        "quarter_number": F.quarter(d).cast("long"),
        "month_label": month_label(d),
    }
