"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column | str) -> Column:
    """``yyyyMMdd`` as an int."""
    return F.date_format(d, "yyyyMMdd").cast("int")


def calendar_parts(d: Column | str) -> dict[str, Column]:
    return {
        "date_key": date_key(d),
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "quarter": F.quarter(d),
        "day_of_week": F.date_format(d, "EEEE"),
    }
