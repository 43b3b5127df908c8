"""Month and year expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def month_start(col: Column | str) -> Column:
    return F.trunc(col, "month")


def year_month(col: Column | str) -> Column:
    return F.date_format(col, "yyyy-MM")


def month_angle(col: Column | str) -> Column:
    return F.month(col) * F.lit(2.0 * math.pi / 12.0)


def months_before(col: Column, months: int) -> Column:
    """Calendar shift with the day clipped to the end of the month."""
    return F.add_months(col, -months)
