"""Date helpers (P9, P24): every trailing window is anchored on an explicit ``as_of``."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def months_back(d: dt.date, months: int) -> dt.date:
    """``d - INTERVAL 'n months'`` with month-end clamping (2024-02-29 - 12m = 2023-02-28)."""
    y, m = divmod(d.year * 12 + (d.month - 1) - months, 12)
    last = calendar.monthrange(y, m + 1)[1]
    return dt.date(y, m + 1, min(d.day, last))


def trailing(col: Column, as_of: dt.date, months: int, skip_months: int = 0) -> Column:
    """``col >= as_of - months`` (and ``< as_of - skip_months`` when skip_months > 0)."""
    cond = col >= F.lit(months_back(as_of, months))
    if skip_months:
        cond = cond & (col < F.lit(months_back(as_of, skip_months)))
    return cond
