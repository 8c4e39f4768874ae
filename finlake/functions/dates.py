"""Date and month-key expressions.

Internally a month is a DATE (first day of the month); the ``yyyy-MM-01``
string is produced only for output columns so joins and filters stay typed and
prunable.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(c) -> Column:
    """DATE of the first day of the month of ``c``."""
    return F.trunc(_c(c).cast("date"), "month")


def month_key(c) -> Column:
    """Output month string ``yyyy-MM-01``."""
    return F.date_format(_c(c), "yyyy-MM-01")


def business_date_key(c) -> Column:
    """``yyyyMMdd`` business-date key."""
    return F.date_format(_c(c), "yyyyMMdd")


def business_month_key(c) -> Column:
    """``yyyyMM01`` business-month key."""
    return F.date_format(_c(c), "yyyyMM01")


def year_end(c) -> Column:
    """DATE of 31 December of the year of ``c``."""
    return F.to_date(F.date_format(_c(c), "yyyy-12-31"))


def iso_to_date(c) -> Column:
    """ISO ``yyyy-MM-ddTHH:mm:ss`` text -> DATE of the part before ``T``."""
    return F.to_date(F.substring_index(_c(c), "T", 1))


def extract_window_bounds(refdate: str | _dt.date) -> tuple[_dt.date, _dt.date]:
    """Extraction window of a run: first day of (refdate - 1 month) .. 31 Dec of that year.

    A January refdate therefore extracts only the previous December.
    """
    d = _dt.date.fromisoformat(str(refdate)[:10])
    y, m = (d.year, d.month - 1) if d.month > 1 else (d.year - 1, 12)
    return _dt.date(y, m, 1), _dt.date(y, 12, 31)
