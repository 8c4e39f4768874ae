"""Money and ratio expressions.

Money is ``decimal(18,2)`` per row and ``decimal(38,2)`` once aggregated; ratios
are doubles rounded to 6 places and NULL (not an error) on a zero divisor.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from finlake.constants import MONEY, MONEY_TOTAL, INTEREST_RATE


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    return _c(c).cast(MONEY)


def money_total(c) -> Column:
    return _c(c).cast(MONEY_TOTAL)


def ratio(num, den, scale: int = 6) -> Column:
    """``num / den`` as a double; NULL when ``den`` is 0 or NULL."""
    return F.round(F.try_divide(_c(num).cast("double"), _c(den).cast("double")), scale)


def clamp_balance(planned, actual, month, as_of) -> Column:
    """Remaining budget: 0 for months before ``as_of``, else ``greatest(0, planned - actual)``.

    ``greatest`` skips NULLs, so a NULL difference becomes 0.
    """
    return (F.when(_c(month) < F.lit(as_of).cast("date"), F.lit(0))
            .otherwise(F.greatest(F.lit(0), _c(planned) - _c(actual))))


def interest(balance, rate: str = INTEREST_RATE) -> Column:
    """Projected interest on a negative balance, 0 otherwise (``decimal(38,6)``)."""
    b = _c(balance)
    return (F.when(b < 0, F.abs(b) * F.lit(rate).cast("decimal(10,6)"))
            .otherwise(F.lit(0))).cast("decimal(38,6)")
