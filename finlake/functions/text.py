"""Text expressions: instalment parsing, name tokens, first-truthy ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from finlake.constants import INSTALMENT_PATTERN


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def instalment(text, group: int, pattern: str = INSTALMENT_PATTERN) -> Column:
    """Integer of capture ``group`` of the first ``(n/m)`` match, NULL when absent.

    ``try_cast`` keeps an over-long digit run NULL instead of failing the job.
    """
    return F.nullif(F.regexp_extract(_c(text), pattern, group), F.lit("")).try_cast("int")


def last_token(c, sep: str = ".") -> Column:
    """Text after the last ``sep``, trimmed (``"Bank. Main"`` -> ``"Main"``)."""
    return F.trim(F.substring_index(_c(c), sep, -1))


def first_truthy(*cols) -> Column:
    """First value that is neither NULL nor 0; else the last value; NULL -> 0."""
    cs = [_c(c) for c in cols]
    head = [F.nullif(c, F.lit(0)) for c in cs[:-1]]
    return F.coalesce(*head, cs[-1], F.lit(0))
