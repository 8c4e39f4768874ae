"""Run parameters of the marts."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from finlake import constants as K


@dataclass(frozen=True)
class Params:
    """What a run takes besides its data: cut-offs, rates and the names that have a meaning."""
    as_of: str
    start_month: str
    lifestyle_parents: tuple = tuple(K.LIFESTYLE_PARENTS)
    salary_subcategory: str = K.SALARY_SUBCATEGORY
    instalment_subcategory: str = K.INSTALMENT_SUBCATEGORY
    interest_rate: str = K.INTEREST_RATE
    income_parent: str = K.GROUP_INCOME
    dedupe_categories: bool = False


def production_params(run_date, start_month: str | None = None) -> Params:
    """Parameters of a scheduled run: the cut-off is the first day of the run
    month, the income report starts in January of the run year, and the
    category names are the source system's fixed values."""
    d = dt.date.fromisoformat(str(run_date)[:10])
    return Params(as_of=d.replace(day=1).isoformat(),
                  start_month=start_month or d.replace(month=1, day=1).isoformat())
