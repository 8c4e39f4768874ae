"""Column expressions (all JVM-side built-ins, no UDFs)."""

from finlake.functions.dates import (  # noqa: F401
    month_start, month_key, business_date_key, business_month_key, year_end,
    iso_to_date, extract_window_bounds,
)
from finlake.functions.money import money, money_total, ratio, clamp_balance, interest  # noqa: F401
from finlake.functions.text import instalment, last_token, first_truthy  # noqa: F401
