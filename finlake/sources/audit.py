"""Bronze audit columns."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_date_key(run_date) -> str:
    """``yyyyMMdd`` of a run date given as date, ISO text or ``yyyyMMdd``."""
    s = str(run_date)
    if len(s) == 8 and s.isdigit():
        return s
    return _dt.date.fromisoformat(s[:10]).strftime("%Y%m%d")


def with_audit(df: DataFrame, run_date, business_col: str | None = None,
               ingest_time: bool = True, source_file: bool = True) -> DataFrame:
    """Append ``_processdate``, ``_businessdate``, ``_businessmonth`` and,
    optionally, ``_ingesttime`` (one value per micro-batch) and ``_sourcefile``.

    Without a business-date column the run date is used; its month key is
    computed from the parsed date (a ``yyyyMMdd`` string is not a date).
    """
    rd = run_date_key(run_date)
    if business_col:
        bd = F.date_format(F.col(business_col), "yyyyMMdd")
        bm = F.date_format(F.col(business_col), "yyyyMM01")
    else:
        bd = F.lit(rd)
        bm = F.date_format(F.to_date(F.lit(rd), "yyyyMMdd"), "yyyyMM01")
    cols = {"_processdate": F.lit(rd), "_businessdate": bd, "_businessmonth": bm}
    if ingest_time:
        cols["_ingesttime"] = F.current_timestamp()
    if source_file:
        cols["_sourcefile"] = F.col("_metadata.file_path")
    return df.withColumns(cols)
