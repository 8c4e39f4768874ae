"""Extract run: API payload pages -> snapshot CSV files for the pipeline.

The source system calls its API once per run and writes one timestamped CSV
per table. Here the API responses are DataFrames of JSON pages; flattening,
the extraction window and the status routing are Spark transforms, and every
table lands under ``<raw>/<table>/extraction_ts=<ts>`` (an empty extract
writes nothing, so the previous snapshot stays current).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake import constants as K
from finlake.functions.dates import extract_window_bounds
from finlake.sources import files, payload

SETTLED_STATUS = [0]
PENDING_STATUS = [1]


FEEDS = {K.STATUS_SETTLED: "transacoes_efetivadas", K.STATUS_PENDING: "transacoes_pendentes"}


def routed_movements(pages: DataFrame, refdate, json_col: str = "payload") -> DataFrame:
    """Movements of the extraction window with the table that takes them in ``feed``; the pages are parsed once."""
    lo, hi = extract_window_bounds(refdate)
    moves = payload.movements(pages, json_col, SETTLED_STATUS + PENDING_STATUS)
    feed = F.when(F.col("situacao") == K.STATUS_SETTLED, F.lit(FEEDS[K.STATUS_SETTLED])).otherwise(F.lit(FEEDS[K.STATUS_PENDING]))
    return moves.where(F.col("data").between(F.lit(lo), F.lit(hi))).withColumn("feed", feed)


def flatten_run(pages: dict[str, DataFrame], refdate, json_col: str = "payload") -> dict[str, DataFrame]:
    """The six raw tables of one run.

    ``pages``: ``cards``, ``accounts``, ``income_categories``,
    ``expense_categories``, ``movements`` and ``budgets`` (the budget pages
    carry their month in column ``data``; they may be missing, as budgets are
    only asked for at times). Movements and budgets are kept in
    the window first day of (refdate - 1 month) .. 31 December of that year.
    """
    lo, hi = extract_window_bounds(refdate)
    routed = routed_movements(pages["movements"], refdate, json_col)
    out = {
        "cartoes": payload.cards(pages["cards"], json_col),
        "contas": payload.accounts(pages["accounts"], json_col),
        "categorias": payload.categories(pages["income_categories"], pages["expense_categories"], json_col),
        **{name: routed.where(F.col("feed") == name).drop("feed") for name in FEEDS.values()},
    }
    if "budgets" in pages:
        out["orcamentos"] = payload.budgets(pages["budgets"].where(F.col("data").between(F.lit(lo), F.lit(hi))),
                                            json_col, "data")
    return out


def extract(pages: dict[str, DataFrame], raw_root: str, extraction_ts: str, refdate,
            json_col: str = "payload") -> dict[str, str | None]:
    """Write the run's tables as snapshot CSVs; returns the written paths (None = empty).

    The movement pages are scanned and parsed by one write that routes the rows to their feeds.
    """
    written = {name: files.write_snapshot_csv(df, raw_root, name, extraction_ts)
               for name, df in flatten_run(pages, refdate, json_col).items() if name not in FEEDS.values()}
    return written | files.write_feeds_csv(routed_movements(pages["movements"], refdate, json_col), raw_root, "feed",
                                           FEEDS.values(), extraction_ts)
