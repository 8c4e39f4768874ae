"""Command line: ``python -m finlake extract|pipeline ...``.

* ``extract``: API pages (JSON lines, one document per line, under
  ``<pages>/<cards|accounts|income_categories|expense_categories|movements|budgets>/``
  (budgets are optional);
  budget documents carry their month in a top-level ``data`` field) ->
  snapshot CSVs under ``<raw>/<table>/extraction_ts=<ts>``.
* ``pipeline``: raw CSVs -> bronze -> silver -> gold -> analytics in ``<lake>``,
  as state version ``--version``.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import functions as F

PAGE_SETS = ("cards", "accounts", "income_categories", "expense_categories", "movements", "budgets")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="finlake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ex = sub.add_parser("extract")
    ex.add_argument("--pages", required=True)
    ex.add_argument("--raw", required=True)
    ex.add_argument("--refdate", required=True)
    ex.add_argument("--extraction-ts", default=dt.datetime.now().strftime("%Y%m%d_%H%M%S"))
    pl = sub.add_parser("pipeline")
    pl.add_argument("--raw", required=True)
    pl.add_argument("--lake", required=True)
    pl.add_argument("--run-date", default=dt.date.today().isoformat())
    pl.add_argument("--version", type=int, required=True)
    pl.add_argument("--start-month", default=None)
    pl.add_argument("--clean-source", choices=["archive", "delete"], default=None,
                    help="purge raw files of committed batches (archived under <lake>/_archive)")
    for p in (ex, pl):
        p.add_argument("--master", default=None)
        p.add_argument("--input-gb", type=float, default=None, help="size the session for this much input")
        p.add_argument("--cores", type=int, default=None, help="task slots of the cluster, with --input-gb")
    a = ap.parse_args(argv)

    from finlake.session import get_session, scale_conf
    sized = scale_conf(int(a.input_gb * (1 << 30)), a.cores or 1) if a.input_gb else None
    spark = get_session(a.master, extra=sized)
    if a.cmd == "extract":
        from finlake.plans.extract import extract
        from finlake.storage import Files
        found = [n for n in PAGE_SETS if n != "budgets" or Files(spark).exists(f"{a.pages.rstrip('/')}/{n}")]
        pages = {n: spark.read.text(f"{a.pages.rstrip('/')}/{n}").withColumnRenamed("value", "payload") for n in found}
        if "budgets" in pages:
            pages["budgets"] = pages["budgets"].withColumn("data", F.to_date(F.get_json_object("payload", "$.data")))
        written = extract(pages, a.raw, a.extraction_ts, a.refdate)
        for name, path in written.items():
            print(f"{name}: {path or 'empty, skipped'}")
    else:
        from finlake.plans import pipeline
        from finlake.params import production_params
        params = production_params(a.run_date, a.start_month)
        pipeline.run(spark, a.raw, a.lake, a.run_date, params, a.version, clean_source=a.clean_source)
        print(f"lake {a.lake} at version {a.version}")


if __name__ == "__main__":
    main()
