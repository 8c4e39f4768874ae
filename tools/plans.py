"""Summarise the physical plans (``explain("formatted")``) of every check query
and of the marts as the pipeline runs them over a lake.

Usage: python tools/plans.py [sf_dir] > docs/PLANS.md
"""
import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COUNT = [
    ("shuffles", r"\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange RoundRobinPartitioning|\bExchange SinglePartition|^\(\d+\) Exchange$"),
    ("single-partition", r"SinglePartition"),
    ("broadcasts", r"^\(\d+\) BroadcastExchange"),
    ("BHJ", r"^\(\d+\) BroadcastHashJoin"),
    ("SMJ", r"^\(\d+\) SortMergeJoin"),
    ("BNLJ/cartesian", r"^\(\d+\) (BroadcastNestedLoopJoin|CartesianProduct)"),
    ("hash agg", r"^\(\d+\) HashAggregate"),
    ("sort agg", r"^\(\d+\) SortAggregate"),
    ("windows", r"^\(\d+\) Window"),
    ("generate", r"^\(\d+\) Generate"),
    ("python", r"^\(\d+\) (ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas)"),
]


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarise(text: str) -> dict:
    lines = text.splitlines()
    out = {}
    for name, pat in COUNT:
        rx = re.compile(pat)
        out[name] = sum(1 for ln in lines if rx.search(ln.strip()))
    exch = [ln for ln in lines if re.match(r"^Arguments: (hashpartitioning|SinglePartition|rangepartitioning|RoundRobin)", ln)]
    out["shuffles"] = len(exch)
    out["single-partition"] = sum(1 for ln in exch if "SinglePartition" in ln)
    out["pushed"] = sum(1 for ln in lines if ln.startswith("PushedFilters: [") and ln.strip() != "PushedFilters: []")
    out["pruned"] = sum(1 for ln in lines if ln.startswith("PartitionFilters: [") and ln.strip() != "PartitionFilters: []")
    return out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from finlake.session import get_session, scratch_path
    spark = get_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    from finlake.checks import registry
    from finlake.plans import pipeline
    from finlake.plans.lake import Lake
    from finlake.sources import views
    from finlake.sources.views import TEST_PARAMS, Tables

    rows = []
    for name, q in sorted(registry.queries().items()):
        if name in ("ingest_files", "ingest_infer", "ingest_evolve", "ingest_evolve_stream", "ingest_infer_merge",
                    "snapshot_csv_roundtrip", "scd1_stream"):
            continue  # these run jobs (file extracts, streams) while being built
        rows.append((f"check `{name}`", summarise(plan_text(q(spark, sf)))))
    lake = Lake(spark, scratch_path(spark, "plans-lake"))
    t = Tables(spark, sf)
    pipeline.build_gold(lake, movements=views.movements(t), accounts=views.accounts(t), cards=views.cards(t),
                        categories=views.categories(t), budgets=views.budgets(t), params=TEST_PARAMS, version=1)
    for name, df in pipeline.mart_plans(*pipeline.gold_tables(lake), TEST_PARAMS).items():
        rows.append((f"lake mart `{name}`", summarise(plan_text(df))))
    cols = [c for c, _ in COUNT] + ["pushed", "pruned"]
    print("| plan | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    for name, s in rows:
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")


if __name__ == "__main__":
    main()
