"""Write PLANS.md: the executed physical plan shape of the headline jobs.

    python scripts/explain_plans.py [sf_dir]

Each job runs once (noop sink) so the adaptive plan is final; the summary
counts the operators that matter at scale and quotes the scan lines
(pushed filters, read schema).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from candlewick.operators import features as feat  # noqa: E402
from candlewick.operators.models import quantile_forecast  # noqa: E402
from candlewick.operators.scoring import score_requests  # noqa: E402
from candlewick.operators.splits import chronological_holdout  # noqa: E402
from candlewick.operators.models import ridge_fit  # noqa: E402
from candlewick.operators.train import training_rows  # noqa: E402
from candlewick.session import local_session, materialize  # noqa: E402
from candlewick.sources.bars import bars_from_lineitem, bars_from_orders, load_bars  # noqa: E402
from candlewick.sources.requests import requests_from_bars  # noqa: E402

PATTERNS = {
    "hash exchanges": r"Exchange hashpartitioning",
    "single-partition exchanges": r"Exchange SinglePartition",
    "range exchanges": r"Exchange rangepartitioning",
    "sorts": r"\bSort \[",
    "windows": r"\bWindow \[",
    "group limits": r"WindowGroupLimit",
    "broadcast joins": r"BroadcastHashJoin",
    "sort-merge joins": r"SortMergeJoin",
    "partial aggregates": r"partial_",
    "python (Arrow) operators": r"MapInPandas|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas",
}


def executed(df) -> str:
    """Run the DataFrame's own physical plan, so the adaptive plan is final."""
    qe = df._jdf.queryExecution()
    qe.executedPlan().execute().count()
    return qe.executedPlan().toString()


def strip_cached(plan: str) -> str:
    """Drop the plan text Spark prints under an InMemoryRelation (its cached
    producer, not executed again when the cache is read)."""
    out, skip_indent = [], None
    for line in plan.splitlines():
        indent = len(line) - len(line.lstrip(" :+-|"))
        if skip_indent is not None and indent > skip_indent:
            continue
        skip_indent = None
        out.append(line)
        if "InMemoryRelation" in line:
            skip_indent = indent
    return "\n".join(out)


def final_only(plan: str) -> str:
    """Keep the ``== Final Plan ==`` part of an adaptive plan."""
    out = []
    for line in plan.splitlines():
        if "== Initial Plan ==" in line:
            break
        out.append(line)
    return "\n".join(out)


def section(spark, name: str, make) -> str:
    """Build a frame, run it, and count the jobs of both and the operators of the final plan."""
    group = f"plans-{name}"
    spark.sparkContext.setJobGroup(group, name)
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    df = make()
    built = jobs()
    plan = final_only(strip_cached(executed(df)))
    lines = [f"### {name}", "", "| what | count |", "| --- | --- |", f"| jobs while the frame is built | {built} |", f"| jobs in all | {jobs()} |"]
    for label, pat in PATTERNS.items():
        lines.append(f"| {label} | {len(re.findall(pat, plan))} |")
    spans = set(re.findall(r'\*\((\d+)\)', plan))
    lines.append(f"| whole-stage codegen spans | {len(spans)} |")
    scans = sorted({m.strip() for m in re.findall(r"(PushedFilters: \[[^\]\n]*\]?|ReadSchema: [^\n]*)", plan)})
    if scans:
        lines += ["", "Scan details:", ""] + [f"* `{s[:160]}`" for s in scans]
    return "\n".join(lines) + "\n"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 16, app="explain")
    ob = materialize(bars_from_orders(spark, sf_dir), "bars-orders")
    lb = materialize(bars_from_lineitem(spark, sf_dir), "bars-lineitem")
    bars_path = ob.inputFiles()[0].rsplit("/", 1)[0]
    rows = training_rows(lb, horizon=1)
    split = chronological_holdout(rows.df, rows.n)
    model = ridge_fit(split.where("is_train"), rows.feature_cols)
    req = materialize(requests_from_bars(lb), "requests")
    out = [f"# Executed plan shapes ({sf_dir}, local[8], 16 shuffle partitions, AQE on)", "",
           "Generated by `scripts/explain_plans.py`; operators are counted over the final adaptive plan, jobs over building and running.", ""]
    for name, make in (
        ("bar adapter: orders -> daily bars", lambda: bars_from_orders(spark, sf_dir)),
        ("bar adapter: lineitem -> daily bars", lambda: bars_from_lineitem(spark, sf_dir)),
        ("load_bars with a universe (filter pushed to the Parquet scan)", lambda: load_bars(spark, bars_path, universe=["1-URGENT", "5-LOW"])),
        ("tabular_features, segment=None (one series per task)", lambda: feat.tabular_features(lb, horizon=1, segment=None)),
        ("tabular_features, segment='year' (the default: data exchange + small halo branches)", lambda: feat.tabular_features(lb, horizon=1)),
        ("training_rows: the stored frame with positions", lambda: training_rows(lb, horizon=1).df),
        ("score_requests (all outcomes)", lambda: score_requests(req, model, allow_minimal=True).outcomes),
        ("quantile_forecast (whole history)", lambda: quantile_forecast(lb, horizon=1)),
    ):
        out.append(section(spark, name, make))
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
