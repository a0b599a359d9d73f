"""Summarise the physical plan of each headline report (markdown on stdout).

Usage: python tools/plan_summary.py [sf_dir] [direct|materialized|yearly]

For every report: shuffles (Exchange, by partitioning), join strategies,
broadcasts, windows, and each Parquet scan's ReadSchema / PushedFilters /
PartitionFilters, as they appear in ``explain("formatted")`` of the plan before execution.
"""

from __future__ import annotations

import os
import re
import sys
import uuid
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from quotalake.operators import reports  # noqa: E402
from quotalake.session import local_session, shared_scratch  # noqa: E402
from quotalake.sources.star import Star  # noqa: E402
from quotalake.sources.yearly import YearlyStar  # noqa: E402

#: Reports on some years of a fact stored by year.
YEARLY = {
    "q2_of_a_financial_year": lambda star: reports.revenue_by_month_of(star, f"FY{star.order_years[1]}"),
    "q10b_since_a_year": lambda star: reports.vw_target_miss_rate(star, star.order_years[1] - 2),
}


def summarise(df) -> list[str]:
    # the same call DataFrame.explain("formatted") makes, returned instead of printed
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    ops = Counter()
    scans = []
    current = None
    for line in plan.splitlines():
        m = re.match(r"^\((\d+)\) (.+?)(?: \[codegen id : \d+\])?$", line.strip())
        if m:
            current = m.group(2).strip()
            name = current.split(" ")[0]
            if name in ("BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
                        "ShuffledHashJoin", "BroadcastNestedLoopJoin", "Window", "TakeOrderedAndProject",
                        "Generate", "HashAggregate"):
                ops[current if name.endswith("Join") else name] += 1
            continue
        if current and current.startswith("Scan parquet"):
            if line.startswith("ReadSchema:"):
                scans.append(["ReadSchema " + line.split(":", 1)[1].strip()])
            elif line.startswith(("PushedFilters:", "PartitionFilters:")):
                kind, what = line.split(":", 1)
                scans.append([f"{kind} {what.strip()}"])
        if current and current.startswith("Exchange") and line.startswith("Arguments:"):
            part = line.split(":", 1)[1].strip().split("(")[0].split(",")[0]
            ops[f"Exchange {part}"] += 1
    out = [", ".join(f"{k} x{v}" for k, v in sorted(ops.items()))]
    out += [f"  - {s[0][:160]}" for s in scans if s[0].startswith("ReadSchema")]
    pushed = sorted({s[0] for s in scans if s[0].startswith(("PushedFilters", "PartitionFilters")) and not s[0].endswith(" []")})
    out += [f"  - {p[:160]}" for p in pushed]
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    mode = sys.argv[2] if len(sys.argv) > 2 else "direct"
    spark = local_session(8)
    star = Star.from_parquet(spark, sf_dir)
    if mode == "materialized":
        star = star.materialize()
    if mode == "yearly":
        star = YearlyStar(star, f"{shared_scratch(spark)}/quotalake-yearly-{uuid.uuid4().hex}").load()
    print(f"### {mode} star, {os.path.basename(sf_dir)}\n")
    for name, fn in (YEARLY if mode == "yearly" else HEADLINE).items():
        lines = summarise(fn(star))
        print(f"- **{name}**: {lines[0]}")
        for line in lines[1:]:
            print(f"  {line}")
    print()


if __name__ == "__main__":
    main()
