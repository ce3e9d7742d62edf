"""Write PLANS.md: physical-plan facts for every query of the library's own registry.

Usage: python tools/plan_report.py [sf_dir]
Queries that write files or run streams (their plan is the read-back) are
listed with the facts of the frame they return.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans.facts import plan_facts  # noqa: E402
from tessera.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    from tessera.queries import QUERIES
    rows = []
    for name, fn in QUERIES.items():
        f = plan_facts(fn(spark, sf_dir))
        rows.append((name, f.shuffle_exchanges, f.broadcast_joins, f.sort_merge_joins,
                     f.window_group_limits, len([p for p in f.pushed_filters if p.strip()]),
                     f.python_evals, "SinglePartition" in f.text))
    out = ["# Physical plans of the registered queries", "",
           f"Generated by `tools/plan_report.py` on `{sf_dir}` (initial AQE plans; AQE may",
           "coalesce partitions or turn a shuffle join into a broadcast join at run time).",
           "`single` marks a plan with an exchange into one partition: only one-row",
           "aggregates (totals, KPIs, cut points) and final top-k merges are expected there.", "",
           "| query | shuffles | broadcast joins | sort-merge joins | group limits | scans with pushed filters | python | single |",
           "|---|---|---|---|---|---|---|---|"]
    for r in rows:
        out.append("| " + " | ".join(str(x) for x in r) + " |")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out) + "\n")
    print(f"wrote {path} ({len(rows)} queries)")


if __name__ == "__main__":
    main()
