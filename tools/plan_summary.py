"""Summarise the physical plans of registered queries as a large input would
get them (no adaptive re-planning, no automatic broadcast): the exchanges
(shuffles) each plan needs, new and reused, and whether scans are pruned.

    python tools/plan_summary.py [name ...] > PLANS.txt
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from splitlens.plans import catalog  # noqa: E402
from splitlens.session import get_session  # noqa: E402


def main():
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    qs = catalog.queries()
    for name in sys.argv[1:] or sorted(qs):
        plan = qs[name](spark, "/root/testdata/sf0.01")._jdf.queryExecution().executedPlan().toString()
        lines = plan.split("\n")
        new = [re.sub(r"#\d+L?", "", l.split("Exchange ", 1)[1]).split(", ENSURE")[0].split(", REPARTITION")[0]
               for l in lines if re.search(r"(^|[-+:\s])Exchange ", l) and "ReusedExchange" not in l]
        reused = sum("ReusedExchange" in l for l in lines)
        bcast = sum("BroadcastExchange" in l for l in lines)
        scans = [re.search(r"ReadSchema: (struct<[^>]*>)", l).group(1) for l in lines if "ReadSchema" in l]
        print(f"{name}: {len(new)} exchanges ({bcast} broadcast of bounded frames), {reused} reused")
        for x in new:
            print(f"    {x[:110]}")
        for sc in sorted(set(scans)):
            print(f"    scan {sc[:110]}")


if __name__ == "__main__":
    main()
