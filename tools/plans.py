"""Print the final (post-AQE) physical plans of the key queries.

    python tools/plans.py /root/testdata/sf0.01 > plans.txt

Each query is executed once with ``collect()`` on the same DataFrame so
its plan is the adaptive plan AQE settled on; attribute lists are trimmed.
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from martlane import catalog  # noqa: E402
from martlane.operators import alerts, dau  # noqa: E402
from martlane.plans import dashboard  # noqa: E402
from martlane.session import get_spark  # noqa: E402
from martlane.sources import fixtures as fx  # noqa: E402


def trim(plan: str) -> str:
    out = []
    for line in plan.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        out.append(line if len(line) <= 160 else line[:157] + "...")
    return "\n".join(out)


def main() -> None:
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark()
    cases = {
        "DAU table build (first visit per device/day)":
            lambda: dau.dau_first_visits(fx.startup_logs(spark, d)),
        "DAU one day from the raw log (range pushed to the scan)":
            lambda: dashboard.dau_hour(dau.dau_first_visits(
                fx.startup_logs(spark, d, "2024-01-15", "2024-01-15")), "2024-01-15"),
        "today vs yesterday on the 24-hour axis":
            lambda: catalog.q_realtime_hour_dau(spark, d),
        "order amount by province (pre-aggregated before the join)":
            lambda: catalog.q_order_amount_by_province(spark, d),
        "first-order flag (joined back on the order id)":
            lambda: catalog.q_first_order_flag(spark, d),
        "sale index build (lines deduplicated, joined, enriched)":
            lambda: catalog.build_sale_index(spark, d),
        "sale report over the index":
            lambda: catalog.q_sale_detail_report(spark, d),
        "alert window values (tagged panes, fan-out after the partial aggregate)":
            lambda: alerts.window_values(fx.event_logs(spark, d), 7200, 1800),
    }
    for title, make in cases.items():
        df = make()
        df.collect()
        print(f"## {title}\n\n```")
        print(trim(df._jdf.queryExecution().executedPlan().toString()))
        print("```\n")


if __name__ == "__main__":
    main()
