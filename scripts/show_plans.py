"""Print formatted physical plans of representative queries (PLANS.md source).

Usage: python scripts/show_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from towerlens.operators import serving  # noqa: E402
from towerlens.plans import catalog as C, rollup  # noqa: E402
from towerlens.plans.microbatch import MicroBatchWriter  # noqa: E402
from towerlens.session import build_session, new_run_dir  # noqa: E402
from towerlens.sources.events import load_table, wire_from_events  # noqa: E402
from towerlens.streaming import jobs  # noqa: E402
from towerlens.streaming.runner import kpi_catalog  # noqa: E402


def show(title: str, df) -> None:
    plan = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    print(f"## {title}\n\n```\n{plan.strip()}\n```\n")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    print("# Physical plans\n\nGenerated by `scripts/show_plans.py` on", sf, "(local[8], AQE on; "
          "plans shown before AQE re-optimisation).\n")
    print("What to look for:\n\n"
          "* `average_by_operator`: 4-column `ReadSchema`; partial `HashAggregate` below the only "
          "key exchange (a hot operator costs one row per task in the shuffle). Raw rows are never "
          "shuffled.\n"
          "* `operator_kpis`: the notebook join as one aggregate; the NULL-key filter reaches the scan "
          "(`PushedFilters`).\n"
          "* `distinct_profile`: one scan for all columns; distinct pre-aggregated per task.\n"
          "* `summary_cards`: two results combined by a tagged union and one aggregate: no join, "
          "no sort.\n"
          "* `operator_metrics` over the catalog table: the range rule as `PartitionFilters`; the scan is over the "
          "range's leaves (`InMemoryFileIndex(n paths)`), the table's folder is not listed.\n"
          "* the same question from the hourly roll-up: commit records choose one leaf an hour.\n"
          "* event-time KPIs: partial aggregate before the state-store shuffle; watermark filter.\n")
    for k in ["average_by_operator", "operator_kpis", "distinct_profile", "summary_cards", "window_blank_kpis"]:
        show(f"`{k}`", C.QUERIES[k](spark, sf))
    out = new_run_dir(spark, "plans")
    tables = kpi_catalog(spark, "towerlens_plans_" + out.rsplit("-", 1)[-1], out)
    MicroBatchWriter(out, "plans", raw=False, catalog=tables, rollup=True)(
        wire_from_events(load_table(spark, sf, "events")), 0)
    show("`operator_metrics` over the catalog table (partition pruning)",
         serving.operator_metrics(spark.table(tables["average_by_operator"]), C.AS_OF, C.OPERATOR_RANGE))
    show("`operator_metrics` from the hourly roll-up", rollup.operator_metrics(spark, out, C.AS_OF, C.OPERATOR_RANGE))
    typed = C._typed_stream(spark, sf)
    show("event-time KPIs (streaming, window + watermark)",
         jobs.event_time_operator_kpis(typed, C.WINDOW, C.DELAY))
    spark.stop()


if __name__ == "__main__":
    main()
