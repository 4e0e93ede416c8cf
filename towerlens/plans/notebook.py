"""Batch exploration path: CSV export → profile → KPIs → joined operator KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from towerlens.operators import kpis
from towerlens.operators.parse import type_records
from towerlens.sources.files import CSV_NULL_TOKEN, scan_csv

PROFILE_COLUMNS = ["network", "operator", "activity", "description"]


def notebook_frames(spark: SparkSession, csv_path: str,
                    null_token: str = CSV_NULL_TOKEN) -> dict[str, DataFrame]:
    """All notebook results as lazy frames (each is planned and run on its own)."""
    raw = scan_csv(spark, csv_path, null_token=null_token)
    typed = type_records(raw)
    return {
        "row_count": kpis.row_count(raw),
        "describe": kpis.describe_columns(typed),
        "distinct_values": kpis.distinct_values(raw, PROFILE_COLUMNS[:3]),
        "distinct_profile": kpis.distinct_profile(raw, PROFILE_COLUMNS),
        "avg_signal": kpis.avg_signal_batch(raw),
        "avg_precision": kpis.avg_precision_batch(raw),
        "status_count": kpis.status_count_batch(raw),
        "kpi_operator": kpis.join_operator_kpis(kpis.avg_signal_batch(raw), kpis.avg_precision_batch(raw)),
        "kpi_operator_fused": kpis.operator_kpis(raw),
    }
