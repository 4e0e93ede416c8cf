"""Structured Streaming jobs: micro-batch KPIs, event-time KPIs, raw sink."""

from towerlens.streaming.jobs import (
    event_time_operator_kpis, event_time_status_counts,
    read_latest_updates, start_event_time_sink, start_microbatch_job,
    start_raw_sink, start_update_sink, trigger_options,
)
from towerlens.streaming.listener import LateRowsListener

__all__ = [
    "event_time_operator_kpis", "event_time_status_counts",
    "read_latest_updates", "start_event_time_sink", "start_microbatch_job",
    "start_raw_sink", "start_update_sink", "trigger_options", "LateRowsListener",
]
