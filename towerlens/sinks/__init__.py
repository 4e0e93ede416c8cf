"""Sinks: idempotent lake writes, table registration, results, replay."""

from towerlens.sinks.lake import (
    add_ingest_partitions, publish_records, register_tables, write_batch_table,
    write_result,
)

__all__ = ["add_ingest_partitions", "publish_records", "register_tables",
           "write_batch_table", "write_result"]
