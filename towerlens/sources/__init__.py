"""Sources: the driver-table adapter, file scans, lake tables and streams."""

from towerlens.sources.events import (
    load_table, wire_measurements, wire_from_events,
)
from towerlens.sources.files import (
    read_lake_table, scan_csv,
)
from towerlens.sources.stream import stream_source

__all__ = [
    "load_table", "wire_measurements", "wire_from_events",
    "read_lake_table", "scan_csv", "stream_source",
]
