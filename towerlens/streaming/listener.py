"""Late-data reporting.

In append mode, rows behind the watermark vanish without an error. This
listener sums ``numRowsDroppedByWatermark`` of every stateful operator per
query (Spark counts rows dropped after partial aggregation, i.e. partial
groups, not input records) and keeps a per-batch log, so a job can alert on or
export the figure.
"""

from __future__ import annotations

import threading

from pyspark.sql.streaming import StreamingQueryListener


class LateRowsListener(StreamingQueryListener):
    def __init__(self) -> None:
        self._lock = threading.Lock()
        self.dropped: dict[str, int] = {}
        self.log: list[tuple[str, int, int]] = []  # (query name, batch id, dropped)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        n = sum(int(op.numRowsDroppedByWatermark or 0) for op in p.stateOperators)
        name = p.name or str(p.id)
        with self._lock:
            self.dropped[name] = self.dropped.get(name, 0) + n
            if n:
                self.log.append((name, p.batchId, n))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass
