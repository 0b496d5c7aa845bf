"""Counts that streams observe while they run, summed over their micro-batches."""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql.streaming import StreamingQueryListener


class ObservedCounts(StreamingQueryListener):
    """Adds up the observed metrics of all queries of a session, by name and metric.

    ``spark.streams.addListener(counts)`` before the query starts. Progress is reported after a micro-batch has
    ended; a micro-batch that is repeated after a failure is counted when it ends, once.
    """

    def __init__(self):
        self._lock = threading.Lock()
        self.counts: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))

    def onQueryStarted(self, event) -> None:  # noqa: N802 - the listener's own name
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        with self._lock:
            for name, row in event.progress.observedMetrics.items():
                for metric, value in row.asDict().items():
                    self.counts[name][metric] += value or 0

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass
