"""Numbers of each micro-batch, without a job of their own."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable

from pyspark.sql.streaming import StreamingQueryListener

LOG = logging.getLogger("penstock.batches")


def batch_metrics(progress) -> dict:
    """Rows read, rows handed to the sink, rows dropped as late, and durations of a batch."""
    observed = {name: row.asDict() for name, row in progress.observedMetrics.items()}
    return {
        "query": progress.name,
        "batch_id": progress.batchId,
        "timestamp": progress.timestamp,
        "input_rows": progress.numInputRows,
        "written": observed,
        "late_rows": sum(op.numRowsDroppedByWatermark for op in progress.stateOperators),
        "state_rows": sum(op.numRowsTotal for op in progress.stateOperators),
        "millis": dict(progress.durationMs),
    }


class BatchMetrics(StreamingQueryListener):
    """Gives the metrics of each batch to `report`; by default one JSON line in the log."""

    def __init__(self, report: Callable[[dict], None] | None = None):
        self.report = report or (lambda numbers: LOG.info(json.dumps(numbers)))

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.report(batch_metrics(event.progress))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
