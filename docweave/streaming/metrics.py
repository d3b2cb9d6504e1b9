"""A6 of a stream — counters gathered in each micro-batch by the run itself.

``observed`` puts aggregates on a stream; Spark fills them while a micro-batch runs
(no pass of its own) and reports them with its progress.  ``StreamMetrics`` adds
them up as the reports come in, however many micro-batches there are; it holds one
number per metric.  The counters must be sums, and a ``foreachBatch`` function must
run its batch once, else its rows are counted again.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQueryListener


def observed(stream: DataFrame, name: str, **counters: Column) -> DataFrame:
    """``stream`` with the aggregates ``counters`` gathered under ``name``."""
    return stream.observe(name, *[c.alias(n) for n, c in counters.items()])


class StreamMetrics(StreamingQueryListener):
    """Sums of the counters ``name`` over the micro-batches of one query.  Add it
    with ``spark.streams.addListener`` before the query starts."""

    def __init__(self, name: str):
        self.name, self.sums, self.batches, self.last = name, {}, 0, -1
        self.lock, self.ended = threading.Lock(), threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is None:
            return
        with self.lock:
            if event.progress.batchId <= self.last:  # reported before
                return
            self.last, self.batches = event.progress.batchId, self.batches + 1
            for k, v in row.asDict().items():
                self.sums[k] = self.sums.get(k, 0) + (v or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()

    def totals(self, wait: float = 60.0) -> dict:
        """The sums once the query has ended and all its reports are in."""
        if not self.ended.wait(wait):
            raise TimeoutError(f"the query of {self.name!r} has not reported its end")
        with self.lock:
            return dict(self.sums)
