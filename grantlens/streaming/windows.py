"""Event-time state: windows and sessions under a watermark, and the heartbeat of a running query.

A stream's rows come in any order. The watermark is the latest event time seen less the delay that is allowed; a window or
session that ended before it is final: it goes out once, and rows that come for it later are dropped. State is kept in the
checkpoint, so a query that stops, or loses its machine, goes on from there.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def windowed(stream: DataFrame, ts: str, length: str, late: str, by: list[str], **values: Column) -> DataFrame:
    """start, end, by, n and values (aggregates) of tumbling windows. Null times are dropped; null keys are keys."""
    rows = stream.filter(F.col(ts).isNotNull()).withWatermark(ts, late)
    found = rows.groupBy(F.window(ts, length), *by).agg(F.count("*").alias("n"), *[v.alias(k) for k, v in values.items()])
    return found.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *by, "n", *values)


def sessions(stream: DataFrame, ts: str, gap: str, late: str, by: list[str], **values: Column) -> DataFrame:
    """start, end, by, n and values of sessions: rows of a key less than gap apart. end: the last row's time and the gap."""
    rows = stream.filter(F.col(ts).isNotNull()).withWatermark(ts, late)
    found = rows.groupBy(F.session_window(ts, gap), *by).agg(F.count("*").alias("n"), *[v.alias(k) for k, v in values.items()])
    return found.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *by, "n", *values)


def run(found: DataFrame, target: str, checkpoint: str, mode: str = "append") -> None:
    """Takes all that is new, writes what is final to target, and stops. Run again, it goes on where it was."""
    query = found.writeStream.format("parquet").outputMode(mode).option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


class Heartbeat(StreamingQueryListener):
    """What queries report of each batch: rows taken, rows a second, rows dropped as late, rows of state, the watermark.

    Keeps the last `most` reports; `rates` gives the totals so far, as a log line needs them.
    """

    def __init__(self, most: int = 1000) -> None:
        self.most, self.lock = most, threading.Lock()
        self.reports: list[dict] = []
        self.totals = {"batches": 0, "rows": 0, "late": 0, "milliseconds": 0}
        self.ended: list[str | None] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        report = {"query": str(p.id), "batch": p.batchId, "rows": p.numInputRows, "late": late, "state": sum(s.numRowsTotal for s in p.stateOperators), "milliseconds": p.batchDuration, "watermark": p.eventTime.get("watermark")}
        with self.lock:
            self.reports = [*self.reports[-self.most + 1 :], report]
            for name, value in (("batches", 1), ("rows", p.numInputRows), ("late", late), ("milliseconds", p.batchDuration)):
                self.totals[name] += value

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self.ended.append(event.exception)

    def rates(self) -> dict[str, float]:
        """The totals, and rows a second over all batches."""
        with self.lock:
            return {**self.totals, "rows_per_second": 1000 * self.totals["rows"] / max(1, self.totals["milliseconds"])}
