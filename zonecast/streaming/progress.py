"""Rows that the watermark dropped, from query progress.

A listener on the session keeps one row per query and batch: rows read, and of all stateful operators the rows dropped as late. ``rows``
gives them as a table, ``save`` appends them to one; a monitoring job keeps what it has saved out of memory."""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "query string, run_id string, batch_id bigint, input_rows bigint, dropped_by_watermark bigint"


class DropListener(StreamingQueryListener):
    """Progress rows of the queries that run while it is attached."""

    def __init__(self) -> None:
        self._rows: dict[tuple[str, int], tuple] = {}
        self._ended: set[str] = set()
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        dropped = sum(o.numRowsDroppedByWatermark for o in p.stateOperators)
        with self._lock:
            self._rows[str(p.runId), p.batchId] = (p.name, str(p.runId), p.batchId, p.numInputRows, dropped)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.runId))

    def wait_for(self, run_id: str, seconds: float = 30.0) -> None:
        """Events come behind the query's end: wait until that of a run has come."""
        end = time.monotonic() + seconds
        while str(run_id) not in self._ended:
            if time.monotonic() > end:
                raise TimeoutError(f"no end of run {run_id} was reported")
            time.sleep(0.05)

    def rows(self, spark: SparkSession) -> DataFrame:
        with self._lock:
            return spark.createDataFrame(list(self._rows.values()), SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        """Append what has come to the table at ``path`` and forget it."""
        with self._lock:
            rows, self._rows = list(self._rows.values()), {}
        if rows:
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


class watching:
    """Attach a listener for the length of a block."""

    def __init__(self, spark: SparkSession):
        self.spark, self.listener = spark, DropListener()

    def __enter__(self) -> DropListener:
        self.spark.streams.addListener(self.listener)
        return self.listener

    def __exit__(self, *error) -> None:
        self.spark.streams.removeListener(self.listener)
