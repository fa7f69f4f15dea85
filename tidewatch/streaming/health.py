"""What a stream lost and where it stands, as a table: progress reports of queries turned into rows.

Rows that come later than the watermark are dropped by stateful operators without a trace in the output.
Spark counts them in the progress of each batch; the listener here keeps one row per batch and operator.
"""

from __future__ import annotations

import threading
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = ("query STRING, run_id STRING, batch BIGINT, at TIMESTAMP, operator STRING, place INT, input_rows BIGINT, "
          "late_rows BIGINT, state_rows BIGINT, state_bytes BIGINT, watermark TIMESTAMP, lag_seconds DOUBLE, batch_ms BIGINT, error STRING")
#: Rows held on the driver before they are appended.
HELD = 200


def _moment(text: str | None) -> datetime | None:
    return None if not text else datetime.fromisoformat(text.replace("Z", "+00:00")).astimezone(timezone.utc).replace(tzinfo=None)


class Health(StreamingQueryListener):
    """Appends a row per batch and stateful operator to the table at `path`; without one, per batch.

    late_rows counts what the watermark kept out. A query that ends with an error leaves one row with it.
    Rows are appended HELD at a time and when a query ends; `flush` appends what is left. Add it with
    `spark.streams.addListener` before queries start.
    """

    def __init__(self, spark: SparkSession, path: str, held: int = HELD):
        self.spark, self.path, self.held = spark, path, held
        self._rows: list[tuple] = []
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        at, mark = _moment(progress.timestamp), _moment((progress.eventTime or {}).get("watermark"))
        newest = _moment((progress.eventTime or {}).get("max"))
        lag = None if mark is None or newest is None else (newest - mark).total_seconds()
        head = (progress.name or str(progress.id), str(progress.runId), progress.batchId, at)
        tail = (mark, lag, (progress.durationMs or {}).get("triggerExecution"), None)
        operators = [(o.operatorName, i, o.numRowsDroppedByWatermark, o.numRowsTotal, o.memoryUsedBytes)
                     for i, o in enumerate(progress.stateOperators)] or [(None, None, 0, 0, 0)]
        self._add([(*head, name, place, progress.numInputRows, late, rows, used, *tail) for name, place, late, rows, used in operators])

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            now = datetime.now(timezone.utc).replace(tzinfo=None)
            self._add([(str(event.id), str(event.runId), None, now, *[None] * 9, str(event.exception)[:2000])])
        self.flush()

    def _add(self, rows: list[tuple]) -> None:
        with self._lock:
            self._rows += rows
            full = len(self._rows) >= self.held
        if full:
            self.flush()

    def flush(self) -> None:
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)


def read_health(spark: SparkSession, path: str) -> DataFrame:
    """The rows appended so far."""
    return spark.read.schema(SCHEMA).parquet(path)


def late_rows(health: DataFrame) -> DataFrame:
    """Per query: rows read, rows dropped as late, most state rows at once, and the last watermark.

    A batch reads its rows once, however many operators it has.
    """
    batches = health.groupBy("query", "run_id", "batch").agg(
        F.max("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"),
        F.sum("state_rows").alias("state_rows"), F.max("watermark").alias("watermark"))
    return batches.groupBy("query").agg(
        F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"),
        F.max("state_rows").alias("state_rows"), F.max("watermark").alias("watermark"))
