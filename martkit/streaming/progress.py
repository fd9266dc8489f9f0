"""Progress of streams, kept for every micro-batch (ST-8).

``recentProgress`` of a query forgets all but the last hundred micro-batches. A
listener writes each one down as it ends, as one small file under the name of
its run and batch, so a restarted driver does not count anything twice.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = (
    "query string, run_id string, batch_id long, at string, input_rows long, rows_per_second double, duration_ms long, "
    "watermark string, dropped_rows long"
)


class ProgressTable(StreamingQueryListener):
    """Listens while it is used as a context; ``read`` gives a row per
    micro-batch. ``dropped_rows`` are those that Spark's watermark dropped."""

    def __init__(self, spark: SparkSession, path: str, query: str | None = None):
        self.spark, self.path, self.query = spark, path.rstrip("/"), query

    def __enter__(self) -> ProgressTable:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        # Events come later than the end of their batch.
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if self.query not in (None, p.name):
            return
        row = {
            "query": p.name,
            "run_id": str(p.runId),
            "batch_id": p.batchId,
            "at": p.timestamp,
            "input_rows": p.numInputRows,
            "rows_per_second": float(p.processedRowsPerSecond or 0.0),
            "duration_ms": int(p.durationMs.get("triggerExecution", 0)),
            "watermark": dict(p.eventTime or {}).get("watermark"),
            "dropped_rows": sum(o.numRowsDroppedByWatermark for o in p.stateOperators),
        }
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{row['run_id']}-{p.batchId:012d}.json")
        out = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True)
        out.write(bytearray(json.dumps(row).encode()))
        out.close()

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).json(self.path)
