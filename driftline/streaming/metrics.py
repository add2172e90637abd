"""Figures of a run, a JSON line for each interval: rows and bytes so far, rates since the beginning, memory in use."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

OBSERVED = "driftline_metrics"


class MetricsLog:
    """A folder of JSON lines, one file for each entry, in any store the session reaches; ``spark.read.json`` reads it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.began = spark, path.rstrip("/"), time.monotonic()
        self.rows = self.bytes = self.entries = 0
        self.peak_mb = 0.0

    def add(self, rows: int, size: int = 0, **more) -> dict:
        self.rows, self.bytes = self.rows + rows, self.bytes + size
        elapsed = max(time.monotonic() - self.began, 1e-9)
        machine = self.spark._jvm.java.lang.Runtime.getRuntime()
        memory = (machine.totalMemory() - machine.freeMemory()) / 1e6
        self.peak_mb = max(self.peak_mb, memory)
        entry = {"timestamp": datetime.now(UTC).isoformat(), "rows_processed": self.rows, "bytes_read": self.bytes, "throughput_rows_per_sec": self.rows / elapsed, "throughput_mb_per_sec": self.bytes / 1e6 / elapsed, "memory_mb": memory, "peak_memory_mb": self.peak_mb, "elapsed_secs": elapsed, **more}
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{self.entries:012d}.json")
        out = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True)
        out.write((json.dumps(entry) + "\n").encode())
        out.close()
        self.entries += 1
        return entry


def measured(rows: DataFrame, size: Column | None = None) -> DataFrame:
    """A stream whose progress tells rows and bytes (``size`` of a row, if given) to ``Listener``."""
    return rows.observe(OBSERVED, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(size if size is not None else F.lit(0)), F.lit(0)).cast("bigint").alias("bytes"))


class Listener(StreamingQueryListener):
    """An entry for each micro-batch that had rows."""

    def __init__(self, log: MetricsLog):
        self.log = log

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(OBSERVED)
        rows = seen["rows"] if seen else p.numInputRows
        if rows:
            self.log.add(rows, seen["bytes"] if seen else 0, batch=p.batchId, query=str(p.id), seconds=sum(v for k, v in p.durationMs.items() if k == "triggerExecution") / 1000)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def timed(rows: DataFrame, write: Callable[[DataFrame], None], log: MetricsLog, size: Column | None = None) -> dict:
    """Writes a batch and logs it; its rows and bytes are counted while it is written."""
    seen, began = Observation(), time.monotonic()
    write(rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(size if size is not None else F.lit(0)), F.lit(0)).cast("bigint").alias("bytes")))
    return log.add(seen.get["rows"], seen.get["bytes"], seconds=time.monotonic() - began)
