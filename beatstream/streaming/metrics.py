"""Pipeline metrics: a batch listener, a log of every progress report, samples and their rollup.

Replaces polled JMX counters (messages/s, records consumed, lag, latency) with the
progress reports Structured Streaming already produces for every micro-batch.
"""

from __future__ import annotations

import threading
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from beatstream.streaming.sinks import write_text_file

PROGRESS_SCHEMA = """
    id string, name string, timestamp string, batchId long, numInputRows double, inputRowsPerSecond double,
    processedRowsPerSecond double, durationMs map<string, double>,
    sources array<struct<metrics: map<string, string>>>,
    stateOperators array<struct<numRowsTotal: double, numRowsUpdated: double, memoryUsedBytes: double>>,
    observedMetrics map<string, map<string, double>>"""


class BatchListener(StreamingQueryListener):
    """Hook on query start, batch progress and termination; keeps the latest ``keep``
    events and optionally prints the batch time like the reference's listener.  The whole
    history is the business of ``ProgressLog``."""

    def __init__(self, echo: bool = False, keep: int = 1000):
        self.events: deque[tuple[str, str, dict]] = deque(maxlen=keep)
        self.echo = echo

    def onQueryStarted(self, event):
        self.events.append(("started", str(event.id), {"name": event.name}))

    def onQueryProgress(self, event):
        p = event.progress
        info = {"batch_id": p.batchId, "timestamp": p.timestamp, "rows": p.numInputRows,
                "duration_ms": dict(p.durationMs or {})}
        self.events.append(("progress", str(p.id), info))
        if self.echo:
            print(f"[batchCompleted] {p.batchId} at {p.timestamp}")

    def onQueryIdle(self, event):
        self.events.append(("idle", str(event.id), {}))

    def onQueryTerminated(self, event):
        self.events.append(("terminated", str(event.id), {"exception": event.exception}))


class ProgressLog(StreamingQueryListener):
    """Writes every progress report of every query to ``path`` as JSON lines.

    Spark keeps only a query's latest reports; this log keeps all.  Reports are written in
    groups of ``group`` and when a query ends, one small file each time.
    """

    def __init__(self, spark: SparkSession, path: str, group: int = 100):
        self.spark, self.path, self.group = spark, path, group
        self.waiting: dict[str, list[str]] = {}
        self.files = 0
        self.ended: set[str] = set()
        self.change = threading.Condition()

    def _flush(self, run: str) -> None:
        lines = self.waiting.pop(run, [])
        if lines:
            write_text_file(self.spark, f"{self.path}/{run}-{self.files:06d}.json", "\n".join(lines))
            self.files += 1

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        run = str(event.progress.runId)
        self.waiting.setdefault(run, []).append(event.progress.json.replace("\n", " "))
        if len(self.waiting[run]) >= self.group:
            self._flush(run)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self._flush(str(event.runId))
        with self.change:
            self.ended.add(str(event.runId))
            self.change.notify_all()

    def wait(self, query, seconds: float = 60) -> bool:
        """Wait until all reports of an ended query are written (events arrive a little later)."""
        with self.change:
            return self.change.wait_for(lambda: str(query.runId) in self.ended, seconds)


def progress_samples(spark: SparkSession, path: str) -> DataFrame:
    """All reports of a ``ProgressLog`` as (ts, alias, batch_id, metric, attribute, value) rows.

    Metrics that a plan observes (``Dataset.observe``) appear under the observation's name."""
    p = spark.read.schema(PROGRESS_SCHEMA).json(path)

    def sample(metric, attribute, value):
        return F.struct(metric.cast("string").alias("metric"), attribute.cast("string").alias("attribute"),
                        value.cast("double").alias("value"))

    rows = F.array(*[sample(F.lit("rows"), F.lit(a), F.coalesce(F.col(c), F.lit(0.0))) for a, c in (
        ("input", "numInputRows"), ("input_per_second", "inputRowsPerSecond"),
        ("processed_per_second", "processedRowsPerSecond"))])
    durations = F.transform(F.map_entries("durationMs"), lambda e: sample(F.lit("duration_ms"), e["key"], e["value"]))
    sources = F.flatten(F.transform("sources", lambda s, i: F.transform(
        F.map_entries(F.coalesce(s["metrics"], F.create_map().cast("map<string,string>"))),
        lambda e: sample(F.concat(F.lit("source"), i.cast("string")), e["key"], e["value"].try_cast("double")))))
    states = F.flatten(F.transform("stateOperators", lambda s, i: F.array(*[
        sample(F.concat(F.lit("state"), i.cast("string")), F.lit(k), s[k])
        for k in ("numRowsTotal", "numRowsUpdated", "memoryUsedBytes")])))
    observed = F.flatten(F.transform(F.map_entries("observedMetrics"), lambda m: F.transform(
        F.map_entries(m["value"]), lambda e: sample(m["key"], e["key"], e["value"]))))
    none = F.array().cast("array<struct<metric: string, attribute: string, value: double>>")
    every = F.concat(rows, *[F.coalesce(x, none) for x in (durations, sources, states, observed)])
    return (p.select(F.to_timestamp("timestamp").alias("ts"), F.coalesce("name", "id").alias("alias"),
                     F.col("batchId").alias("batch_id"), F.explode(every).alias("s"))
             .select("ts", "alias", "batch_id", "s.metric", "s.attribute", "s.value")
             .filter(F.col("value").isNotNull()))


def metric_rollup(samples: DataFrame, bucket: str = "1 minute") -> DataFrame:
    """Average and maximum of each metric per time bucket."""
    w = F.window(F.col("ts"), bucket)
    return (samples.groupBy("alias", "metric", "attribute", w.start.alias("bucket_start"))
                   .agg(F.avg("value").alias("avg_value"), F.max("value").alias("max_value"),
                        F.count(F.lit(1)).alias("samples")))
